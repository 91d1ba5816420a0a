"""Profiles, share and totals on hand-made cases the driver tables cannot give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from leadscope.operators import matching, profiles, share, totals
from tests.conftest import SF01, as_parquet

ACT = "account_key bigint, heading_id bigint, directory_id bigint, keywords string, activity_date date, " \
      "activity_ts timestamp_ntz, click_weight double"
ACC = "account_key bigint, account_id string, account_name string, location_key int"


def _ts(day, h=12):
    return dt.datetime(2014, 4, day, h, 0, 0)


@pytest.fixture
def small(spark, scratch):
    act = [
        (1, 1, 1, "Pizza Hut", dt.date(2014, 4, 2), _ts(2), 1.0),
        (1, 1, 1, '"pizza hut" ', dt.date(2014, 4, 2), _ts(2), 0.0),
        (1, 1, 1, "", dt.date(2014, 4, 3), _ts(3), 0.0),
        (1, 1, 2, " none ", dt.date(2014, 4, 4), _ts(4), 2.0),
        (1, 1, 2, None, dt.date(2014, 4, 4), _ts(4), 0.0),      # null term
        (2, 2, 1, "burgers", dt.date(2014, 4, 2), _ts(2), 0.0),
        (9, 1, 1, "orphan", dt.date(2014, 4, 2), _ts(2), 0.0),  # no account
    ]
    acc = [(1, "A1", "Pizza Hut", 1), (2, "A2", "Tim's", 2), (2, "A2b", "Tim's Other", 2)]  # duplicate key 2
    return (as_parquet(spark, act, ACT, scratch), as_parquet(spark, acc, ACC, scratch))


def test_heading_profile_hand_cases(small):
    act, acc = small
    got = {(r.heading_id, r.directory_id): tuple(r)[2:] for r in profiles.heading_directory_profile(act, acc).collect()}
    # (1,1): pizza hut x2 by name, '' empty and vacuous match; orphan dropped
    assert got[(1, 1)] == (3, 3, 1, 0)
    # (1,2): none + null term (total only)
    assert got[(1, 2)] == (2, 0, 0, 1)
    # (2,1): one search joined with both duplicate account rows (no dedup)
    assert got[(2, 1)] == (2, 0, 0, 0)


def test_merchant_profile_per_date_and_all(small):
    act, acc = small
    per_date = {r.account_id: tuple(r)[3:] for r in profiles.merchant_profile(act, acc).collect()}
    # account 1: days 2, 3, 4 -> min terms 'Pizza Hut' (< 'pizza hut'), '', 'none'
    assert per_date["A1"] == (3, 2, 1, 1)
    every = {r.account_id: tuple(r)[3:] for r in profiles.merchant_profile(act, acc, per_date=False).collect()}
    assert every["A1"] == (5, 3, 1, 1)
    clicks = {r.account_id: tuple(r)[3:] for r in profiles.merchant_profile(act, acc, clicks_only=True).collect()}
    assert clicks == {"A1": (2, 1, 0, 1)}


def test_share_null_when_no_non_name_search(spark, scratch, small):
    act, acc = small
    loc = as_parquet(spark, [(1, "Montreal", "H1"), (2, "Laval", "H7")],
                     "location_key int, location_city string, location_zip_code string", scratch)
    rows = {r.account_key: r for r in share.non_name_share(act, acc, loc, since="2014-04-01").collect()}
    # account 1: 'Pizza Hut' equals the name; '"pizza hut" ' has quotes -> non-name; '' and ' none ' non-name;
    # null keyword counts in the total only
    assert (rows[1].total_count, rows[1].per_category_count) == (5, 3)
    assert rows[1].category_proportion == pytest.approx(0.6)
    only_name = act.filter(F.col("keywords") == "Pizza Hut")
    r = share.non_name_share(only_name, acc, loc, since="2014-04-01").collect()
    assert [(x.account_key, x.total_count, x.per_category_count, x.category_proportion) for x in r] == [(1, 1, None, None)]


def test_share_since_is_strict_and_limit_orders(spark, scratch, small):
    act, acc = small
    loc = as_parquet(spark, [(1, "Montreal", "H1"), (2, "Laval", "H7")],
                     "location_key int, location_city string, location_zip_code string", scratch)
    rows = share.non_name_share(act, acc, loc, since="2014-04-02").collect()
    assert [(r.account_key, r.total_count) for r in rows] == [(1, 3)]  # day 2 itself is out
    top = share.non_name_share(act, acc, loc, since="2014-04-01", limit=1).collect()
    assert [r.account_name for r in top] == ["Pizza Hut"]


def test_monthly_totals_round_half_up_and_tolerant(spark, scratch):
    ext = as_parquet(spark, [(1, 5, "1.25", "x"), (1, 5, "1.25", "0.5"), (1, 5, "n/a", "NaN"), (2, 5, "-2.5", "")],
                     "account_key bigint, directory_id bigint, impressions string, clicks string", scratch)
    acc = as_parquet(spark, [(1, "A1", "n", 1), (2, "A2", "m", 1)], ACC, scratch)
    got = {r.account_key: (r.impressions, r.clicks) for r in totals.monthly_totals(ext, acc).collect()}
    assert got == {1: (3, 1), 2: (-2, 0)}   # 2.5 -> 3, 0.5 -> 1, -2.5 -> -2 (floor(x + 0.5))


def test_monthly_totals_lose_nothing(spark, scratch):
    """Amounts beyond DECIMAL and BIGINT, many decimals, and repeated account keys; any row order."""
    big, top = "9000000000000000000", (1 << 63) - 1
    rows = [(1, 5, "1e30", big), (1, 5, "5", big),                                # beyond BIGINT: at its bound
            (2, 5, "-1e30", "-" + big), (2, 5, "7", "-" + big),
            (3, 5, "1e30", "0.25000000000001"), (3, 5, "-1e30", "0.24999999999999"),   # 0.5 exactly: up
            (4, 5, "1e30", "Infinity"), (4, 6, "123456789012345678", "1e-7"),
            (5, 5, "9007199254740993", "2251799813685248.5"), (5, 5, "1", "0")]
    ext = as_parquet(spark, rows, "account_key bigint, directory_id bigint, impressions string, clicks string", scratch)
    acc = as_parquet(spark, [(k, f"A{k}", "n", 1) for k in range(1, 6)], ACC, scratch)
    for part in (ext, ext.repartition(5), ext.orderBy(F.desc("impressions"))):
        got = {(r.account_key, r.directory_id): (r.impressions, r.clicks) for r in totals.monthly_totals(part, acc).collect()}
        assert got == {(1, 5): (top, top), (2, 5): (-top - 1, -top - 1), (3, 5): (0, 1), (4, 5): (top, 0),
                       (4, 6): (123456789012345680, 0), (5, 5): (9007199254740993, 2251799813685249)}


def test_edit_distance_profile_counts_distinct_pairs(small):
    act, acc = small
    got = {(r.account_key, r.edit_distance): r.pairs for r in matching.edit_distance_profile(act, acc).collect()}
    # account 1 distinct (term, name) pairs: 'Pizza Hut' and 'pizza hut' (both 0 away), '' and 'none'
    # (both 8 away), NULL
    assert got[(1, 0)] == 2 and got[(1, 8)] == 2 and got[(1, None)] == 1


def test_flagship_totals_at_sf001(spark):
    from leadscope.plans import catalog

    df = catalog.JOBS["heading_directory_profile"](spark, SF01)
    tot = df.agg(*[F.sum(c).alias(c) for c in ("queries_total", "queries_by_name", "queries_empty", "queries_none")]).first()
    assert tuple(tot) == (10000, 7500, 1250, 1250)
    assert df.count() == 175


def test_share_attributes_come_from_one_account_row(spark, scratch):
    act = as_parquet(spark, [(7, 1, 1, "x", dt.date(2014, 4, 2), _ts(2), 0.0)], ACT, scratch)
    acc = as_parquet(spark, [(7, "A7", "Zed Pizza", 1), (7, "B7", "Alpha Cafe", 2)], ACC, scratch)
    loc = as_parquet(spark, [(1, "Paris", "P1"), (2, "Lyon", "L2")],
                     "location_key int, location_city string, location_zip_code string", scratch)
    (r,) = share.non_name_share(act, acc, loc, since="2014-04-01").collect()
    assert (r.account_id, r.account_name, r.location_city, r.total_count) == ("A7", "Zed Pizza", "Paris", 2)


def test_share_attributes_prefer_values_over_nulls(spark, scratch):
    act = as_parquet(spark, [(7, 1, 1, "x", dt.date(2014, 4, 2), _ts(2), 0.0)], ACT, scratch)
    acc = as_parquet(spark, [(7, "A7", "Pizza", 1), (7, "A7", "Pizza", 2)], ACC, scratch)
    loc = as_parquet(spark, [(1, None, "P1"), (2, "Paris", "P2")],
                     "location_key int, location_city string, location_zip_code string", scratch)
    (r,) = share.non_name_share(act, acc, loc, since="2014-04-01").collect()
    assert (r.location_city, r.location_zip_code) == ("Paris", "P2")
