"""Lead check: ranges, children, reconciliation and record rules on hand-made rows."""

import datetime as dt

import pytest

from leadscope.operators import leads
from tests.conftest import as_parquet

BRIDGE = "parent_account_id string, child_account_id string, child_account_key string"
PHONE = "phone_lead_id bigint, account_key bigint, created_datetime timestamp_ntz"


@pytest.fixture
def bridge(spark, scratch):
    rows = [("P1", "11", "101"), ("P1", "x12", "102"), ("P1", "13", "k103"), ("P2", "21", "201"),
            ("P3", "bad", "bad")]  # P3: no numeric child at all
    return as_parquet(spark, rows, BRIDGE, scratch)


def test_child_accounts_skip_non_numbers_per_field(bridge):
    got = sorted(tuple(r) for r in leads.child_accounts(bridge, ["P1"]).collect())
    assert got == [("P1", "child_account_id", 11), ("P1", "child_account_id", 13),
                   ("P1", "child_account_key", 101), ("P1", "child_account_key", 102)]
    assert leads.child_accounts(bridge, ["P3"]).count() == 0


def test_phone_range_is_inclusive_of_the_whole_last_day(spark, scratch, bridge):
    rows = [(1, 101, dt.datetime(2014, 1, 1, 0, 0, 0)),
            (2, 101, dt.datetime(2014, 1, 31, 23, 59, 59, 700000)),  # fractional second of the last day
            (3, 101, dt.datetime(2014, 2, 1, 0, 0, 0)),
            (4, 101, dt.datetime(2013, 12, 31, 23, 59, 59)),
            (5, 999, dt.datetime(2014, 1, 10)),                        # not a child
            (6, 201, dt.datetime(2014, 1, 10))]
    phone = as_parquet(spark, rows, PHONE, scratch)
    got = sorted((r.parent_account_id, r.phone_lead_id) for r in
                 leads.phone_leads(phone, bridge, "2014-01-01", "2014-01-31").collect())
    assert got == [("P1", 1), ("P1", 2), ("P2", 6)]
    # empty child list gives no rows (not an error, not everything)
    assert leads.phone_leads(phone, bridge, "2014-01-01", "2014-01-31", parents=["P3"]).count() == 0


def test_bad_date_arguments_are_refused(spark, scratch, bridge):
    phone = as_parquet(spark, [(1, 101, dt.datetime(2014, 1, 1))], PHONE, scratch)
    for bad in ("2014-2-3", "2014-02-31", "20140203", None):
        with pytest.raises(ValueError):
            leads.phone_leads(phone, bridge, bad, "2014-12-31")


def test_online_source_lead_types_or_zero(spark, scratch, bridge):
    act = as_parquet(spark, [(1, 101, dt.datetime(2014, 1, 5), 0, "s"), (2, 101, dt.datetime(2014, 1, 5), 1, "s"),
                             (3, 101, dt.datetime(2014, 1, 5), 3, "s"), (4, 101, dt.datetime(2014, 1, 5), 7, "s")],
                     "event_id bigint, account_key bigint, activity_ts timestamp_ntz, click_type_id int, session_id string",
                     scratch)
    ct = as_parquet(spark, [(1, "free_call"), (3, "banner_view"), (7, "FREE_CALL")], "click_type_id int, name string",
                    scratch)
    got = sorted(r.raw_activity_account_key for r in leads.online_leads(act, ct, bridge, "2014-01-01", "2014-01-31").collect())
    assert got == [1, 2]   # id 0 always; names compare case-sensitively


def test_reconciliation_counts_and_gate(spark, scratch, bridge):
    act = as_parquet(spark, [(1, 101, dt.datetime(2014, 1, 5), 0, "s"), (2, 201, dt.datetime(2014, 1, 5), 0, "s")],
                     "event_id bigint, account_key bigint, activity_ts timestamp_ntz, click_type_id int, session_id string",
                     scratch)
    ct = as_parquet(spark, [(1, "free_call")], "click_type_id int, name string", scratch)
    phone = as_parquet(spark, [(1, 101, dt.datetime(2014, 1, 5))], PHONE, scratch)
    rep_schema = ("event_id bigint, date_day string, merchant_id string, impressions string, click_type_name string, "
                  "clicks string, platform string")
    online_rep = as_parquet(spark, [(10, "2014-01-05", "11", "1", "free_call", "0", "Desktop"),
                                    (11, "2014-01-05", "21", "0", "other", "0", ""),
                                    (12, "2014-01-05", "21", "1", "free_call", "0", "Mobile")], rep_schema, scratch)
    phone_rep = as_parquet(spark, [(1, "2014-01-05", "11", "30")],
                           "phone_lead_id bigint, phone_lead_date string, merchant_id string, duration string", scratch)
    rec = leads.lead_reconciliation(act, ct, phone, online_rep, phone_rep, bridge, "2014-01-01", "2014-01-31")
    got = {(r.parent_account_id, r.kind): (r.source_count, r.report_count, r.ok) for r in rec.collect()}
    assert got == {("P1", "online"): (1, 1, True), ("P1", "phone"): (1, 1, True),
                   ("P2", "online"): (1, 2, False), ("P2", "phone"): (0, 0, True),
                   ("P3", "online"): (0, 0, True), ("P3", "phone"): (0, 0, True)}
    all_rules = sorted((r.event_id, r.rule) for r in
                       leads.report_violations(online_rep, bridge, "2014-01-01", "2014-01-31").collect())
    assert all_rules == [(11, "clicks_xor_impressions"), (11, "empty_platform"), (11, "not_a_lead")]
    gated = leads.report_violations(online_rep, bridge, "2014-01-01", "2014-01-31", reconciliation=rec).collect()
    assert gated == []   # only P1 reconciles, and its record is clean


def test_violation_rules(spark, scratch, bridge):
    rep_schema = ("event_id bigint, date_day string, merchant_id string, impressions string, click_type_name string, "
                  "clicks string, platform string")
    rows = [(1, "2014-01-05", "11", "1", "free_call", "0", "Desktop"),   # clean
            (2, "2014-01-05", "11", "1", "free_call", "1", "Tablet"),    # both counters, unknown platform
            (3, "2014-03-05", "99", "0", "Free_Call", "0", "MOBILE"),    # out of range, unknown merchant, not a lead, none
            (4, "2014-01-05", "11", None, None, "2", None)]               # null counters read as 0, null name
    rep = as_parquet(spark, rows, rep_schema, scratch)
    got = sorted((r.event_id, r.rule, r.value) for r in
                 leads.report_violations(rep, bridge, "2014-01-01", "2014-01-31").collect())
    assert got == [
        (2, "clicks_xor_impressions", "clicks=1, impressions=1"), (2, "unknown_platform", "Tablet"),
        (3, "clicks_xor_impressions", "clicks=0, impressions=0"), (3, "date_out_of_range", "2014-03-05"),
        (3, "merchant_not_expected", "99"), (3, "not_a_lead", "Free_Call"),
        (4, "empty_platform", ""), (4, "not_a_lead", None)]


def test_lead_names_are_21_distinct():
    assert len(leads.LEAD_CLICK_TYPES) == len(set(leads.LEAD_CLICK_TYPES)) == 21


def test_parents_as_a_dataframe(spark, scratch, bridge):
    parents = as_parquet(spark, [("P2",), ("P2",), ("P9",)], "parent_account_id string", scratch)
    got = sorted(tuple(r) for r in leads.child_accounts(bridge, parents).collect())
    assert got == [("P2", "child_account_id", 21), ("P2", "child_account_key", 201)]
    phone = as_parquet(spark, [(1, 201, dt.datetime(2014, 1, 3)), (2, 101, dt.datetime(2014, 1, 3))], PHONE, scratch)
    assert [r.phone_lead_id for r in leads.phone_leads(phone, bridge, "2014-01-01", "2014-01-31", parents).collect()] == [1]


def test_xor_rule_does_not_overflow(spark, scratch, bridge):
    big = str(2 ** 62)
    rep = as_parquet(spark, [(1, "2014-01-05", "11", big, "free_call", big, "Desktop"),
                             (2, "2014-01-05", "11", "0", "free_call", big, "Desktop"),
                             (3, "2014-01-05", "11", "-1", "free_call", "2", "Desktop")],
                     "event_id bigint, date_day string, merchant_id string, impressions string, "
                     "click_type_name string, clicks string, platform string", scratch)
    got = sorted(r.event_id for r in leads.report_violations(rep, bridge, "2014-01-01", "2014-01-31").collect()
                 if r.rule == "clicks_xor_impressions")
    assert got == [1, 3]


def test_parents_argument_forms(spark, scratch, bridge):
    as_list = sorted(tuple(r) for r in leads.child_accounts(bridge, ["P1"]).collect())
    assert sorted(tuple(r) for r in leads.child_accounts(bridge, "P1").collect()) == as_list
    assert sorted(tuple(r) for r in leads.child_accounts(bridge, (p for p in ["P1"])).collect()) == as_list


def test_null_parent_names_no_parent(spark, scratch):
    rows = [("P1", "11", "101"), (None, "12", "102")]
    bridge = as_parquet(spark, rows, BRIDGE, scratch)
    assert {r.parent_account_id for r in leads.child_accounts(bridge).collect()} == {"P1"}
    assert [r.parent_account_id for r in leads.parent_list(bridge).collect()] == ["P1"]


def test_generator_parents_in_reconciliation(spark, scratch, bridge):
    act = as_parquet(spark, [(1, 101, dt.datetime(2014, 1, 5), 0, "s")],
                     "event_id bigint, account_key bigint, activity_ts timestamp_ntz, click_type_id int, session_id string",
                     scratch)
    ct = as_parquet(spark, [(1, "free_call")], "click_type_id int, name string", scratch)
    phone = as_parquet(spark, [(1, 101, dt.datetime(2014, 1, 5))], PHONE, scratch)
    rep = as_parquet(spark, [(10, "2014-01-05", "11", "1", "free_call", "0", "Desktop")],
                     "event_id bigint, date_day string, merchant_id string, impressions string, click_type_name string, "
                     "clicks string, platform string", scratch)
    prep = as_parquet(spark, [(1, "2014-01-05", "11", "30")],
                      "phone_lead_id bigint, phone_lead_date string, merchant_id string, duration string", scratch)
    args = (act, ct, phone, rep, prep, bridge, "2014-01-01", "2014-01-31")
    listed = sorted(tuple(r) for r in leads.lead_reconciliation(*args, parents=["P1"]).collect())
    generated = sorted(tuple(r) for r in leads.lead_reconciliation(*args, parents=(p for p in ["P1"])).collect())
    assert listed == generated and listed[0][2] == 1   # counts were really taken
