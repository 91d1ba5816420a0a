"""Per merchant: share of searches that are *not* for the merchant's name (the SQL study).

The study compares raw keywords with raw names through ``non_name_search`` (keyword
without '-' and blanks vs name without "'" and blanks, upper-cased).  It keeps searches
strictly after day ``since``, joins accounts and their location (accounts without a
location drop out), counts all searches and the non-name ones per account key, and
divides.  Accounts without any non-name search get NULL count and NULL share, as the
original left join of two aggregates gives.

Plan: one scan of activity with the date range pushed into the scan.  When the (key,
name) side is within the checked broadcast bound it is broadcast and each search is
tested on the map side; otherwise searches are first counted per (account, squeezed
keyword) so the shuffle join moves distinct keywords only, hot accounts salted.  One numeric aggregate per key
gives both counts (no second pass over the join).  Text attributes per key are taken from
the account side alone, so string minima never run over the activity.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.functions.dates import date_argument
from leadscope.functions.text import non_name_of, study_keyword, study_name
from leadscope.operators.skew import DEFAULT_HOT_ROWS, salted_join
from leadscope.plans.sizing import DEFAULT_MAX_BROADCAST_ROWS, bounded_broadcast, fits_broadcast


def _day_after(day: dt.date) -> F.Column:
    return F.lit((day + dt.timedelta(days=1)).isoformat()).cast("timestamp_ntz")


def non_name_share(activity: DataFrame, account: DataFrame, location: DataFrame,
                   since: str | dt.date, limit: int | None = None, ts_col: str = "activity_ts",
                   broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, hot_rows: int = DEFAULT_HOT_ROWS,
                   on: tuple[str, ...] = ("account_key",)) -> DataFrame:
    """``activity``: account_key, keywords, ``ts_col`` (TIMESTAMP_NTZ);
    ``account``: account_key, account_id, account_name, location_key;
    ``location``: location_key, location_city, location_zip_code.

    Output ordered by account name then key; ``limit`` keeps the first rows of that order.
    ``broadcast_rows`` bounds the (key, name) side that may be broadcast (0: never).
    ``on`` names the join columns of a bucketed pair (key and salt).
    """
    since_day = date_argument(since)
    # "DATE(ts) > since" written as a sargable range on the raw timestamp
    recent = activity.filter(F.col(ts_col) >= _day_after(since_day))
    keywords = recent.select(*on, study_keyword("keywords").alias("kw"))
    places = location.select("location_key", "location_city", "location_zip_code")
    if len(on) > 1:          # a shuffle on the location would undo the accounts' buckets
        places = bounded_broadcast(places, broadcast_rows)
    located = account.select(*on, "account_id", "account_name", "location_key").join(places, "location_key")
    name_keys = located.select(*on, study_name("account_name").alias("name_key"))
    if len(on) == 1 and fits_broadcast(name_keys, broadcast_rows):
        # no shuffle of the activity: broadcast join, one count per search
        joined = keywords.join(F.broadcast(name_keys), "account_key").withColumn("n", F.lit(1).cast("bigint"))
    else:
        # count distinct (key, keyword) first, so the shuffle join moves reduced rows
        counted = keywords.groupBy(*on, "kw").agg(F.count(F.lit(1)).alias("n"))
        joined = (salted_join(counted, name_keys, "account_key", hot_rows=hot_rows) if len(on) == 1
                  else counted.join(name_keys, list(on)))
    # numeric sums only, so the fact side stays in hash aggregation
    non_name = non_name_of("kw", "name_key")
    counts = (joined.groupBy("account_key")
              .agg(F.sum("n").alias("total_count"), F.sum(F.when(non_name, F.col("n"))).alias("per_category_count")))
    # one set of text attributes per key (the original grouped by key alone), all taken from one
    # account row – the smallest, NULLs after values (explicit flags, as engines order NULLs
    # inside structs differently) – on the account side only
    text = ["account_id", "account_name", "location_city", "location_zip_code"]
    order = [part for c in text for part in (F.col(c).isNull().alias(f"{c}_missing"), F.col(c))]
    attributes = (located.groupBy("account_key").agg(F.min(F.struct(*order)).alias("a"))
                  .select("account_key", *[F.col(f"a.{c}").alias(c) for c in text]))
    per_account = counts.join(attributes, "account_key")
    out = per_account.select(
        "account_key", "account_id", "account_name", "location_city", "location_zip_code", "total_count",
        "per_category_count",
        (F.col("per_category_count").cast("double") / F.col("total_count").cast("double")).alias("category_proportion"))
    out = out.orderBy("account_name", "account_key")
    if limit is not None:
        out = out.limit(limit)
    return out
