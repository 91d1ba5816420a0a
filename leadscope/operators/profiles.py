"""Search profiles: how often searches name the merchant, are empty, or are the placeholder.

Names are cleaned and normalised on the account side, once per account; the term is
normalised in its own projection and the match reads both as columns.

The heading/directory profile has two exact plan shapes, chosen by a checked size of the
(projected) account side:

* accounts within the broadcast bound: broadcast hash join, the match runs per search on
  the map side and only (heading, directory) partial counters are shuffled – the activity
  itself never crosses the network;
* larger: activity is first reduced to distinct (key, heading, directory, term) with a
  count (a partial aggregate before the shuffle, so repeated terms and hot keys collapse
  on the map side), the reduced rows are joined (sort-merge, AQE skew splitting) and the
  match runs once per distinct row.

Counters are sums of counts; summing pre-counted rows after an inner join is exact,
duplicate account keys included.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.functions.text import NONE_TERM, clean_text, normalised_match, normalised_name, normalised_term
from leadscope.operators.skew import DEFAULT_HOT_ROWS, salted_join
from leadscope.plans.sizing import DEFAULT_MAX_BROADCAST_ROWS, fits_broadcast


def with_match_flags(df: DataFrame, strict: bool = False) -> DataFrame:
    """``df`` has a cleaned ``term`` and a normalised ``name_key``; adds ``by_name``,
    ``is_empty`` and ``is_none``.  ``t`` is its own projection so it is computed once."""
    with_t = df.withColumn("t", normalised_term(F.col("term")))
    term = F.col("term")  # already cleaned (quotes dropped, Java trim), so no second trim
    return with_t.withColumns({
        "by_name": normalised_match(F.col("t"), F.col("name_key"), strict),
        "is_empty": term == F.lit(""),
        "is_none": F.upper(term) == F.lit(NONE_TERM),
    })


def _counters(total_name: str = "queries_total"):
    n = F.col("searches")
    return [
        F.sum(n).alias(total_name),
        F.sum(F.when(F.col("by_name"), n).otherwise(F.lit(0))).alias("queries_by_name"),
        F.sum(F.when(F.col("is_empty"), n).otherwise(F.lit(0))).alias("queries_empty"),
        F.sum(F.when(F.col("is_none"), n).otherwise(F.lit(0))).alias("queries_none"),
    ]


def heading_directory_profile(activity: DataFrame, account: DataFrame, strict: bool = False,
                              broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                              on: tuple[str, ...] = ("account_key",)) -> DataFrame:
    """Per (heading, directory): searches, searches by merchant name, empty ones, ``NONE`` ones.

    ``activity`` needs account_key, heading_id, directory_id, keywords; ``account`` needs
    account_key, account_name.  Terms and names are cleaned (quotes dropped, Java trim).
    A NULL term counts in the total only.  ``broadcast_rows`` bounds the account side that
    may be broadcast (0: never).  ``on`` names the join columns of a bucketed pair (key and salt).
    """
    names = account.select(*on, normalised_name(clean_text("account_name")).alias("name_key"))
    terms = activity.select(*on, "heading_id", "directory_id", clean_text("keywords").alias("term"))
    if len(on) == 1 and fits_broadcast(names, broadcast_rows):
        joined = terms.join(F.broadcast(names), "account_key").withColumn("searches", F.lit(1).cast("bigint"))
    else:
        searches = (terms.groupBy(*on, "heading_id", "directory_id", "term")
                    .agg(F.count(F.lit(1)).alias("searches")))
        joined = searches.join(names, list(on))
    flagged = with_match_flags(joined, strict)
    return flagged.groupBy("heading_id", "directory_id").agg(*_counters())


def merchant_profile(activity: DataFrame, account: DataFrame, per_date: bool = True,
                     clicks_only: bool = False, strict: bool = False,
                     broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS, hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Per merchant (key, id, name): searches, by name, empty, ``NONE``.

    ``per_date`` (the default) counts one search per merchant and day – the smallest
    cleaned term of that day, so the choice is deterministic.  ``per_date=False`` counts
    every search.  ``clicks_only`` keeps searches with a positive click weight.
    ``activity`` needs account_key, activity_date, keywords (and click_weight).
    """
    a = activity
    if clicks_only:
        a = a.filter(F.col("click_weight").try_cast("double") > 0)
    a = a.select("account_key", "activity_date", clean_text("keywords").alias("term"))
    if per_date:
        # A string minimum is a sort-based aggregate in Spark (variable-width buffer).  It still
        # runs partial-then-final, so a hot (key, day) collapses on the map side, and it spills.
        # (A distinct() in front would be removed by Catalyst, min ignoring duplicates.)
        a = a.groupBy("account_key", "activity_date").agg(F.min("term").alias("term"))
    terms = a.groupBy("account_key", "term").agg(F.count(F.lit(1)).alias("searches"))
    accounts = account.select("account_key", clean_text("account_id").alias("account_id"),
                              clean_text("account_name").alias("account_name"))
    if per_date:
        # one group per distinct (key, name, id): identical account rows merge
        accounts = accounts.dropDuplicates(["account_key", "account_id", "account_name"])
    accounts = accounts.withColumn("name_key", normalised_name(F.col("account_name")))
    if fits_broadcast(accounts, broadcast_rows):
        joined = terms.join(F.broadcast(accounts), "account_key")
    else:
        joined = salted_join(terms, accounts, "account_key", hot_rows=hot_rows)
    flagged = with_match_flags(joined, strict)
    return flagged.groupBy("account_key", "account_id", "account_name").agg(*_counters())
