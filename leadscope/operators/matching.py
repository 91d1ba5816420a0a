"""The name match laid open: per distinct (term, name) pair its branches, and edit distances.

Both jobs reduce activity to distinct (account, cleaned term) first – a partial aggregate,
so hot keys and repeated terms collapse before any shuffle – normalise names once per
account, join (the name side broadcast within the checked bound), and keep distinct
pairs, so the edit distance runs once per pair.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.functions.text import (
    branch_contains,
    branch_edit_distance,
    branch_half_prefix,
    clean_text,
    normalised_name,
    normalised_term,
)
from leadscope.operators.skew import DEFAULT_HOT_ROWS, salted_join
from leadscope.plans.sizing import DEFAULT_MAX_BROADCAST_ROWS, bounded_broadcast, fits_broadcast


def _terms(activity: DataFrame) -> DataFrame:
    return activity.select("account_key", clean_text("keywords").alias("term")).distinct()


def name_match_flags(activity: DataFrame, account: DataFrame,
                     broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Distinct (term, name) pairs met in the data, with normalised forms and branch flags."""
    names = bounded_broadcast(account.select("account_key", clean_text("account_name").alias("name"))
                              .withColumn("n", normalised_name(F.col("name"))), broadcast_rows)
    pairs = _terms(activity).join(names, "account_key").select("term", "name", "n").distinct()
    with_t = pairs.withColumn("t", normalised_term(F.col("term")))
    t, n = F.col("t"), F.col("n")
    flags = with_t.withColumns({
        "by_contains": F.coalesce(branch_contains(t, n), F.lit(False)),
        "by_half_prefix": F.coalesce(branch_half_prefix(t, n), F.lit(False)),
        "by_edit_distance": F.coalesce(branch_edit_distance(t, n), F.lit(False)),
    })
    matched = F.col("by_contains") | F.col("by_half_prefix") | F.col("by_edit_distance")
    return flags.select("term", "name", "t", "n", "by_contains", "by_half_prefix", "by_edit_distance",
                        matched.alias("matched"))


def edit_distance_profile(activity: DataFrame, account: DataFrame, broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                          hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Per account and edit distance: the number of distinct (term, name) pairs met after the
    account join; the distance is taken between the normalised term and name."""
    names = (account.select("account_key", clean_text("account_name").alias("name"))
             .withColumn("n", normalised_name(F.col("name"))))
    terms = _terms(activity)
    if fits_broadcast(names, broadcast_rows):
        met = terms.join(F.broadcast(names), "account_key")
    else:
        met = salted_join(terms, names, "account_key", hot_rows=hot_rows)
    pairs = met.select("account_key", "term", "name", "n").distinct()
    distance = F.levenshtein(normalised_term(F.col("term")), F.col("n"))
    return (pairs.select("account_key", distance.alias("edit_distance"))
            .groupBy("account_key", "edit_distance")
            .agg(F.count(F.lit(1)).alias("pairs")))
