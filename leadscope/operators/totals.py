"""Monthly totals: impressions and clicks per (account id, account key, directory).

The extract carries the numbers as text; text that is not a number counts as 0.  Amounts are summed
exactly over the whole range of DOUBLE (``functions.numeric``) and rounded half up once, at the end, so the
total depends neither on the order of rows nor on how partitions are combined; a total beyond BIGINT
stays at its bound.  Extract rows are summed per (key, directory, slot) before the account join (partial
aggregation on the map side), and re-summed after it, which is exact also when account keys repeat.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.functions.numeric import exact_total, finite_number, with_entries
from leadscope.plans.sizing import DEFAULT_MAX_BROADCAST_ROWS, bounded_broadcast

_SUMS = ("a", "b", "c", "d")


def _summed(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by, "slot").agg(*[F.sum(c).alias(c) for c in _SUMS])


def monthly_totals(extract: DataFrame, account: DataFrame,
                   broadcast_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """``extract``: account_key, directory_id, impressions, clicks (text);
    ``account``: account_key, account_id."""
    numbers = extract.select("account_key", "directory_id", finite_number("impressions").alias("first"),
                             finite_number("clicks").alias("second"))
    entries = with_entries(numbers, "first", "second")
    accounts = bounded_broadcast(account.select("account_key", "account_id"), broadcast_rows)
    names = ["account_id", "account_key", "directory_id"]
    slots = _summed(_summed(entries, "account_key", "directory_id").join(accounts, "account_key"), *names)
    ordinary, wide = F.col("slot") == 0, F.collect_list(F.when(F.col("slot") > 0, F.struct("slot", "a")))
    whole = slots.groupBy(*names).agg(*[F.coalesce(F.sum(F.when(ordinary, F.col(c))), F.lit(0)).cast("bigint").alias(c)
                                        for c in _SUMS], wide.alias("wide"))      # a bounded number of slots
    return whole.select(*names, exact_total(1, F.col("a"), F.col("b"), F.col("wide")).alias("impressions"),
                        exact_total(2, F.col("c"), F.col("d"), F.col("wide")).alias("clicks"))
