"""Joins of a large table with a lookup that is too large to broadcast, with hot keys spread.

A key with more rows than one task should take is split: its rows get one of several salts by a hash of
their other columns, its lookup rows are repeated once per salt, and the join runs on (key, salt).  The rows
are evaluated once: they are written below the shared folder, and a frequent-items sketch (Spark's
``approx_top_k``) watches them on the way.  The sketch only routes rows, so an estimate that is off moves
work and loses nothing.  It has a fixed size: every key with over about ``1 / TRACKED`` of the rows is in
it, and the list of hot keys that reaches the driver and is broadcast has at most ``MOST_HOT_KEYS`` entries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from leadscope.session import shared_path

DEFAULT_HOT_ROWS = 1_000_000
MOST_HOT_KEYS, TRACKED = 100_000, 1_000_000
NULL_SALTS = 64


def watched(rows: DataFrame, key: str, hot_rows: int) -> tuple[DataFrame, list[tuple[object, int]]]:
    """The written rows, and (key, estimated rows) of the keys with more than ``hot_rows``."""
    spark, seen = rows.sparkSession, Observation()
    path = shared_path(spark, "salted")
    top = F.expr(f"approx_top_k(`{key}`, {MOST_HOT_KEYS}, {TRACKED})").alias("top")
    rows.observe(seen, top).write.parquet(path)
    hot = [(item["item"], item["count"]) for item in seen.get["top"] or [] if item["item"] is not None and item["count"] > hot_rows]
    return spark.read.schema(rows.schema).parquet(path), hot


def salted_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "inner", hot_rows: int = DEFAULT_HOT_ROWS
                ) -> DataFrame:
    """``rows`` joined with ``lookup`` on ``key`` (a column of both); ``how`` is inner or left."""
    if how not in ("inner", "left"):
        raise ValueError(f"not supported: {how}")
    rows, found = watched(rows, key, hot_rows)
    kind = rows.schema[key].dataType.simpleString()
    hot = F.broadcast(rows.sparkSession.createDataFrame([(k, -(-n // hot_rows)) for k, n in found],
                                                        f"_hot_key {kind}, _salts int"))
    # rows without a key match nothing; in a left join they are spread like a hot key
    salts = F.when(F.col(key).isNull(), F.lit(NULL_SALTS)).otherwise(F.coalesce("_salts", F.lit(1)))
    left = (rows.join(hot, rows[key] == hot["_hot_key"], "left")
            .withColumn("_salt", F.pmod(F.xxhash64(*[c for c in rows.columns if c != key], F.lit(0)), salts).cast("int"))
            .select(*rows.columns, "_salt"))
    right = (lookup.where(F.col(key).isNotNull()).join(hot, lookup[key] == hot["_hot_key"], "left")
             .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)))
             .select(*lookup.columns, "_salt"))
    return left.join(right, [key, "_salt"], how).drop("_salt")
