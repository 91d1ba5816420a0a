"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    return (both.where("b > a").join(low, "a")
            .select(F.col("b").alias("a"), F.least("a", "m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.union(low.select("a", F.col("m").alias("b")))


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (two integer columns ``a``, ``b``); the root is the
    smallest node of its component.  Loops and repeated edges are ignored; an empty table gives no
    rows.  Each round is written with ``checkpoint()``, so a lost executor repeats one round only.
    """
    edges = edges.where("a <> b and a is not null and b is not null").distinct().checkpoint()
    seen = None
    for _ in range(max_rounds):
        edges = _small_star(_large_star(edges).distinct()).where("a <> b").distinct().checkpoint()
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state[0] == 0 or state == seen:
            break
        seen = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
