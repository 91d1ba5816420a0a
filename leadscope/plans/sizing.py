"""Explicit, checked broadcasts.

Catalyst and AQE broadcast a join side on their own when its (estimated or measured)
size is under ``spark.sql.autoBroadcastJoinThreshold``.  Where the plan *shape* depends
on whether a side can be broadcast, or where a side must never be shuffled against the
fact table – a join on a low-cardinality key such as a click type, where a sort-merge
join would put whole fractions of the data into a few tasks and AQE cannot split an
existence join – the jobs check the side's row count first and broadcast by hint only
under the bound.  Beyond the bound the side is left unhinted and the job takes its
shuffle-based form (planner's choice, AQE skew splitting).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

# A lookup side of up to a million short rows (a key and a name) is some tens of MB on
# every executor.  Both bounds must hold: rows, and bytes of the projected rows as Spark
# stores them; the byte bound leaves room for the hash index of the broadcast relation.
DEFAULT_MAX_BROADCAST_ROWS = 1_000_000
DEFAULT_MAX_BROADCAST_BYTES = 256 * 1024 * 1024


def _row_bytes(df: DataFrame):
    """Bytes of one row as Spark holds it (UnsafeRow): a null-bit word per 64 fields, an
    8-byte slot per field, and string/binary data rounded up to 8 bytes.  The hashed
    relation built for a broadcast adds its index on top, which the byte bound allows for."""
    fields = df.schema.fields
    fixed = 8 * ((len(fields) + 63) // 64) + 8 * len(fields)
    total = F.lit(fixed)
    for f in fields:
        if isinstance(f.dataType, (StringType, BinaryType)):
            length = F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
            total = total + F.ceil(length / 8) * 8
    return total.cast("bigint")


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows and bytes (as Spark holds them) of ``df``, from one aggregate."""
    rows, size = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(_row_bytes(df)).alias("bytes")).first()
    return rows, size or 0


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                   max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes of data.

    Measured with one plain aggregate (partial counts and byte sums per partition, a tiny
    shuffle) – not with ``limit``, which Spark finishes in a single partition and which
    could funnel a large side through one task.  The check scans the (projected, lookup-
    sized) side once; ``max_rows <= 0`` disables broadcasting."""
    if max_rows <= 0:
        return False
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_MAX_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``df`` is within both bounds, else ``df`` unchanged."""
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df
