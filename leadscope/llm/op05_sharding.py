"""Shard placement by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in its own order: offset + i * skip modulo the size,
with offset and skip hashed from its name.  The shards take turns, each claiming its next preferred free
slot (a shard of weight w claims w slots a turn), until the table is full.  A key's shard is the owner of
slot hash(key) modulo the size: one array access.  The table has a fixed size, so its broadcast is
bounded; shares differ by at most one turn, and when a shard leaves, few other keys move.

Defined cases: a NULL key goes to the owner of slot 0; equal keys share a shard; keys are compared as text;
no shards, repeated names or a size that is no prime are errors.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def _number(text: str) -> int:
    return int.from_bytes(hashlib.md5(text.encode()).digest()[:8], "big")


def lookup_table(shards: list[str], size: int, weights: dict[str, int] | None = None) -> np.ndarray:
    """Owner (index into ``shards``) of every slot."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shard names must be distinct and not empty")
    if not is_prime(size) or size < len(shards):
        raise ValueError("the table size must be a prime of at least the number of shards")
    turns = [max(1, (weights or {}).get(s, 1)) for s in shards]
    place = [_number("offset " + s) % size for s in shards]
    skip = [_number("skip " + s) % (size - 1) + 1 for s in shards]
    owner, left = np.full(size, -1, np.int32), size
    while left:
        for k, turn in enumerate(turns):
            for _ in range(min(turn, left)):
                while owner[place[k]] >= 0:
                    place[k] = (place[k] + skip[k]) % size
                owner[place[k]] = k
                left -= 1
    return owner


def slot_of(key, size: int):
    """Slot of a key column: the first 15 hex digits of the md5 of its text, modulo the table size."""
    head = F.conv(F.substring(F.md5(F.encode(key.cast("string"), "UTF-8")), 1, 15), 16, 10).cast("long")
    return F.coalesce(F.pmod(head, F.lit(size)), F.lit(0)).cast("int")


def place(rows: DataFrame, key_col: str, shards: list[str], size: int = 65_537, weights: dict[str, int] | None = None
          ) -> DataFrame:
    """``rows`` with ``slot`` and ``shard`` appended (a column of either name is replaced)."""
    spark = rows.sparkSession
    owner = lookup_table(shards, size, weights)
    table = spark.createDataFrame([(i, shards[k]) for i, k in enumerate(owner.tolist())], "__slot int, __shard string")
    key = rows[key_col]
    kept = [c for c in rows.columns if c not in ("slot", "shard")]
    placed = rows.select(*kept, slot_of(key, size).alias("slot"))
    return (placed.join(F.broadcast(table), placed["slot"] == table["__slot"])       # exactly ``size`` rows
            .select(*kept, "slot", F.col("__shard").alias("shard")))
