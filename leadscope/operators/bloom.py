"""A Bloom filter of lookup keys, applied to the rows before a join shuffles them.

For lookups beyond the broadcast bound.  The filter is a small table of blocks: a key's hash names its block
and one bit in each of the block's eight 64-bit words, so it is built by one aggregate of BIGINTs and tested
by one broadcast semi join.  At 32 keys to a block (about 3 bytes a key) roughly one other key in a thousand
passes.  Rows that pass still meet the join, so a false hit costs a shuffled row and changes no result.

Defined cases: rows with a NULL key go, since they join nothing; an empty list of keys passes no row; a list
so long that half of all other keys would pass a filter of ``MOST_BLOCKS`` leaves the rows as they are.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS, KEYS_PER_BLOCK, MOST_BLOCKS = 8, 32, 1_000_000


def block_count(keys: int) -> int:
    return max(1, min(MOST_BLOCKS, -(-keys // KEYS_PER_BLOCK)))


def pass_rate(keys: int, blocks: int) -> float:
    """Expected share of other keys that pass."""
    return (1 - math.exp(-keys / (64 * blocks))) ** WORDS


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def _bit(key: Column, word: int) -> Column:
    """The key's bit in a word: six bits of a second hash."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(1)), 6 * word).bitwiseAND(F.lit(63).cast("long")).cast("int")


def key_filter(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """(_block, _w0.._w7) of the keys in ``column``."""
    key, one = F.col(column), F.lit(1).cast("long")
    words = [F.bit_or(F.call_function("shiftleft", one, _bit(key, i))).alias(f"_w{i}") for i in range(WORDS)]
    return keys.where(key.isNotNull()).groupBy(_block(key, blocks).alias("_block")).agg(*words)


def possible(rows: DataFrame, key: str, keys: DataFrame, column: str, n_keys: int) -> DataFrame:
    """The ``rows`` whose ``key`` may be among the ``n_keys`` (or fewer) keys in ``column``."""
    blocks = block_count(n_keys)
    if pass_rate(n_keys, blocks) > 0.5:
        return rows
    words = F.broadcast(key_filter(keys, column, blocks))          # at most MOST_BLOCKS rows of 80 bytes
    own = rows[key].cast(keys.schema[column].dataType)
    met = _block(own, blocks) == words["_block"]
    for i in range(WORDS):
        met = met & (F.getbit(words[f"_w{i}"], _bit(own, i)) == 1)
    return rows.where(rows[key].isNotNull()).join(words, met, "left_semi")
