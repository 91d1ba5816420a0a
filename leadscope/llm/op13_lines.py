"""Line dedup over a sharded minimal perfect hash.

A line's key is the line without white space at both ends and with A-Z lower-cased.  Spark counts the
documents that hold each key by its 128-bit hash (each task counts its own first).  The hashes held by
enough documents go to shards by their leading bits; a shard's task builds a minimal perfect hash over
them (levels of bits: a level keeps the hashes that are alone in their place, the others go on to the
next) and writes it to the shared folder with a 64-bit fingerprint and a count for each slot.  Documents
then probe these arrays, memory-mapped by the workers: slot, fingerprint, count.  No line is joined.

A hash that is in no shard lands in some slot and fails its fingerprint; the fingerprint mixes both halves
of the hash, so a line is taken for another with a chance of 2**-64.

Defined cases: every row is a document, so repeated rows and rows with one id count and are answered each
for itself; NULL and empty texts are one empty line; lines of white space have an empty key and stay; of a
text whose lines all go, the empty text is left; an empty table gives no rows; other columns are ignored
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.llm.arrays import map_arrays, write_arrays
from leadscope.llm.common import WHITESPACE, mix64, text_groups, written
from leadscope.session import shared_path

_STEP = 0x9E3779B97F4A7C15


def _at_level(high: np.ndarray, low: np.ndarray, level: int, places: int) -> np.ndarray:
    seed = np.uint64((level + 1) * _STEP & (1 << 64) - 1)
    return (mix64(high ^ mix64(low + seed)) % np.uint64(places)).astype(np.int64)


def fingerprints(high: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix64(high * np.uint64(_STEP) + low)


def build(high: np.ndarray, low: np.ndarray, counts: np.ndarray, room: float = 2.0) -> dict[str, np.ndarray]:
    """The arrays of a shard: ``bits`` of all levels, ``rank`` (ones before each 64 bits), ``levels`` (first
    bit of each, and the end), and by slot ``fingerprint`` and ``count``.  The hashes are distinct."""
    words, levels, keys = [], [0], np.arange(len(high))
    level = 0
    while len(keys):
        places = -(-max(64, int(room * len(keys))) // 64) * 64
        place = _at_level(high[keys], low[keys], level, places)
        alone = np.bincount(place, minlength=places) == 1
        words.append(np.packbits(alone, bitorder="little").view(np.uint64))
        levels.append(levels[-1] + places)
        keys = keys[~alone[place]]
        level += 1
    bits = np.concatenate(words) if words else np.zeros(0, np.uint64)
    ones = np.bitwise_count(bits).astype(np.uint32)
    out = {"bits": bits, "rank": (np.cumsum(ones, dtype=np.uint32) - ones), "levels": np.array(levels, np.int64)}
    slot = slots(out, high, low)
    fingerprint, count = np.zeros(len(high), np.uint64), np.zeros(len(high), counts.dtype)
    fingerprint[slot], count[slot] = fingerprints(high, low), counts
    return {**out, "fingerprint": fingerprint, "count": count}


def slots(shard: dict[str, np.ndarray], high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The slot of each hash, a number of its own for those the shard was built over; -1 where no level has it."""
    out = np.full(len(high), -1, np.int64)
    keys = np.arange(len(high))
    levels = shard["levels"].tolist()
    for level, (first, end) in enumerate(zip(levels, levels[1:])):
        place = first + _at_level(high[keys], low[keys], level, end - first)
        word, bit = place >> 6, (place & 63).astype(np.uint64)
        value = shard["bits"][word]
        here = (value >> bit & np.uint64(1)).astype(bool)
        below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1)))
        out[keys[here]] = (shard["rank"][word] + below)[here]
        keys = keys[~here]
        if not len(keys):
            break
    return out


def lookup(shard: dict[str, np.ndarray], high: np.ndarray, low: np.ndarray) -> np.ndarray:
    """The count of each hash, 0 for those that the shard does not hold."""
    if not len(shard["count"]):
        return np.zeros(len(high), np.int64)
    slot = slots(shard, high, low)
    same = (slot >= 0) & (shard["fingerprint"][slot] == fingerprints(high, low))
    return np.where(same, shard["count"][slot], 0).astype(np.int64)


def line_hashes(raw_texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lines of each text; of all lines one after the other: number of the text, whether the key is empty,
    and the hash's two halves (zeros where empty)."""
    lines = [raw.split(b"\n") for raw in raw_texts]
    owner = np.repeat(np.arange(len(lines)), [len(part) for part in lines])
    digest, none = xxhash.xxh3_128_digest, bytes(16)
    joined = b"".join([digest(key) if (key := line.strip(WHITESPACE)) else none
                       for raw in raw_texts for line in raw.lower().split(b"\n")])
    halves = np.frombuffer(joined, ">u8").astype(np.uint64).reshape(-1, 2)
    high, low = halves[:, 0].copy(), halves[:, 1].copy()
    return lines, owner, (high == 0) & (low == 0), high, low


def line_counts(docs: DataFrame, text_col: str = "text", flush: int = 1 << 20) -> DataFrame:
    """(high, low, n): number of documents that hold each line key, by the two halves of its hash."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def packed(final: bool) -> pa.RecordBatch:
            rows = np.concatenate(held, axis=1)
            rows = rows[:, np.lexsort((rows[1], rows[0]))]
            fresh = np.ones(rows.shape[1], bool)
            fresh[1:] = (rows[0, 1:] != rows[0, :-1]) | (rows[1, 1:] != rows[1, :-1])
            first = np.flatnonzero(fresh)
            n = np.add.reduceat(rows[2], first) if len(first) else rows[2]
            held[:] = [np.stack([rows[0, first], rows[1, first], n])]
            return pa.RecordBatch.from_arrays([pa.array(c.view(np.int64)) for c in held[0]], names=["high", "low", "n"])

        for batch in batches:
            for _, _, raw in text_groups([t.as_py() for t in batch.column(0)]):
                _, owner, empty, high, low = line_hashes(raw)
                order = np.lexsort((low, high, owner))
                order = order[~empty[order]]
                own, high, low = owner[order], high[order], low[order]
                fresh = np.ones(len(order), bool)                     # once per document
                fresh[1:] = (own[1:] != own[:-1]) | (high[1:] != high[:-1]) | (low[1:] != low[:-1])
                held.append(np.stack([high[fresh], low[fresh], np.ones(int(fresh.sum()), np.uint64)]))
                if sum(h.shape[1] for h in held) >= flush:
                    out = packed(False)
                    if held[0].shape[1] >= flush // 2:                # mostly distinct: pass them on
                        yield out
                        held.clear()
        if held:
            yield packed(True)

    return (docs.select(F.col(text_col).alias("text")).mapInArrow(run, "high long, low long, n long")
            .groupBy("high", "low").agg(F.sum("n").alias("n")))


class LineIndex:
    """Where the shards lie: shard ``s`` holds the hashes whose leading ``bits`` bits are ``s``."""

    def __init__(self, place: str, bits: int, present: frozenset[int]) -> None:
        self.place, self.bits, self.present = place, bits, present

    def uri(self, shard: int) -> str:
        return f"{self.place}/{shard:06d}.arrays"

    def counts(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Number of documents of each hash, 0 where it is not in the index."""
        out = np.zeros(len(high), np.int64)
        shard = (high >> np.uint64(64 - self.bits)).astype(np.int64) if self.bits else np.zeros(len(high), np.int64)
        order = np.argsort(shard, kind="stable")
        names, first = np.unique(shard[order], return_index=True)
        for name, a, b in zip(names.tolist(), first, [*first[1:], len(order)]):
            if name in self.present:
                part = order[a:b]
                out[part] = lookup(map_arrays(self.uri(name)), high[part], low[part])
        return out


def build_index(docs: DataFrame, least: int = 2, text_col: str = "text", shard_keys: int = 1 << 20) -> LineIndex:
    """The index of all line keys that at least ``least`` documents hold, in shards of about ``shard_keys``
    (hashes are spread evenly, so no shard is much larger)."""
    spark = docs.sparkSession
    wanted = written(line_counts(docs, text_col).where(F.col("n") >= least), "line-counts")
    total = wanted.count()
    bits = max(0, -(-total // shard_keys) - 1).bit_length()
    index = LineIndex(shared_path(spark, "llm", "line-index"), bits, frozenset())
    shard = F.shiftrightunsigned("high", 64 - bits) if bits else F.lit(0).cast("long")

    def run(table: pa.Table) -> pa.Table:
        high, low, n = (table.column(c).to_numpy() for c in ("high", "low", "n"))
        name = table.column("shard")[0].as_py()
        kind = next(k for k in (np.uint8, np.uint16, np.uint32, np.int64) if n.max() <= np.iinfo(k).max)
        write_arrays(index.uri(name), build(high.view(np.uint64), low.view(np.uint64), n.astype(kind)))
        return pa.table({"shard": pa.array([name], pa.int64())})

    built = (wanted.withColumn("shard", shard).repartition(1 << bits, "shard")
             .groupBy("shard").applyInArrow(run, "shard long"))
    index.present = frozenset(r[0] for r in built.collect())          # shard numbers only
    return index


def cleaned(docs: DataFrame, index: LineIndex, least: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_dropped, text: each document without its lines that the index counts in at least
    ``least`` documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, raw in text_groups([t.as_py() for t in batch.column(1)]):
                lines, owner, empty, high, low = line_hashes(raw)
                gone = index.counts(high, low) >= least
                gone &= ~empty
                n_lines = np.bincount(owner, minlength=len(raw))
                n_gone = np.bincount(owner, weights=gone, minlength=len(raw)).astype(np.int64)
                first = np.cumsum(n_lines) - n_lines
                texts = [whole if not n else b"\n".join([line for line, g in zip(part, gone[f:f + len(part)]) if not g])
                         for whole, part, n, f in zip(raw, lines, n_gone.tolist(), first.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(n_lines.astype(np.int64)), pa.array(n_gone),
                     pa.array(texts, pa.binary()).cast(pa.string(), safe=False)],
                    names=["doc_id", "n_lines", "n_dropped", "text"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_lines long, n_dropped long, text string")


def deduplicate(docs: DataFrame, least: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``cleaned`` with an index over the documents themselves."""
    return cleaned(docs, build_index(docs, least, text_col), least, id_col, text_col)
