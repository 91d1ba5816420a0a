"""SimHash near-duplicates with pigeonring filtering.

Fingerprints: 64 bits over the XXH64 (seed 42) of the word shingles of a text.  Two fingerprints link
when at most ``max_bits`` bits differ.  The 64 bits are cut into a ring of 3 * max_bits segments.  By the
pigeonring principle some segment of a linked pair starts a chain in which, for every length l, the
first l segments together differ in at most l * max_bits / segments bits.  The first three lengths of
that budget allow 0, 0 and (for two bits) 1 differing bits, so a candidate agrees on two consecutive
segments: those two are the key.  Longer chains are checked on the candidates, then the full distance.
A key of more than ``hot_rows`` fingerprints goes to no single task: its fingerprints are dealt by the
values within ``max_bits / 2`` bits of them (``centre_links``), where no group can be large.

Defined cases: NULL and empty texts and texts without words have fingerprint zero and link like any
other; a text shorter than one shingle is one shingle; repeated rows share a fingerprint and stay
separate rows; a NULL doc_id keeps its row and never names a component unless no id is known there.
Extra columns are not read, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.llm.common import frugal, partitions, written
from leadscope.llm.components import connected_components
from leadscope.plans.sizing import bounded_broadcast

LARGE_RUN = 2048
HOT_ROWS = 100_000     # fingerprints of one key that one task may link


def _word_lists(raw: bytes, block: int) -> Iterator[list[bytes]]:
    """The words of a text in lists of about ``block`` bytes, so a very long text is never one list."""
    if len(raw) <= block:
        yield raw.split()
        return
    at = 0
    while at < len(raw):
        cut = re.compile(rb"[\t-\r ]").search(raw, min(len(raw), at + block))
        end = cut.end() if cut else len(raw)
        yield raw[at:end].split()
        at = end


def _bit_counts(hashes: list[int]) -> np.ndarray:
    bits = np.unpackbits(np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.sum(axis=0, dtype=np.int64)


def fingerprint(text: str | None, width: int = 3, block: int = 1 << 20) -> int:
    """SimHash of one text: bit set where over half of the shingle hashes have it set."""
    raw = b"" if text is None else text.encode("utf-8", "surrogatepass").lower()
    ones, total, tail = np.zeros(64, np.int64), 0, []
    for words in _word_lists(raw, block):
        words = tail + words
        if len(words) >= width:
            joined = b" ".join(words)
            sizes = np.fromiter(map(len, words), np.int64, len(words))
            ends = np.cumsum(sizes + 1) - 1
            firsts, lasts = (ends - sizes)[:len(words) - width + 1].tolist(), ends[width - 1:].tolist()
            for i in range(0, len(firsts), 1 << 16):
                ones += _bit_counts([xxhash.xxh64_intdigest(joined[a:b], 42) for a, b in
                                     zip(firsts[i:i + (1 << 16)], lasts[i:i + (1 << 16)])])
            total += len(firsts)
        tail = words[len(words) - width + 1:] if len(words) >= width else words
    if total == 0:
        if not tail:
            return 0
        ones, total = _bit_counts([xxhash.xxh64_intdigest(b" ".join(tail), 42)]), 1
    return int(np.packbits(ones * 2 > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, width: int = 3, id_col: str = "doc_id", text_col: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """(doc_id, fp) per row, and its long columns ``keep``; fp holds the 64 bits as a signed long."""
    keep = keep or []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(t.as_py(), width) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64)), *batch.columns[2:]],
                                             names=["doc_id", "fp", *keep])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *keep).mapInArrow(
        frugal(run), ", ".join(f"{c} long" for c in ["doc_id", "fp", *keep]))


class Ring:
    """Segments of the 64-bit ring, the chain masks from each start and the budget of each length."""

    def __init__(self, max_bits: int) -> None:
        self.max_bits, self.count = max_bits, max(2, 3 * max_bits)
        cuts = [64 * i // self.count for i in range(self.count + 1)]
        self.segments = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
        self.budget = [(n * max_bits) // self.count for n in range(1, self.count + 1)]
        #: leading lengths that allow no difference: what a key must hold
        self.exact = max(1, sum(1 for b in self.budget if b == 0))

    def chain(self, start: int) -> list[int]:
        masks, mask = [], 0
        for n in range(self.count):
            mask |= self.segments[(start + n) % self.count]
            masks.append(mask)
        return masks


def _passes(a: np.ndarray, b: np.ndarray, chain: np.ndarray, budget: list[int]) -> np.ndarray:
    """chain: masks by length for each pair (lengths x pairs)."""
    ok = np.ones(len(a), bool)
    diff = a ^ b
    for masks, most in zip(chain, budget):
        ok &= np.bitwise_count(diff & masks) <= most
    return ok


class _Forest:
    """Union-find that reports only the links that join two trees."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = int(up[i])
        return i

    def add(self, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        while True:
            top = self.up[self.up]
            if np.array_equal(top, self.up):
                break
            self.up = top
        apart = self.up[left] != self.up[right]
        new = []
        for i, j in zip(left[apart].tolist(), right[apart].tolist()):
            a, b = self.find(i), self.find(j)
            if a != b:
                self.up[max(a, b)] = min(a, b)
                new.append((i, j))
        return new


def link_block(start: np.ndarray, key: np.ndarray, fp: np.ndarray, ring: Ring, large: int = LARGE_RUN
               ) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows sorted by (start, key), as a spanning forest of what links within each key.

    Short runs of one key compare shifted copies of the column; in runs over ``large`` rows each
    fingerprint looks up its neighbours by flipping bits, so the work stays linear in the run.
    """
    n = len(fp)
    forest, links = _Forest(n), []
    chains = np.array([ring.chain(s) for s in range(ring.count)], np.uint64)          # start x length
    fresh = np.ones(n, bool)
    fresh[1:] = (key[1:] != key[:-1]) | (start[1:] != start[:-1])
    run = np.cumsum(fresh) - 1
    first = np.flatnonzero(fresh)
    size = np.diff(np.append(first, n))
    big = size[run] > large
    left = np.flatnonzero(~big)
    for shift in range(1, int(size[size <= large].max(initial=1))):
        left = left[left + shift < n]
        left = left[run[left + shift] == run[left]]
        if not len(left):
            break
        ok = _passes(fp[left], fp[left + shift], chains[start[left]].T, ring.budget)
        links += forest.add(left[ok], left[ok] + shift)
    for r in np.flatnonzero(size > large).tolist():
        lo, hi = int(first[r]), int(first[r] + size[r])
        order = np.argsort(fp[lo:hi], kind="stable")
        values = fp[lo:hi][order]
        chain = chains[start[lo]]
        free = [b for b in range(64) if not int(chain[ring.exact - 1]) >> b & 1]
        for mask in _flips(free, ring.max_bits):
            want = values ^ np.uint64(mask)
            at = np.minimum(np.searchsorted(values, want), len(values) - 1)
            hit = np.flatnonzero((values[at] == want) & (np.arange(len(values)) < at))
            if len(hit):
                links += forest.add(lo + order[hit], lo + order[at[hit]])
    if not links:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    pairs = np.array(links)
    return fp[pairs[:, 0]], fp[pairs[:, 1]]


def _flips(bits: list[int], most: int, base: int = 0, at: int = 0) -> Iterator[int]:
    for i in range(at, len(bits)):
        mask = base | 1 << bits[i]
        yield mask
        if most > 1:
            yield from _flips(bits, most - 1, mask, i + 1)


def _linker(max_bits: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ring = Ring(max_bits)
        held: list[np.ndarray] = []

        def out(block: np.ndarray) -> pa.RecordBatch:
            a, b = link_block(block[0], block[1], block[2].view(np.uint64), ring)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            if sum(h.shape[1] for h in held) < rows:
                continue
            block = np.concatenate(held, axis=1)
            change = np.flatnonzero((block[0, 1:] != block[0, :-1]) | (block[1, 1:] != block[1, :-1]))
            cut = int(change[-1]) + 1 if len(change) else 0        # the last key may go on in the next batch
            if cut:
                yield out(block[:, :cut])
            held = [block[:, cut:]]
        if held:
            yield out(np.concatenate(held, axis=1))
    return run


def _signed(value: int):
    return F.lit(value - (1 << 64) if value >> 63 else value).cast("long")


def centre_links(fps: DataFrame, max_bits: int) -> DataFrame:
    """(a, b) links that connect all of the distinct ``fp`` within ``max_bits`` of each other, without keys.

    Two such values have a value (their centre) within half of ``max_bits``, rounded up, of one and down of
    the other.  Every value is dealt to all its centres; a centre's group is bounded by the number of its
    neighbours (65 for two bits), whatever the data, and is linked to its nearest member.
    """
    half = (max_bits + 1) // 2
    masks = F.array(*[_signed(m) for m in [0, *_flips(list(range(64)), half)]])
    centres = F.transform(masks, lambda m: F.struct(F.col("fp").bitwiseXOR(m).alias("centre"), F.bit_count(m).alias("away")))
    groups = (fps.select("fp", F.explode(centres).alias("c"))
              .select("c.centre", F.struct("c.away", "fp").alias("member"))
              .groupBy("centre").agg(F.collect_list("member").alias("members")).where(F.size("members") > 1))
    return (groups.select(F.array_min("members").alias("hub"), F.explode("members").alias("member"))
            .where((F.col("hub.fp") != F.col("member.fp")) & (F.col("hub.away") + F.col("member.away") <= max_bits))
            .select(F.col("hub.fp").alias("a"), F.col("member.fp").alias("b")))


def links(fps: DataFrame, max_bits: int = 2, block_rows: int = 200_000, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(a, b) links between distinct fingerprints that connect all within ``max_bits`` of each other."""
    spark = fps.sparkSession
    distinct = fps.select("fp").distinct()
    if max_bits < 1:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("a <> b")
    distinct = written(distinct, "simhash-distinct")
    ring = Ring(max_bits)
    keys = F.array(*[F.struct(F.lit(s).cast("long").alias("start"),
                              F.col("fp").bitwiseAND(_signed(ring.chain(s)[ring.exact - 1])).alias("key"))
                     for s in range(ring.count)])
    keyed = distinct.select("fp", F.explode(keys).alias("k")).select("k.start", "k.key", "fp")
    hot = written(keyed.groupBy("start", "key").agg(F.count("*").alias("n")).where(F.col("n") > hot_rows)
                  .select("start", "key"), "simhash-hot")
    more = None
    if not hot.isEmpty():
        hot = bounded_broadcast(hot)
        more = centre_links(keyed.join(hot, ["start", "key"], "left_semi").select("fp").distinct(), max_bits)
        keyed = keyed.join(hot, ["start", "key"], "left_anti").select("start", "key", "fp")
    found = (keyed.repartition(partitions(spark), "start", "key").sortWithinPartitions("start", "key", "fp")
             .mapInArrow(frugal(_linker(max_bits, block_rows)), "a long, b long"))
    return found if more is None else found.unionByName(more)


def near_duplicates(docs: DataFrame, width: int = 3, max_bits: int = 2, id_col: str = "doc_id",
                    text_col: str = "text", hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links)."""
    fps = written(fingerprints(docs, width, id_col, text_col), "simhash")
    roots = connected_components(links(fps, max_bits, hot_rows=hot_rows))
    classes = fps.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    placed = (classes.join(roots, classes["fp"] == roots["node"], "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    named = placed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_fp = placed.join(named, "root").select(F.col("fp").alias("class_fp"), "component_id")
    return (fps.join(by_fp, fps["fp"] == by_fp["class_fp"])
            .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"))


def first_rows(docs: DataFrame, width: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text",
               hot_rows: int = HOT_ROWS) -> DataFrame:
    """doc_id, version (XXH64 of the text): the first row of each component by these two, NULL ids last.

    Components are told apart by their links, so texts under one doc_id may be in several.
    """
    version = F.xxhash64(text_col).alias("version")
    hashed = fingerprints(docs.withColumn("__version", version), width, id_col, text_col, keep=["__version"])
    fps = written(hashed, "simhash")
    roots = connected_components(links(fps, max_bits, hot_rows=hot_rows))
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("__version").alias("version"))).alias("row")
    classes = fps.groupBy("fp").agg(best)
    placed = classes.join(roots, classes["fp"] == roots["node"], "left").withColumn("root", F.coalesce("root", "fp"))
    return placed.groupBy("root").agg(F.min("row").alias("row")).select("row.doc_id", "row.version")
