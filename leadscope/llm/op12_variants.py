"""Spelling variants: words one code point apart, found through a dictionary of trie-node pairs.

All words form a trie, and all reversed words another; their nodes are numbered.  A word without its code
point i is the pair (forward node before i, backward node after i); a word with a gap before i is the pair
(forward node before i, backward node from i).  Two words that differ by one replaced code point share a
pair that skips it; a word with one code point more shares its skipping pair with the shorter word's gap.
Pairs are two integers, and those equal give exactly the words that are near, without a distance check.
A longer word reaches a shorter one from each place of a run of equal code points; only the run's first
place counts, so every near pair is met in one pair of nodes only.

Numbers: a node of depth ``63 // bits`` or less is its letters packed into one integer.  Deeper nodes are
numbered from below zero while the sorted words stream by, each node where it first occurs; words are dealt
by range of their packed head, so all words below a deep node pass through one task in order.

A pair of nodes has at most one gap and as many skips as the alphabet has letters, so no group of the
dictionary can be larger, whatever the words.  Words are numbered by falling count and rising code points:
the best of some words is the smallest number.

Defined cases: NULL texts have no runs; a NULL id reads as empty text in the draw of damaged runs; runs of
any length are whole; repeated rows count again; an empty table gives no rows; other columns are ignored
whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.llm.common import partitions, written

#: Lower-case letters of the Latin-1 words; A-Z are lower-cased before.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
_FAR = np.iinfo(np.int64).max
_SKIP, _FIRST_SKIP, _GAP = 0, 1, 2          # kinds of an entry; the first place of a run of equal letters


def _pieces(text: str, inside: re.Pattern, size: int = 1 << 20) -> Iterator[str]:
    """The text in pieces of about ``size``, cut outside of runs."""
    at = 0
    while len(text) - at > size:
        end = at + size
        while end < len(text) and inside.match(text, end):
            end += 1
        yield text[at:end]
        at = end
    yield text[at:]


def word_counts(docs: DataFrame, letters: str = LETTERS, least_length: int = 5, least_count: int = 3,
                damage: int = 0, id_col: str = "doc_id", text_col: str = "text", flush: int = 200_000) -> DataFrame:
    """(word, n): maximal runs of ``letters`` after lower-casing A-Z, of at least ``least_length`` code points
    and ``least_count`` occurrences.  ``damage`` > 0 takes one code point out of the runs whose crc32 of
    ``<id>:<run>`` it divides."""
    run_of = re.compile(f"[{re.escape(letters)}]{{{max(1, least_length)},}}")
    inside = re.compile(f"[{re.escape(letters)}]")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def packed() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                                              names=["word", "n"])

        for batch in batches:
            for doc, value in zip(batch.column(0), batch.column(1)):
                text = value.as_py()
                if not text:
                    continue
                start = zlib.crc32(f"{doc.as_py() or ''}:".encode())
                low = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                for piece in _pieces(low, inside):
                    for word, n in Counter(run_of.findall(piece)).items():
                        if damage:
                            h = zlib.crc32(word.encode(), start)
                            if h % damage == 0:
                                k = h % len(word)
                                word = word[:k] + word[k + 1:]
                                if len(word) < least_length:
                                    continue
                        held[word] += n
                    if len(held) >= flush:
                        yield packed()
                        held.clear()
        if held:
            yield packed()

    found = docs.select(F.col(id_col).cast("string").alias("doc"), F.col(text_col).alias("text"))
    return (found.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= least_count))


class _Trie:
    """Numbers the nodes of sorted words: for each word the nodes of its prefixes, the empty one first."""

    def __init__(self, symbols: dict[str, int], bits: int, task: int) -> None:
        self.symbols, self.bits, self.shallow = symbols, bits, 63 // bits
        self.last, self.nodes, self.next = "", [0], -1 - (task << 33)

    def add(self, word: str) -> list[int]:
        same, most = 0, min(len(word), len(self.last))
        while same < most and word[same] == self.last[same]:
            same += 1
        nodes = self.nodes[:same + 1]
        for i in range(same, len(word)):
            if i < self.shallow:
                nodes.append(nodes[i] << self.bits | self.symbols[word[i]])
            else:
                nodes.append(self.next)
                self.next -= 1
        self.last, self.nodes = word, nodes
        return nodes


def _symbols(letters: str) -> tuple[dict[str, int], int]:
    symbols = {c: i + 1 for i, c in enumerate(sorted(set(letters)))}
    return symbols, max(1, len(symbols).bit_length())


def _forward(words: DataFrame, letters: str) -> DataFrame:
    """(id, word, nodes): the forward nodes of each word."""
    symbols, bits = _symbols(letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _Trie(symbols, bits, TaskContext.get().partitionId())
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                nodes = [trie.add(w) for w in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(nodes, pa.list_(pa.int64()))],
                                                 names=["id", "word", "nodes"])

    head = F.substring("word", 1, 63 // bits)
    dealt = words.select("id", "word").repartitionByRange(partitions(words.sparkSession), head)
    return dealt.sortWithinPartitions("word").mapInArrow(run, "id long, word string, nodes array<long>")


def _ranges(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place within the owner) of items dealt by ``sizes``."""
    owner = np.repeat(np.arange(len(sizes)), sizes)
    return owner, np.arange(len(owner)) - (np.cumsum(sizes) - sizes)[owner]


def _pairs(forward: DataFrame, letters: str) -> DataFrame:
    """(before, after, entry): the node pairs of all words; entry is the word's id and the entry's kind."""
    symbols, bits = _symbols(letters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _Trie(symbols, bits, TaskContext.get().partitionId())
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                turned = [w[::-1] for w in part.column(1).to_pylist()]
                after = np.concatenate([trie.add(w) for w in turned]).astype(np.int64)
                before = part.column(2).flatten().to_numpy(zero_copy_only=False)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                size = np.fromiter(map(len, turned), np.int64, len(turned))
                first = np.cumsum(size + 1) - (size + 1)             # of each word's nodes
                points = np.frombuffer("".join(w[::-1] for w in turned).encode("utf-32-le"), np.uint32)
                word, place = _ranges(size)
                fresh = np.ones(len(points), bool)
                fresh[1:] = (points[1:] != points[:-1]) | (place[1:] == 0)
                gap_word, gap_place = _ranges(size + 1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([before[first[word] + place], before[first[gap_word] + gap_place]])),
                     pa.array(np.concatenate([after[first[word] + size[word] - place - 1],
                                              after[first[gap_word] + size[gap_word] - gap_place]])),
                     pa.array(np.concatenate([ids[word] * 4 + np.where(fresh, _FIRST_SKIP, _SKIP), ids[gap_word] * 4 + _GAP]))],
                    names=["before", "after", "entry"])

    turned = F.reverse("word")
    dealt = forward.repartitionByRange(partitions(forward.sparkSession), F.substring(turned, 1, 63 // bits))
    return dealt.sortWithinPartitions(turned).mapInArrow(run, "before long, after long, entry long")


def near_in_groups(group: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(id, number of near words, best near word) of the entries that have one; entries sorted by group."""
    fresh = np.ones(len(group), bool)
    fresh[1:] = group[1:] != group[:-1]
    first = np.flatnonzero(fresh)
    at = np.cumsum(fresh) - 1
    ids, kind = entry >> 2, entry & 3
    gap, lead = kind == _GAP, kind == _FIRST_SKIP
    skips = np.add.reduceat((~gap).astype(np.int64), first)
    leads = np.add.reduceat(lead.astype(np.int64), first)
    skip_ids, lead_ids = np.where(gap, _FAR, ids), np.where(lead, ids, _FAR)
    best = np.minimum.reduceat(skip_ids, first)
    second = np.minimum.reduceat(np.where(skip_ids == best[at], _FAR, skip_ids), first)
    best_lead, gap_id = np.minimum.reduceat(lead_ids, first), np.minimum.reduceat(np.where(gap, ids, _FAR), first)
    other = np.where(skip_ids == best[at], second[at], best[at])
    count = np.where(gap, leads[at], skips[at] - 1 + (lead & (gap_id[at] < _FAR)))
    near = np.where(gap, best_lead[at], np.where(lead, np.minimum(other, gap_id[at]), other))
    hit = count > 0
    return ids[hit], count[hit], near[hit]


def _near(pairs: DataFrame) -> DataFrame:
    """(id, n_near, near): number of near words and the best of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros((3, 0), np.int64)

        def out(block: np.ndarray) -> pa.RecordBatch:
            change = (block[0, 1:] != block[0, :-1]) | (block[1, 1:] != block[1, :-1])
            found = near_in_groups(np.concatenate([[0], np.cumsum(change)]), block[2])
            return pa.RecordBatch.from_arrays([pa.array(f) for f in found], names=["id", "n_near", "near"])

        for batch in batches:
            block = np.concatenate([held, np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])], axis=1)
            cut = np.flatnonzero((block[0, 1:] != block[0, :-1]) | (block[1, 1:] != block[1, :-1]))
            cut = int(cut[-1]) + 1 if len(cut) else 0             # the last group may go on in the next batch
            if cut:
                yield out(block[:, :cut])
            held = block[:, cut:]
        if held.shape[1]:
            yield out(held)

    dealt = pairs.repartition(partitions(pairs.sparkSession), "before", "after").sortWithinPartitions("before", "after")
    found = dealt.mapInArrow(run, "id long, n_near long, near long")
    return found.groupBy("id").agg(F.sum("n_near").alias("n_near"), F.min("near").alias("near"))


def _roots(forms: DataFrame, most: int) -> DataFrame:
    """(id, root) for each (id, form).  Every form's count is at least twice its word's and ``most`` is the
    largest count, which bounds the chains; each round doubles the steps taken."""
    steps = forms.select("id", F.col("form").alias("root"))
    for _ in range(max(1, max(1, most).bit_length() - 1).bit_length()):
        onward = steps.select(F.col("id").alias("root"), F.col("root").alias("further"))
        steps = written(steps.join(onward, "root", "left").select("id", F.coalesce("further", "root").alias("root")),
                        "spelling-roots")
    return steps


def variants(words: DataFrame, letters: str = LETTERS, ratio: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for a table of distinct words of ``letters`` and their counts.

    A word's form is its near word of largest count (ties: smallest word) if that is at least ``ratio`` (2 or
    more) times its own; root is the last form reached from it.
    """
    if ratio < 2:
        raise ValueError("a ratio under 2 does not bound the chains of forms")
    # ids rise with the global order: by falling count, then by word
    known = written(words.select("word", F.col("n").cast("long").alias("n")).orderBy(F.desc("n"), "word")
                    .select(F.monotonically_increasing_id().alias("id"), "word", "n"), "spelling-words")
    near = _near(_pairs(written(_forward(known, letters), "spelling-nodes"), letters))
    best = known.select(F.col("id").alias("near"), F.col("word").alias("near_word"), F.col("n").alias("near_n"))
    is_form = F.col("near_n") >= F.lit(ratio) * F.col("n")
    linked = written(known.join(near, "id", "left").join(best, "near", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("near")).alias("form_id"), F.when(is_form, F.col("near_word")).alias("form"),
        F.when(is_form, F.col("near_n")).alias("form_n")), "spelling-links")
    most = known.agg(F.max("n")).first()[0]
    roots = _roots(linked.where("form_id is not null").select("id", F.col("form_id").alias("form")), most or 1)
    named = roots.join(known.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root").select("id", "root_word")
    return (linked.join(named, "id", "left")
            .select("word", "form", F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n"))
