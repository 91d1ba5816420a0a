"""Interpolated modified Kneser-Ney language model, counted in Spark.

A bigram model over lower-cased words and an end-of-text token.  Counting runs in three shuffles, each
over what the tasks have already added up, packed by bucket:

1. words: exact counts, for the baseline and for the share of each context;
2. word pairs by context: counts, and per context its total and how many pairs occur once, twice, more
   often.  A context with more than its share of the corpus spreads over several buckets;
3. continuations: in how many different contexts a word occurs (from the distinct pairs of step 2).

Each bucket ends as one file of sorted 64-bit hashes with their counts in the shared checkpoint folder.
Scoring tasks map these files into memory and look their sorted, distinct pairs up.

Order: two.  The distinct word triples of prose are nearly as many as its words; shuffling and storing
them takes more disk than the budget this was built for (README).

Defined cases: NULL text is empty (one token, the end); rows without an id are never learned from and
count as held out; no training row at all gives the uniform model; repeated rows count each time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadscope.llm.arrays import map_arrays, write_arrays
from leadscope.llm.common import PolynomialHash, crc_bucket, mix64, partitions, text_groups, word_hashes
from leadscope.session import shared_path

START, STOP = np.uint64(0x5354415254), np.uint64(0x53544F50)      # context and token without a word
_STEP = np.uint64(0x9E3779B97F4A7C15)
PACKED = "bucket long, packed binary"


def _pack(*arrays: np.ndarray) -> bytes:
    sizes = np.array([len(arrays), *(a.nbytes for a in arrays)], np.int64)
    return zstandard.ZstdCompressor(level=3).compress(b"".join([sizes.tobytes(), *(a.tobytes() for a in arrays)]))


def _unpack(packed: bytes, *kinds: type) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    sizes, at, out = np.frombuffer(raw, np.int64, 1 + len(kinds)), 8 * (1 + len(kinds)), []
    for kind, size in zip(kinds, sizes[1:].tolist()):
        out.append(np.frombuffer(raw, kind, size // np.dtype(kind).itemsize, at))
        at += size
    return out


def _by_bucket(bucket: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(bucket, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sorted distinct keys, summed counts, a row of each key)."""
    order = np.argsort(keys, kind="stable")
    ranked = keys[order]
    lead = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]])) if len(ranked) else np.zeros(0, np.int64)
    total = np.add.reduceat(counts[order].astype(np.int64), lead) if len(lead) else np.zeros(0, np.int64)
    return ranked[lead], total, order[lead]


def _small(counts: np.ndarray) -> dict[str, np.ndarray]:
    """Counts as one byte each, with the rare larger ones on the side."""
    large = np.flatnonzero(counts >= 255)
    return {"count": np.minimum(counts, 255).astype(np.uint8), "large_at": large, "large": counts[large]}


def _lookup(shard: dict[str, np.ndarray], key: str, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, found) of sorted wanted keys in the shard's sorted hash array."""
    keys = shard[key]
    at = np.searchsorted(keys, wanted)
    found = at < len(keys)
    found[found] = keys[at[found]] == wanted[found]
    return at, found


def _counts(shard: dict[str, np.ndarray], key: str, wanted: np.ndarray) -> np.ndarray:
    at, found = _lookup(shard, key, wanted)
    out = np.zeros(len(wanted), np.int64)
    out[found] = shard["count"][at[found]]
    big = np.flatnonzero(out == 255)
    if len(big):
        out[big] = shard["large"][np.searchsorted(shard["large_at"], at[big])]
    return out


def _count_of_counts(counts: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum(counts, 5), minlength=6)[1:5].astype(np.int64)


def discounts(n: np.ndarray) -> np.ndarray:
    """D1, D2, D3+ of modified Kneser-Ney from the counts of counts n1..n4.

    An estimate outside of (0, k) – corpora of copies have few counts of one – gives way to the absolute
    discount n1 / (n1 + 2 n2), and that to a half: every discount is positive and below its count, so every
    context keeps mass for unseen words and every score is finite.
    """
    n1, n2, n3, n4 = (float(x) for x in n)
    y = n1 / (n1 + 2 * n2) if n1 + n2 else 0.0
    absolute = y if 0 < y < 1 else 0.5
    raw = [1 - 2 * y * n2 / n1 if n1 else 0.0, 2 - 3 * y * n3 / n2 if n2 else 0.0, 3 - 4 * y * n4 / n3 if n3 else 0.0]
    return np.array([d if 0 < d < k else absolute for k, d in enumerate(raw, 1)])


def discount_of(counts: np.ndarray, d: np.ndarray) -> np.ndarray:
    return np.concatenate([[0.0], d])[np.minimum(counts, 3)]


def pair_hash(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a pair; of the word, the upper 56 bits of its hash."""
    return mix64(context * _STEP + (word >> np.uint64(8)))


@dataclass
class Tokens:
    """Word hashes of a group of texts with the end tokens, and the context of each."""
    word: np.ndarray
    context: np.ndarray
    counts: np.ndarray

    @classmethod
    def of(cls, raws: list[bytes], hasher: PolynomialHash) -> Tokens:
        hashes, n_words = word_hashes(raws, hasher)
        counts = n_words + 1
        ends = np.cumsum(counts)
        word = np.empty(int(ends[-1]), np.uint64)
        stops = np.zeros(len(word), bool)
        stops[ends - 1] = True
        word[~stops], word[stops] = hashes, STOP
        context = np.concatenate([[START], word[:-1]])
        context[(ends - counts)] = START
        return cls(word, context, counts)


@dataclass
class Model:
    """Where the arrays lie, and the totals that do not grow with the corpus."""
    folder: str
    buckets: int
    follow_buckets: int
    tokens: int = 0
    words: int = 0
    pairs: int = 0
    pair_d: np.ndarray = field(default_factory=lambda: np.zeros(3))
    word_d: np.ndarray = field(default_factory=lambda: np.zeros(3))
    word_n: np.ndarray = field(default_factory=lambda: np.zeros(3))
    hot: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))          # sorted contexts
    pieces: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint64))       # buckets of each
    hot_stats: np.ndarray = field(default_factory=lambda: np.zeros((0, 4), np.int64))
    filled: dict[str, np.ndarray] = field(default_factory=dict)                      # buckets with a file

    def file(self, kind: str, bucket: int) -> str:
        return f"{self.folder}/{kind}-{bucket}"

    def pair_bucket(self, context: np.ndarray, pair: np.ndarray) -> np.ndarray:
        split = np.ones(len(context), np.uint64)
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, context), len(self.hot) - 1)
            split = np.where(self.hot[at] == context, self.pieces[at], split)
        return (mix64(context + pair % split * _STEP) % np.uint64(self.buckets)).astype(np.int64)


def _word_packer(buckets: int, group_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PolynomialHash()
        for batch in batches:
            for _, _, raws in text_groups(batch.column(0).to_pylist(), group_bytes):
                keys, counts = np.unique(Tokens.of(raws, hasher).word, return_counts=True)
                parts = _by_bucket((keys % np.uint64(buckets)).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(keys[p[0]] % np.uint64(buckets)) for p in parts], pa.int64()),
                     pa.array([_pack(np.diff(keys[p], prepend=np.uint64(0)), counts[p].astype(np.uint32)) for p in parts],
                              pa.binary())], names=["bucket", "packed"])
    return run


def _joined(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = zip(*(_unpack(p, np.uint64, np.uint32) for p in table.column("packed").to_pylist()))
    return np.concatenate([np.cumsum(k, dtype=np.uint64) for k in keys]), np.concatenate(counts)


def _word_reducer(model: Model, most: int = 16) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        keys, total, _ = _summed(*_joined(table))
        write_arrays(model.file("word", bucket), {"key": keys, **_small(total)})
        top = np.argsort(-total, kind="stable")[:most]
        stats = np.array([total.sum(), len(keys)], np.int64)
        return pa.Table.from_arrays([pa.array([bucket]), pa.array([_pack(stats, keys[top], total[top])], pa.binary())],
                                    names=["bucket", "packed"])
    return run


def _pair_packer(model: Model, group_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PolynomialHash()
        for batch in batches:
            for _, _, raws in text_groups(batch.column(0).to_pylist(), group_bytes):
                tokens = Tokens.of(raws, hasher)
                pair, first, counts = np.unique(pair_hash(tokens.context, tokens.word), return_index=True, return_counts=True)
                context, word = tokens.context[first], tokens.word[first]
                order = np.argsort(context, kind="stable")
                pair, context, word, counts = pair[order], context[order], word[order], counts[order].astype(np.uint32)
                bucket, numbers, blobs = model.pair_bucket(context, pair), [], []
                for p in _by_bucket(bucket):
                    contexts, runs = np.unique(context[p], return_counts=True)
                    tail = np.ascontiguousarray(word[p] >> np.uint64(8)).view(np.uint8).reshape(-1, 8)[:, :7]
                    numbers.append(int(bucket[p[0]]))
                    blobs.append(_pack(np.diff(contexts, prepend=np.uint64(0)), runs.astype(np.uint32), tail.ravel(), counts[p]))
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary())],
                                                 names=["bucket", "packed"])
    return run


def _pair_reducer(model: Model) -> Callable:
    """Writes the pairs and contexts of a bucket; passes on continuations by word and, under a negative
    number of its own, the bucket's counts of counts and parts of hot contexts."""
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        contexts, words, counts = [], [], []
        for packed in table.column("packed").to_pylist():
            context, runs, tail, count = _unpack(packed, np.uint64, np.uint32, np.uint8, np.uint32)
            wide = np.zeros((len(count), 8), np.uint8)
            wide[:, :7] = tail.reshape(-1, 7)
            contexts.append(np.repeat(np.cumsum(context, dtype=np.uint64), runs))
            words.append(wide.view(np.uint64).ravel())
            counts.append(count)
        context, word = np.concatenate(contexts), np.concatenate(words)
        pair, total, row = _summed(mix64(context * _STEP + word), np.concatenate(counts))
        context, word = context[row], word[row]
        write_arrays(model.file("pair", bucket), {"key": pair, **_small(total)})
        order = np.argsort(context, kind="stable")
        keys, lead = np.unique(context[order], return_index=True)
        ranked = total[order]
        stats = np.stack([np.add.reduceat(v.astype(np.int64), lead) for v in
                          (ranked, ranked == 1, ranked == 2, ranked >= 3)], axis=1)
        hot = np.isin(keys, model.hot)
        write_arrays(model.file("context", bucket), {
            "key": keys[~hot], "total": stats[~hot, 0], "n1": stats[~hot, 1].astype(np.uint32),
            "n2": stats[~hot, 2].astype(np.uint32), "n3": stats[~hot, 3].astype(np.uint32)})
        numbers = [-1 - bucket]
        blobs = [_pack(_count_of_counts(total), np.array([len(pair)], np.int64), np.array([bucket], np.int64),
                       keys[hot], np.ascontiguousarray(stats[hot]).ravel())]
        follows, times = np.unique(word, return_counts=True)
        to = (mix64(follows) % np.uint64(model.follow_buckets)).astype(np.int64)
        for p in _by_bucket(to):
            numbers.append(int(to[p[0]]))
            blobs.append(_pack(np.diff(follows[p], prepend=np.uint64(0)), times[p].astype(np.uint32)))
        return pa.Table.from_arrays([pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary())], names=["bucket", "packed"])
    return run


def _follow_reducer(model: Model) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket < 0:
            return table.select(["bucket", "packed"])
        keys, total, _ = _summed(*_joined(table))
        write_arrays(model.file("follow", bucket), {"key": keys, **_small(total)})
        d = np.array([(total == 1).sum(), (total == 2).sum(), (total >= 3).sum()], np.int64)
        return pa.Table.from_arrays([pa.array([bucket]), pa.array([_pack(_count_of_counts(total), d)], pa.binary())],
                                    names=["bucket", "packed"])
    return run


def train(texts: DataFrame, group_bytes: int = 16 << 20, split: int = 8) -> Model:
    """Count the model over the column ``text``.  To the driver come a few numbers per bucket and the
    at most 16 most frequent words of each."""
    spark = texts.sparkSession
    texts = texts.select("text")
    # pairs are many and get small buckets; each of those sends one packed row to every bucket of words
    model = Model(shared_path(spark, "llm", "ngram"), 4 * partitions(spark), max(1, partitions(spark) // 4))
    rows = (texts.mapInArrow(_word_packer(model.buckets, group_bytes), PACKED)
            .groupBy("bucket").applyInArrow(_word_reducer(model), PACKED).collect())
    hot, shares = [], []
    for r in rows:
        stats, keys, total = _unpack(bytes(r["packed"]), np.int64, np.uint64, np.int64)
        model.tokens += int(stats[0])
        model.words += int(stats[1])
        hot.append(keys)
        shares.append(total)
    model.filled["word"] = np.array(sorted(r["bucket"] for r in rows), np.int64)
    if rows:
        hot, shares = np.concatenate([*hot, [START]]), np.concatenate([*shares, [texts.count()]])
        pieces = -(-shares * model.buckets * split // max(1, model.tokens))
        large = (pieces > 1) & (hot != STOP)
        order = np.argsort(hot[large])
        model.hot, model.pieces = hot[large][order], pieces[large][order].astype(np.uint64)
    rows = (texts.mapInArrow(_pair_packer(model, group_bytes), PACKED)
            .groupBy("bucket").applyInArrow(_pair_reducer(model), PACKED)
            .groupBy("bucket").applyInArrow(_follow_reducer(model), PACKED).collect())
    pair_n, word_n, model.hot_stats = np.zeros(4, np.int64), np.zeros(4, np.int64), np.zeros((len(model.hot), 4), np.int64)
    d_n, pair_buckets, follow_buckets = np.zeros(3, np.int64), [], []
    for r in rows:
        if r["bucket"] < 0:
            n, pairs, bucket, keys, stats = _unpack(bytes(r["packed"]), np.int64, np.int64, np.int64, np.uint64, np.int64)
            pair_n = pair_n + n
            model.pairs += int(pairs[0])
            pair_buckets += bucket.tolist()
            np.add.at(model.hot_stats, np.searchsorted(model.hot, keys), stats.reshape(-1, 4))
        else:
            n, d = _unpack(bytes(r["packed"]), np.int64, np.int64)
            word_n, d_n = word_n + n, d_n + d
            follow_buckets.append(r["bucket"])
    model.filled["pair"] = model.filled["context"] = np.array(sorted(pair_buckets), np.int64)
    model.filled["follow"] = np.array(sorted(follow_buckets), np.int64)
    model.pair_d, model.word_d, model.word_n = discounts(pair_n), discounts(word_n), d_n
    return model


class Scorer:
    """Looks tokens up in the memory-mapped arrays."""

    def __init__(self, model: Model) -> None:
        self.model, self.hasher = model, PolynomialHash()

    def _each(self, kind: str, keys: np.ndarray, bucket: np.ndarray, look: Callable, out: np.ndarray) -> np.ndarray:
        for rows in _by_bucket(bucket):
            b = int(bucket[rows[0]])
            at = np.searchsorted(self.model.filled[kind], b)
            if at < len(self.model.filled[kind]) and self.model.filled[kind][at] == b:
                rows = rows[np.argsort(keys[rows], kind="stable")]
                out[rows] = look(map_arrays(self.model.file(kind, b)), keys[rows])
        return out

    def _context(self, keys: np.ndarray) -> np.ndarray:
        """total, n1, n2, n3+ of distinct contexts."""
        def look(shard: dict[str, np.ndarray], wanted: np.ndarray) -> np.ndarray:
            at, found = _lookup(shard, "key", wanted)
            out = np.zeros((len(wanted), 4), np.int64)
            for k, name in enumerate(("total", "n1", "n2", "n3")):
                out[found, k] = shard[name][at[found]]
            return out
        m = self.model
        zero = np.zeros(len(keys), np.uint64)
        plain = (mix64(keys + zero * _STEP) % np.uint64(m.buckets)).astype(np.int64)
        out = self._each("context", keys, plain, look, np.zeros((len(keys), 4), np.int64))
        if len(m.hot):
            at = np.minimum(np.searchsorted(m.hot, keys), len(m.hot) - 1)
            hot = m.hot[at] == keys
            out[hot] = m.hot_stats[at[hot]]
        return out

    def score(self, raws: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, known tokens, baseline, model log10 probability) of each text."""
        m, t = self.model, Tokens.of(raws, self.hasher)
        look = lambda shard, wanted: _counts(shard, "key", wanted)
        size = np.uint64(m.buckets)

        words, word_of = np.unique(t.word, return_inverse=True)
        count = self._each("word", words, (words % size).astype(np.int64), look, np.zeros(len(words), np.int64))
        follow_keys = words >> np.uint64(8)
        follow = self._each("follow", follow_keys, (mix64(follow_keys) % np.uint64(m.follow_buckets)).astype(np.int64),
                            look, np.zeros(len(words), np.int64))
        uniform = 1.0 / (m.words + 1)
        lower = np.full(len(words), uniform)
        if m.pairs:
            spare = float(m.word_d @ m.word_n) / m.pairs
            lower = np.maximum(follow - discount_of(follow, m.word_d), 0) / m.pairs + spare * uniform

        pair = pair_hash(t.context, t.word)
        pairs, first, pair_of = np.unique(pair, return_index=True, return_inverse=True)
        seen = self._each("pair", pairs, m.pair_bucket(t.context[first], pairs), look, np.zeros(len(pairs), np.int64))
        contexts, context_of = np.unique(t.context[first], return_inverse=True)
        stats = self._context(contexts)[context_of]
        total = stats[:, 0]
        own = np.maximum(seen - discount_of(seen, m.pair_d), 0) / np.maximum(total, 1)
        spare = np.where(total > 0, stats[:, 1:] @ m.pair_d / np.maximum(total, 1), 1.0)
        model = np.log10(own + spare * lower[word_of[first]])[pair_of]
        base = np.log10((count + 0.5) / (m.tokens + 0.5 * (m.words + 1)))[word_of]
        at = np.cumsum(t.counts) - t.counts
        return (t.counts, np.add.reduceat((count > 0).astype(np.int64)[word_of], at), np.add.reduceat(base, at),
                np.add.reduceat(model, at))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
          group_bytes: int = 16 << 20) -> DataFrame:
    """doc_id, n_tokens, n_known, base_score, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)       # a few numbers per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            for start, end, raws in text_groups(batch.column(1).to_pylist(), group_bytes):
                n, known, base, value = scorer.score(raws)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, end - start), pa.array(n), pa.array(known), pa.array(base), pa.array(value)],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def held_out_scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", remainder: int = 1) -> DataFrame:
    """Learn from the rows outside the held-out fold and score every row."""
    learned = docs.where(crc_bucket(id_col) != remainder).select(F.col(text_col).alias("text"))
    model = train(learned)
    return score(docs, model, id_col, text_col).select(
        "doc_id", F.coalesce(crc_bucket("doc_id") == remainder, F.lit(True)).alias("held_out"), "n_tokens", "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
