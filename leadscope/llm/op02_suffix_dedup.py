"""Exact substring de-duplication over the sorted suffixes of a corpus.

Every text is UTF-8 bytes.  A byte goes when a ``min_len``-byte string covers it that also starts earlier
(in a smaller doc_id, or earlier in the same document).

Which suffixes: each ``min_len``-byte window elects the position whose ``anchor_len`` bytes hash lowest
(the leftmost of equals).  The choice depends on the window's bytes alone, so equal windows elect the
same place within themselves, and sorting the suffixes at elected places finds every repeat.  About one
suffix in 35 is kept, each with the bytes of the windows that elected it (a stretch).

1.  Candidates: the leading bytes of every elected suffix are counted by hash; a suffix whose leading
    bytes occur once can match nothing and goes no further.  A hash repeated within a task's texts is
    settled there and sent on once.
2.  Per task: stretches of the candidates; those repeated in the task itself are settled (the earliest
    stays), the rest is routed by sampled splitters over the leading bytes into buckets, packed and
    compressed.
3.  Per bucket: multikey quicksort, eight bytes at a time, first over the leading bytes, then over whole
    stretches, then over the single windows of stretches that differ somewhere; each window's earliest
    occurrence stays.
4.  Across boundaries: a hot prefix is sampled as several splitters, and its stretches are dealt over as
    many buckets.  The windows of prefixes at a splitter, already reduced to one per bucket, meet by
    content in one more shuffle.
5.  The ranges found join the texts.

Defined cases: NULL text is empty; texts under ``min_len`` bytes keep everything; rows with the same
doc_id and text count as the same document, so a row and its exact repetition under one id start at the same
place and neither is earlier; different texts under one doc_id are documents of their own, in the order of
their XXH64; a NULL doc_id is one id after all others.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadscope.llm.common import PolynomialHash, fresh, frugal, frugal_group, mix64, partitions, text_groups, written

NULL_ID = (1 << 63) - 1
BLOCK = 1 << 18                       # windows elected at once
_LOW = np.uint64((1 << 20) - 1)       # room for a place within a block


class Stretches:
    """Elected suffixes: document, first window, bytes before the suffix, length, and the bytes."""

    FIELDS = (("doc", np.int64), ("first", np.int64), ("before", np.int32), ("size", np.int32))

    def __init__(self, columns: dict[str, np.ndarray], data: np.ndarray) -> None:
        self.columns, self.data = columns, data

    def __getattr__(self, name: str) -> np.ndarray:
        try:
            return self.__dict__["columns"][name]
        except KeyError:
            raise AttributeError(name) from None

    def __len__(self) -> int:
        return len(self.columns["doc"])

    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.size[:-1], dtype=np.int64)]) if len(self) else np.zeros(0, np.int64)

    def pack(self) -> bytes:
        parts = [np.array([len(self)], np.int64).tobytes()]
        parts += [self.columns[n].astype(t).tobytes() for n, t in self.FIELDS]
        return _zip(b"".join([*parts, self.data.tobytes()]))

    @classmethod
    def unpack(cls, packed: bytes) -> Stretches:
        raw = _unzip(packed)
        n, at, columns = int(np.frombuffer(raw, np.int64, 1)[0]), 8, {}
        for name, kind in cls.FIELDS:
            columns[name] = np.frombuffer(raw, kind, n, at)
            at += n * np.dtype(kind).itemsize
        return cls(columns, np.frombuffer(raw, np.uint8, offset=at))

    @classmethod
    def joined(cls, parts: list[Stretches]) -> Stretches:
        return cls({n: np.concatenate([p.columns[n] for p in parts]) for n, _ in cls.FIELDS},
                   np.concatenate([p.data for p in parts]))


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places starts[i] .. starts[i] + sizes[i] - 1 of all i, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def _window_min(values: np.ndarray, width: int) -> np.ndarray:
    done, out = 1, values
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[:len(out) - rest], out[rest:]) if rest else out


def elect(data: np.ndarray, doc_starts: np.ndarray, doc_ends: np.ndarray, hasher: PolynomialHash, min_len: int,
          anchor_len: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Per block: (document index, first window, last window, elected place, hash of the stretch, hash of
    the leading bytes)."""
    hasher._powers(BLOCK + min_len + 1)
    for start in range(0, max(0, len(data) - min_len + 1), BLOCK):
        stop = min(start + BLOCK, len(data) - min_len + 1)          # windows start .. stop-1
        piece = data[start:stop + min_len - 1]
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(hasher.letters[piece] * hasher.up[:len(piece)], out=total[1:])
        exact = (total[anchor_len:] - total[:-anchor_len]) * hasher.down[:len(piece) - anchor_len + 1]
        grams = exact ^ (exact >> np.uint64(32))
        grams *= np.uint64(0xD6E8FEB86659FD93)
        grams &= ~_LOW
        grams |= np.arange(len(grams), dtype=np.uint64)
        place = (_window_min(grams, min_len - anchor_len + 1) & _LOW).astype(np.int64)
        fresh = np.ones(len(place), bool)
        fresh[1:] = place[1:] != place[:-1]
        inside = doc_starts[(doc_starts >= start) & (doc_starts < stop)] - start
        fresh[inside] = True
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(place)) - 1
        doc = np.searchsorted(doc_ends, first + start, side="right")
        last = np.minimum(last, doc_ends[np.minimum(doc, len(doc_ends) - 1)] - min_len - start)
        ok = last >= first
        first, last, doc, anchor = first[ok], last[ok], doc[ok], place[first[ok]]
        whole = (total[last + min_len] - total[first]) * hasher.down[first]
        shape = (anchor - first).astype(np.uint64) << np.uint64(32) | (last - first).astype(np.uint64)
        yield (doc, first + start, last + start, anchor + start, mix64(whole ^ mix64(shape)), mix64(exact[anchor]))


class Group:
    """The elected suffixes of a group of texts."""

    def __init__(self, raws: list[bytes], ids: np.ndarray, hasher: PolynomialHash, min_len: int, anchor_len: int) -> None:
        self.data = np.frombuffer(b"".join(raws), np.uint8)
        ends = np.cumsum(np.fromiter(map(len, raws), np.int64, len(raws)))
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        parts = list(elect(self.data, starts, ends, hasher, min_len, anchor_len))
        if not parts:
            none = np.zeros(0, np.int64)
            parts = [(none, none, none, none, np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        self.text, self.first, last, self.anchor, self.whole, self.prefix = (np.concatenate(c) for c in zip(*parts))
        self.size = last - self.first + min_len
        self.doc, self.base = ids[self.text], starts[self.text]
        self.anchor_len = anchor_len

    def select(self, rows: np.ndarray) -> None:
        for name in ("text", "first", "anchor", "whole", "prefix", "size", "doc", "base"):
            setattr(self, name, getattr(self, name)[rows])

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(rows of the earliest of equal stretches, rows that repeat an earlier one)."""
        order = np.lexsort((self.first - self.base, self.doc, self.whole))
        lead = np.ones(len(order), bool)
        lead[1:] = self.whole[order[1:]] != self.whole[order[:-1]]
        head = order[np.maximum.accumulate(np.where(lead, np.arange(len(order)), 0))]
        later = (self.doc[order] != self.doc[head]) | ((self.first - self.base)[order] != (self.first - self.base)[head])
        return np.sort(order[lead]), order[~lead & later]

    def heads(self, rows: np.ndarray) -> np.ndarray:
        return self.data[self.anchor[rows][:, None] + np.arange(self.anchor_len)]

    def stretches(self, rows: np.ndarray) -> Stretches:
        return Stretches({"doc": self.doc[rows], "first": (self.first - self.base)[rows],
                          "before": (self.anchor - self.first)[rows], "size": self.size[rows]},
                         self.data[_spread(self.first[rows], self.size[rows])])


def _as_keys(heads: np.ndarray) -> np.ndarray:
    """Rows of bytes as fixed-width strings that sort by their bytes (zero bytes read as 1)."""
    return np.ascontiguousarray(np.maximum(heads, 1)).view(f"S{heads.shape[1]}").ravel()


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(NULL_ID).to_numpy(zero_copy_only=False).astype(np.int64)


def sample_splitters(docs: DataFrame, buckets: int, min_len: int, anchor_len: int, sample_docs: int = 20_000,
                     per_doc: int = 4) -> np.ndarray:
    """Splitters from the leading bytes of at most ``per_doc`` suffixes of about ``sample_docs`` texts."""
    rows = docs.count()
    share = min(1.0, sample_docs / max(1, rows))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PolynomialHash()
        for batch in batches:
            for _, _, raws in text_groups(batch.column(1).to_pylist()):
                heads = []
                for raw in raws:
                    raw = raw[:1 << 16]      # which suffixes are sampled does not change the result
                    group = Group([raw], np.zeros(1, np.int64), hasher, min_len, anchor_len)
                    n = len(group.first)
                    heads += [h.tobytes() for h in group.heads(np.arange(0, n, max(1, -(-n // per_doc))))]
                yield pa.RecordBatch.from_arrays([pa.array(heads, pa.binary())], names=["head"])

    picked = docs if share == 1.0 else docs.where(
        F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    heads = sorted(_as_keys(np.frombuffer(r["head"], np.uint8)[None, :])[0]
                   for r in picked.mapInArrow(run, "head binary").collect())
    cuts = [heads[len(heads) * i // buckets] for i in range(1, buckets)] if heads else []
    return np.array(cuts, f"S{anchor_len}")              # a hot prefix stands in it several times


def bucket_of(heads: np.ndarray, docs: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """Range of the leading bytes; what equals several splitters is dealt over as many buckets by document."""
    keys = _as_keys(heads)
    low, high = np.searchsorted(splitters, keys, side="left"), np.searchsorted(splitters, keys, side="right")
    equal = np.maximum(high - low, 1)
    return high - (mix64(docs.astype(np.int64).view(np.uint64)) % equal.astype(np.uint64)).astype(np.int64)


def _zip(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unzip(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def zipped(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` as compressed UTF-8 (NULL stays NULL): what the shuffles of texts carry."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[place] = pa.array([None if t is None else _zip(t.encode("utf-8", "surrogatepass"))
                                       for t in (x.as_py() for x in columns[place])], pa.binary())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    schema = T.StructType([T.StructField("text", T.BinaryType()) if f.name == "text" else f for f in docs.schema.fields])
    return docs.mapInArrow(frugal(run), schema)


def _prefix_packer(buckets: int, min_len: int, anchor_len: int, group_bytes: int) -> Callable:
    """Per group of texts and bucket: six bytes of each suffix's prefix hash, its document and its place.

    Suffixes whose hash repeats in the group are passed on under a negative bucket; one entry without a
    place stands for them in the count."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PolynomialHash()
        for batch in batches:
            ids = _ids(batch.column(0))
            for start, end, raws in text_groups(batch.column(1).to_pylist(), group_bytes):
                group = Group(raws, ids[start:end], hasher, min_len, anchor_len)
                group.select(np.unique(group.text << 32 | (group.anchor - group.base), return_index=True)[1])
                place = (group.anchor - group.base).astype(np.int32)
                hashes, first, which, times = np.unique(group.prefix, return_index=True, return_inverse=True, return_counts=True)
                known = np.flatnonzero(times[which] > 1)
                doc, place_of = group.doc[first], np.where(times > 1, -1, place[first]).astype(np.int32)
                bucket = (hashes % np.uint64(buckets)).astype(np.int64)
                rest = np.ascontiguousarray(hashes // np.uint64(buckets)).view(np.uint8).reshape(-1, 8)[:, :6]
                order = np.argsort(bucket, kind="stable")
                numbers, blobs = [], []
                for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
                    numbers.append(int(bucket[rows[0]]))
                    blobs.append(_zip(np.array([len(rows)], np.int64).tobytes() + doc[rows].tobytes()
                                      + place_of[rows].tobytes() + rest[rows].tobytes()))
                if len(known):
                    numbers.append(-1 - int(hashes[0] % np.uint64(1 << 20)))
                    blobs.append(_zip(np.array([len(known)], np.int64).tobytes() + group.doc[known].tobytes()
                                      + place[known].tobytes() + bytes(6 * len(known))))
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary())],
                                                 names=["bucket", "packed"])
    return run


def _several(table: pa.Table) -> pa.Table:
    """(doc, anchor) of the suffixes whose prefix hash occurs more than once in the bucket."""
    docs, anchors, hashes = [], [], []
    for packed in table.column("packed").to_pylist():
        raw = _unzip(packed)
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        docs.append(np.frombuffer(raw, np.int64, n, 8))
        anchors.append(np.frombuffer(raw, np.int32, n, 8 + 8 * n))
        wide = np.zeros((n, 8), np.uint8)
        wide[:, :6] = np.frombuffer(raw, np.uint8, 6 * n, 8 + 12 * n).reshape(n, 6)
        hashes.append(wide.view(np.uint64).ravel())
    doc, anchor, prefix = np.concatenate(docs), np.concatenate(anchors), np.concatenate(hashes)
    if table.column("bucket")[0].as_py() < 0:
        rows = np.arange(len(doc))
    else:
        order = np.argsort(prefix, kind="stable")
        equal = prefix[order[1:]] == prefix[order[:-1]]
        rows = order[np.concatenate([[False], equal]) | np.concatenate([equal, [False]])]
        rows = rows[anchor[rows] >= 0]
    return pa.Table.from_arrays([pa.array(doc[rows]), pa.array(anchor[rows].astype(np.int64))], names=["doc", "anchor"])


def candidates(docs: DataFrame, buckets: int, min_len: int, anchor_len: int, group_bytes: int) -> DataFrame:
    """(doc, anchors): per document the places of suffixes whose leading bytes occur more than once."""
    packed = docs.mapInArrow(frugal(_prefix_packer(buckets, min_len, anchor_len, group_bytes)), "bucket long, packed binary")
    found = packed.groupBy("bucket").applyInArrow(frugal_group(_several), "doc long, anchor long")
    return found.groupBy("doc").agg(F.collect_set("anchor").alias("anchors"))


def _packer(splitters: np.ndarray, min_len: int, anchor_len: int, group_bytes: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = PolynomialHash()
        for batch in batches:
            ids = _ids(batch.column(0))
            for start, end, raws in _unzipped_groups(batch.column(1), group_bytes):
                group = Group(raws, ids[start:end], hasher, min_len, anchor_len)
                wanted = [a for a in batch.column(2).slice(start, end - start).to_pylist()]
                asked = np.concatenate([np.array(a, np.int64) | i << 32 for i, a in enumerate(wanted)])
                group.select(np.isin(group.text << 32 | (group.anchor - group.base), asked))
                keep, gone = group.distinct()
                bucket = bucket_of(group.heads(keep), group.doc[keep], splitters)
                order = np.argsort(bucket, kind="stable")
                numbers, blobs = [], []
                for rows in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
                    numbers.append(int(bucket[rows[0]]))
                    blobs.append(group.stretches(keep[rows]).pack())
                if len(gone):                      # already known to repeat: passed on as they are
                    numbers.append(-1 - int(group.prefix[0] % np.uint64(1 << 20)))
                    blobs.append(Stretches({"doc": group.doc[gone], "first": (group.first - group.base)[gone],
                                            "before": np.zeros(len(gone), np.int32), "size": group.size[gone]},
                                           np.zeros(0, np.uint8)).pack())
                yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(blobs, pa.binary())],
                                                 names=["bucket", "packed"])
    return run


def _unzipped_groups(column: pa.Array, group_bytes: int) -> Iterator[tuple[int, int, list[bytes]]]:
    start, held, size = 0, [], 0
    for i, packed in enumerate(column):
        raw = _unzip(packed.as_py())
        if held and size + len(raw) > group_bytes:
            yield start, i, held
            start, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield start, start + len(held), held


def multikey(count: int, word: Callable[[np.ndarray, int], np.ndarray], depth: int, group: np.ndarray | None = None
             ) -> tuple[np.ndarray, np.ndarray]:
    """Rows in sorted order with their group, for groups of two or more rows equal in all ``depth`` words.

    Multikey quicksort in eight-byte letters: each round splits the groups by their next word; a group of
    one row is settled and leaves.
    """
    rows = np.arange(count)
    group = np.zeros(count, np.int64) if group is None else group
    for level in range(-1, depth):
        if level >= 0:
            value = word(rows, level)
            order = np.lexsort((value, group))
            rows, group, value = rows[order], group[order], value[order]
            fresh = (group[1:] != group[:-1]) | (value[1:] != value[:-1])
        else:
            order = np.argsort(group, kind="stable")
            rows, group = rows[order], group[order]
            fresh = group[1:] != group[:-1]
        if not len(rows):
            break
        group = np.concatenate([[0], np.cumsum(fresh)])
        several = np.bincount(group)[group] > 1
        rows, group = rows[several], group[several]
    return rows, group


def _earliest(rows: np.ndarray, group: np.ndarray, doc: np.ndarray, place: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray]:
    """(rows that come after their group's earliest, rows that are in its place but not its first row)."""
    if not len(rows):
        return rows, rows
    order = np.lexsort((place[rows], doc[rows], group))
    rows, group = rows[order], group[order]
    lead = np.concatenate([[True], group[1:] != group[:-1]])
    head = rows[np.maximum.accumulate(np.where(lead, np.arange(len(rows)), 0))]
    later = (doc[rows] != doc[head]) | (place[rows] != place[head])
    return rows[later], rows[~later & ~lead]


def _classes(columns: list[np.ndarray]) -> np.ndarray:
    """Dense class numbers of rows equal in all columns."""
    out = np.zeros(len(columns[0]), np.int64)
    for column in columns:
        _, dense = np.unique(column, return_inverse=True)
        _, out = np.unique(out * (int(dense.max(initial=0)) + 1) + dense, return_inverse=True)
    return out


class Bucket:
    """The sorted suffixes of one bucket."""

    def __init__(self, found: Stretches, min_len: int, anchor_len: int, most_windows: int = 1_000_000) -> None:
        self.found, self.min_len, self.anchor_len, self.most = found, min_len, anchor_len, most_windows
        self.data = np.concatenate([found.data, np.zeros(8, np.uint8)])
        self.words = np.lib.stride_tricks.as_strided(self.data.view(np.uint8)[:8].view(">u8"),
                                                     (len(self.data) - 7,), (1,))
        self.at = found.offsets()
        self.ranges: list[np.ndarray] = []      # rows of (doc, start, size)
        self.cross: list[np.ndarray] = []       # rows of (doc, start, content, content)

    def _words_at(self, places: np.ndarray) -> np.ndarray:
        return self.words[places].astype(np.uint64)

    def run(self, cut_prefixes: np.ndarray) -> None:
        found = self.found
        anchor = self.at + found.before
        exact = lambda rows, k: self._words_at(anchor[rows] + min(8 * k, self.anchor_len - 8))
        rows, prefix = multikey(len(found), exact, -(-self.anchor_len // 8))
        heads = _as_keys(found.data[anchor[:, None] + np.arange(self.anchor_len)])
        cut = np.isin(heads, cut_prefixes)
        alone = np.setdiff1d(np.flatnonzero(cut), rows)
        rows = np.concatenate([rows, alone])
        prefix = np.concatenate([prefix, np.arange(len(alone)) + prefix.max(initial=-1) + 1])
        if not len(rows):
            return
        size, before = found.size[rows], found.before[rows]
        most = int(size.max())

        def whole(sub: np.ndarray, k: int) -> np.ndarray:
            left = np.clip(size[sub] - 8 * k, 0, 8)
            value = self._words_at(np.minimum(self.at[rows[sub]] + 8 * k, len(self.data) - 8))
            shift = ((8 - left) * 8).astype(np.uint64)
            return np.where(left > 0, value >> np.minimum(shift, np.uint64(63)), np.uint64(0))

        same, group = multikey(len(rows), whole, -(-most // 8), _classes([prefix, before, size]))
        later, twins = _earliest(same, group, found.doc[rows], found.first[rows])
        self.ranges.append(np.stack([found.doc[rows[later]], found.first[rows[later]], size[later]], axis=1).astype(np.int64))
        left = np.setdiff1d(np.arange(len(rows)), np.concatenate([later, twins]))
        rows, prefix = rows[left], prefix[left]
        several = (np.bincount(prefix)[prefix] > 1) | cut[rows]
        rows, prefix = rows[several], prefix[several]
        order = np.argsort(prefix, kind="stable")
        rows, prefix = rows[order], prefix[order]
        windows = found.size[rows] - self.min_len + 1
        where = np.cumsum(windows) // self.most
        new = np.concatenate([[True], prefix[1:] != prefix[:-1]]) if len(rows) else np.zeros(0, bool)
        where = np.maximum.accumulate(np.where(new, where, 0)) if len(rows) else where     # a prefix stays together
        for chunk in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(where)) + 1):
            if len(chunk):
                self._windows(rows[chunk], prefix[chunk], cut)

    def _windows(self, rows: np.ndarray, prefix: np.ndarray, cut: np.ndarray) -> None:
        """Equal windows among stretches that differ somewhere; windows at different distances from the
        suffix never compare, so a large prefix is taken a few distances at a time."""
        found = self.found
        spans = found.size[rows] - self.min_len
        total = int((spans + 1).sum())
        farthest, nearest = int(found.before[rows].max()), int((found.before[rows] - spans).min())
        step = max(1, (farthest - nearest + 1) * self.most // max(total, 1))
        for low in range(nearest, farthest + 1, step):
            first = np.maximum(found.before[rows] - (low + step - 1), 0)
            last = np.minimum(found.before[rows] - low, spans)
            ok = last >= first
            count = (last - first + 1)[ok]
            if not len(count):
                continue
            owner = np.repeat(rows[ok], count)
            shift = _spread(first[ok].astype(np.int64), count)
            start, doc, place = self.at[owner] + shift, found.doc[owner], found.first[owner] + shift
            away = found.before[owner] - shift
            last_word = self.min_len - 8
            value = lambda sub, k: self._words_at(start[sub] + min(8 * k, last_word))
            same, group = multikey(len(owner), value, -(-self.min_len // 8),
                                   _classes([np.repeat(prefix[ok], count), away]))
            later, _ = _earliest(same, group, doc, place)
            self._runs(owner[later], shift[later])
            stays = np.setdiff1d(np.flatnonzero(cut[owner]), later)
            if len(stays):
                hasher, other = PolynomialHash(), PolynomialHash()
                other.letters = mix64(other.letters) | np.uint64(1)
                for block in np.array_split(stays, -(-len(stays) // 20_000)):
                    text = self.data[start[block][:, None] + np.arange(self.min_len)].ravel()
                    begin = np.arange(len(block)) * self.min_len
                    content = [h.ranges(text, begin, begin + self.min_len).view(np.int64) for h in (hasher, other)]
                    self.cross.append(np.stack([doc[block], place[block], *content], axis=1))

    def _runs(self, owner: np.ndarray, shift: np.ndarray) -> None:
        order = np.lexsort((shift, owner))
        owner, shift = owner[order], shift[order]
        if not len(owner):
            return
        fresh = np.concatenate([[True], (owner[1:] != owner[:-1]) | (shift[1:] != shift[:-1] + 1)])
        first = np.flatnonzero(fresh)
        last = np.append(first[1:], len(owner)) - 1
        self.ranges.append(np.stack([self.found.doc[owner[first]], self.found.first[owner[first]] + shift[first],
                                     shift[last] - shift[first] + self.min_len], axis=1).astype(np.int64))


def _sorter(splitters: np.ndarray, min_len: int, anchor_len: int) -> Callable:
    schema = pa.schema([("doc", pa.int64()), ("start", pa.int64()), ("size", pa.int64()),
                        ("content_a", pa.int64()), ("content_b", pa.int64())])

    def run(table: pa.Table) -> pa.Table:
        parts = [Stretches.unpack(p) for p in table.column("packed").to_pylist()]
        if table.column("bucket")[0].as_py() < 0:
            ranges, cross = [np.stack([p.doc, p.first, p.size], axis=1) for p in parts], []
        else:
            bucket = Bucket(Stretches.joined(parts), min_len, anchor_len)
            bucket.run(splitters)
            ranges, cross = bucket.ranges, bucket.cross
        known = np.concatenate([np.zeros((0, 3), np.int64), *ranges])
        asked = np.concatenate([np.zeros((0, 4), np.int64), *cross])
        none = pa.nulls(len(known), pa.int64())
        return pa.concat_tables([
            pa.Table.from_arrays([*(pa.array(np.ascontiguousarray(c)) for c in known.T), none, none], schema=schema),
            pa.Table.from_arrays([pa.array(np.ascontiguousarray(asked[:, 0])), pa.array(np.ascontiguousarray(asked[:, 1])),
                                  pa.array(np.full(len(asked), min_len)), pa.array(np.ascontiguousarray(asked[:, 2])),
                                  pa.array(np.ascontiguousarray(asked[:, 3]))], schema=schema)])
    return run


def repeated_ranges(docs: DataFrame, min_len: int = 100, anchor_len: int = 32, group_bytes: int = 4 << 20) -> DataFrame:
    """(doc, start, size) byte ranges covered by an earlier ``min_len``-byte string; they may overlap.

    ``docs`` has doc_id (long) and text; one doc_id has one text.
    """
    if not 8 <= anchor_len <= min_len:
        raise ValueError("anchor_len must lie between 8 and min_len")
    buckets = 4 * partitions(docs.sparkSession)
    splitters = sample_splitters(docs, buckets, min_len, anchor_len)
    found = written(candidates(docs, buckets, min_len, anchor_len, group_bytes), "candidates")
    texts = zipped(docs.where("text is not null").select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("doc"), "text"))
    asked = texts.join(found.hint("shuffle_hash"), "doc").select("doc", "text", "anchors")
    packed = asked.mapInArrow(frugal(_packer(splitters, min_len, anchor_len, group_bytes)), "bucket long, packed binary")
    sorted_ = written(packed.groupBy("bucket").applyInArrow(
        frugal_group(_sorter(splitters, min_len, anchor_len)),
        "doc long, start long, size long, content_a long, content_b long"), "suffixes")
    same = Window.partitionBy("content_a", "content_b")
    here = F.struct("doc", "start")
    crossing = (sorted_.where("content_a is not null").withColumn("lead", F.min(here).over(same))
                .where(here > F.col("lead")))
    return (sorted_.where("content_a is null").select("doc", "start", "size")
            .union(crossing.select("doc", "start", "size")))


def merge_ranges(starts: np.ndarray, sizes: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs [start, end) of the union; touching ranges form one run."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate((starts + sizes)[order])
    cut = np.flatnonzero(starts[1:] > ends[:-1]) + 1
    return list(zip(starts[np.concatenate([[0], cut])].tolist(), ends[np.concatenate([cut - 1, [len(ends) - 1]])].tolist()))


def without(raw: bytes, runs: list[tuple[int, int]]) -> bytes:
    kept, at = [], 0
    for start, end in runs:
        kept.append(raw[at:start])
        at = end
    kept.append(raw[at:])
    return b"".join(kept)


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a number per (doc_id, text) in the order of doc_id, NULL last, and its column's name.

    Where no doc_id has two texts, that is the doc_id; else the rows are written with their places in the order.
    """
    number, none, key, version, part, at, before = fresh(docs, "doc", "none", "key", "version", "part", "at", "before")
    keys = {none: F.col("doc_id").isNull(), key: F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)),
            version: F.xxhash64("text")}
    seen = docs.select(*[value.alias(name) for name, value in keys.items()])
    shared = (seen.groupBy(key).agg(F.min(version).alias("low"), F.max(version).alias("high"), F.min(none).alias("some"),
                                    F.max(none).alias("all")).where("low <> high or some <> all"))
    if shared.limit(1).count() == 0:
        return docs.withColumn(number, keys[key]), number
    parts = partitions(docs.sparkSession)
    # written in order once, so that the places are the same in every later reading
    placed = written(seen.distinct().repartitionByRange(parts, *keys).sortWithinPartitions(*keys)
                     .withColumn(part, F.spark_partition_id())
                     .withColumn(at, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))), "places")
    counts = {r[part]: r["count"] for r in placed.groupBy(part).count().collect()}     # one row per partition
    first, offsets = 0, []
    for p in sorted(counts):
        offsets.append((p, first))
        first += counts[p]
    offset = docs.sparkSession.createDataFrame(offsets, f"`{part}` int, `{before}` long")
    numbers = placed.join(F.broadcast(offset), part).select(*keys, (F.col(before) + F.col(at)).alias(number))
    return written(docs.withColumns(keys).join(numbers, list(keys)).select(*docs.columns, number), "numbered"), number


def with_runs(docs: DataFrame, number: str, ranges: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with zipped text and the array of (start, size) of its ``number``, or NULL; that column's name."""
    name, = fresh(docs, "ranges")
    found = ranges.groupBy(F.col("doc").alias(number)).agg(F.collect_set(F.struct("start", "size")).alias(name))
    return zipped(docs).join(found.hint("shuffle_hash"), number, "left"), name


def _runs_of(value: list[dict] | None) -> list[tuple[int, int]]:
    if not value:
        return []
    both = np.array([(r["start"], r["size"]) for r in value], np.int64)
    return merge_ranges(both[:, 0], both[:, 1])


def deduplicate(docs: DataFrame, min_len: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row."""
    docs, number = numbered(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(1), batch.column(2)):
                raw = b"" if text.as_py() is None else _unzip(text.as_py())
                runs = _runs_of(found.as_py())
                out.append((len(raw), sum(b - a for a, b in runs), len(runs),
                            hashlib.sha256(without(raw, runs)).hexdigest()))
            columns = list(zip(*out)) or [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found, ranges = with_runs(docs, number, repeated_ranges(docs.select(F.col(number).alias("doc_id"), "text"), min_len))
    return found.select("doc_id", "text", ranges).mapInArrow(
        frugal(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cleaned(docs: DataFrame, min_len: int = 100) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) with the repeated ranges taken out of ``text``.

    A character of which a byte went goes as a whole.  NULL stays NULL.
    """
    known, number = numbered(docs)
    found, ranges = with_runs(known, number, repeated_ranges(known.select(F.col(number).alias("doc_id"), "text"), min_len))
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if t is None else without(_unzip(t), _runs_of(r)).decode("utf-8", "ignore")
                     for t, r in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist())]
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return found.select(*docs.columns, ranges).mapInArrow(frugal(run), docs.schema)
