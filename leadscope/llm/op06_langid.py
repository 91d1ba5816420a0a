"""Language identification with hyperdimensional profiles.

Every letter (code point, lower-cased) has a random bipolar vector of its own, hashed from the code point
and a seed.  A trigram inside a word (with one boundary symbol on either
side of the word) is the product of its three letter vectors, the first permuted twice and the second
once; a text's vector is the sum over its trigrams.  The prototype of a language is the sum over its
training texts, summed per task and added up by Spark.  A text gets the language whose prototype has
the largest cosine with it.

Defined cases: a NULL text and a text without a letter are ``und`` with score 0; equal cosines go to
the alphabetically first language; rows without a language or without an id teach nothing; with no
training row at all every text is ``und``.  Negative cosines score 0.  Repeated rows stay rows.  A NULL id
counts as held out.  Extra columns are not read, whatever their names; ``predict`` carries along those it is
told to keep, and its result columns take the names it is given.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leadscope.llm.common import crc_bucket, frugal, mix64

UNDETERMINED = "und"
POINT = (1 << 21) - 1                                    # bits of one code point; a trigram packs three
NARROW = 128                                             # letters below have a direct table of trigrams
WIDE = sum((POINT - (NARROW - 1)) << s for s in (0, 21, 42))


def _symbol_table() -> np.ndarray:
    """Code point of the lower-cased letter, 0 for all that is no letter."""
    table = np.zeros(0x110000, np.int32)
    for cp in range(0x110000):
        c = chr(cp)
        if c.isalpha():
            table[cp] = ord(c.lower()[0])
    return table


class Letters:
    """The random vector of every code point, hashed from seed and code point, rolled by ``shift`` places."""

    def __init__(self, seed: int, dims: int, shift: int) -> None:
        self.dims, self.shift = dims, shift
        words = np.arange(1, (dims + 63) // 64 + 1, dtype=np.uint64)
        self.salts = mix64(words * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))

    def __getitem__(self, points: np.ndarray | int) -> np.ndarray:
        distinct, back = np.unique(np.asarray(points, np.uint64), return_inverse=True)
        bits = mix64(mix64(distinct[:, None] + np.uint64(1)) + self.salts)
        signs = np.unpackbits(bits.view(np.uint8), axis=1)[:, :self.dims].astype(np.int8) * 2 - 1
        return np.roll(signs, self.shift, axis=1)[back]


class Encoder:
    """Turns texts into sums of trigram vectors.

    Trigrams are numbered as they come up; the vectors of the first ``keep`` are held, those of later ones
    are formed in blocks when they are needed, so memory stays bounded whatever the alphabet.
    """

    _table: np.ndarray | None = None

    def __init__(self, dims: int, seed: int, keep: int = 1 << 15, block: int = 1 << 12) -> None:
        if Encoder._table is None:
            Encoder._table = _symbol_table()
        self.bound = [Letters(seed, dims, shift) for shift in (2, 1, 0)]
        self.dims, self.keep, self.block = dims, keep, block
        self._reset()

    def _reset(self) -> None:
        self.row = np.full(NARROW ** 3, -1, np.int32)
        self.wide, self.wide_row = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.codes = np.zeros(0, np.int64)
        self.vectors = np.zeros((0, self.dims), np.float32)

    def _vectors(self, codes: np.ndarray) -> np.ndarray:
        a, b, c = codes >> 42, codes >> 21 & POINT, codes & POINT
        return (self.bound[0][a] * self.bound[1][b] * self.bound[2][c]).astype(np.float32)

    @staticmethod
    def _direct(codes: np.ndarray) -> np.ndarray:
        return codes >> 28 | codes >> 14 & (NARROW - 1) << 7 | codes & NARROW - 1

    def _known(self, codes: np.ndarray) -> np.ndarray:
        """Numbers of the trigrams, -1 for new ones."""
        wide = codes & WIDE != 0
        if not wide.any():
            return self.row[self._direct(codes)]
        rows = np.full(len(codes), -1, np.int32)
        rows[~wide] = self.row[self._direct(codes[~wide])]
        if len(self.wide):
            asked = codes[wide]
            at = np.minimum(np.searchsorted(self.wide, asked), len(self.wide) - 1)
            rows[wide] = np.where(self.wide[at] == asked, self.wide_row[at], -1)
        return rows

    def _rows(self, codes: np.ndarray) -> np.ndarray:
        rows = self._known(codes)
        if not (rows < 0).any():
            return rows
        new = np.unique(codes[rows < 0])
        if len(self.codes) and len(self.codes) + len(new) > self.keep:
            self._reset()
            new = np.unique(codes)
        numbers = np.arange(len(self.codes), len(self.codes) + len(new), dtype=np.int32)
        wide = new & WIDE != 0
        self.row[self._direct(new[~wide])] = numbers[~wide]
        if wide.any():
            keys, places = np.append(self.wide, new[wide]), np.append(self.wide_row, numbers[wide])
            order = np.argsort(keys)
            self.wide, self.wide_row = keys[order], places[order]
        self.codes = np.append(self.codes, new)
        held = self.codes[len(self.vectors):self.keep]
        self.vectors = np.concatenate([self.vectors, *(self._vectors(held[i:i + self.block])
                                                       for i in range(0, len(held), self.block))])
        return self._known(codes)

    def trigrams(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of all trigrams in order, and where each text's trigrams end."""
        points = np.frombuffer("\0".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self._table[points]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        middle = np.flatnonzero(symbols)
        padded = np.pad(symbols, 1)
        codes = padded[middle].astype(np.int64) << 42
        codes |= padded[middle + 1].astype(np.int64) << 21
        codes |= padded[middle + 2]
        return self._rows(codes), np.searchsorted(middle, ends)

    def bundle(self, rows: np.ndarray) -> np.ndarray:
        """Sum of trigram vectors; whole numbers, so the order of addition does not matter."""
        counts = np.bincount(rows, minlength=1)
        used = np.flatnonzero(counts)
        kind = np.float32 if len(rows) < 1 << 23 else np.float64
        held = used[:np.searchsorted(used, len(self.vectors))]
        total = (counts[held].astype(kind) @ self.vectors[held].astype(kind, copy=False)).astype(np.float64)
        for i in range(len(held), len(used), self.block):
            part = used[i:i + self.block]
            total += counts[part].astype(kind) @ self._vectors(self.codes[part]).astype(kind, copy=False)
        return total


def _groups(texts: list[str | None], chars: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        text = text or ""
        if held and size + len(text) > chars:
            yield start, held
            start, held, size = i, [], 0
        held.append(text)
        size += len(text)
    if held:
        yield start, held


def prototypes(docs: DataFrame, dims: int = 512, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
               lang_col: str = "lang", held_out_remainder: int = 0, max_languages: int = 10_000
               ) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their prototype vectors, from every row outside the held-out fold.

    What reaches the driver is languages x dims sums; more than ``max_languages`` is an error.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sums = Encoder(dims, seed), {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, group in _groups(texts):
                rows, ends = encoder.trigrams(group)
                own = np.array(langs[start:start + len(group)], object)
                label = np.repeat(own, np.diff(ends, prepend=0))
                for lang in set(own.tolist()):
                    sums[lang] = sums.get(lang, 0) + encoder.bundle(rows[label == lang])
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["lang", "vector"])

    train = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                       & (crc_bucket(id_col) != held_out_remainder))
    sums = (train.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
            .mapInArrow(frugal(run), "lang string, vector array<double>")
            .select("lang", F.posexplode("vector").alias("dim", "x"))
            .groupBy("lang", "dim").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("dim", "x"))).alias("v"))
            .select("lang", F.col("v.x").alias("vector")).limit(max_languages + 1).collect())
    if len(sums) > max_languages:
        raise ValueError(f"over {max_languages} languages: the prototypes would not fit a driver")
    known = sorted((r["lang"], r["vector"]) for r in sums)
    return [k for k, _ in known], np.array([v for _, v in known], np.float64).reshape(len(known), dims)


def predict(docs: DataFrame, languages: list[str], vectors: np.ndarray, seed: int = 7, id_col: str = "doc_id",
            text_col: str = "text", keep: list[str] | None = None,
            names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep`` (default: the id) plus the language and its score under ``names``."""
    keep = [id_col] if keep is None else keep
    dims = vectors.shape[1]
    units = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)
    picked = docs.select(*keep, *([] if text_col in keep else [text_col]))
    place = picked.columns.index(text_col)
    fields = [f for f in picked.schema.fields if f.name in keep]
    schema = T.StructType([*fields, T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(dims, seed)
        for batch in batches:
            told, scores = [], []
            for _, group in _groups(batch.column(place).to_pylist()):
                rows, ends = encoder.trigrams(group)
                for a, b in zip([0, *ends[:-1].tolist()], ends.tolist()):
                    name, score = UNDETERMINED, 0.0
                    if b > a and languages:
                        vector = encoder.bundle(rows[a:b])
                        cosines = units @ vector / max(np.linalg.norm(vector), 1e-300)
                        best = int(np.argmax(cosines))
                        name, score = languages[best], min(1.0, max(0.0, float(cosines[best])))
                    told.append(name)
                    scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:len(fields)], pa.array(told, pa.string()), pa.array(scores, pa.float64())],
                names=schema.names)

    return picked.mapInArrow(frugal(run), schema)


def identify(docs: DataFrame, dims: int = 512, seed: int = 7, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, learned from the other rows' labels."""
    languages, vectors = prototypes(docs, dims, seed, id_col, text_col, lang_col)
    out = predict(docs, languages, vectors, seed, id_col, text_col)
    return out.select(F.col(id_col).alias("doc_id"), F.coalesce(crc_bucket(id_col) == 0, F.lit(True)).alias("held_out"),
                      "lang_pred", "score")
