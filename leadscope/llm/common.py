"""Helpers shared by the operators: table access, whole-word hashing, written intermediates."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadscope.session import shared_path

WHITESPACE = b"\t\n\x0b\x0c\r "
_MULTIPLIER = 0x9E3779B97F4A7C15
_SEED = 20240229


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    """Shuffle width: follows the session setting, which the cluster sizes to its input."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it back (cuts the lineage; survives
    the loss of executors)."""
    spark = df.sparkSession
    path = shared_path(spark, "llm", label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """``names``, with underscores added to those that ``df`` already has (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def give_back() -> None:
    """Returns the worker's free memory to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):       # another C library: nothing to give back
        pass


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A function over batches whose worker gives its free memory back when the task ends: an executor's
    idle workers would otherwise hold what their largest task once took."""
    def task(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            give_back()
    return task


def frugal_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The same for a function over groups, after each group."""
    def group(table: pa.Table) -> pa.Table:
        out = run(table)
        give_back()
        return out
    return group


def crc_bucket(column: str | object, modulus: int = 5):
    """crc32 of the id as text, modulo ``modulus``; NULL ids give NULL."""
    col = F.col(column) if isinstance(column, str) else column
    return F.pmod(F.crc32(F.encode(col.cast("string"), "UTF-8")), F.lit(modulus))


def ascii_lower(col):
    """Lower-case A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_groups(texts: list[str | None], max_bytes: int = 4 << 20) -> Iterator[tuple[int, int, list[bytes]]]:
    """Yield (first row, end row, encoded texts) with about ``max_bytes`` each; NULL reads as empty."""
    start, held, size = 0, [], 0
    for i, text in enumerate(texts):
        raw = b"" if text is None else text.encode("utf-8", "surrogatepass")
        if held and size + len(raw) > max_bytes:
            yield start, i, held
            start, held, size = i, [], 0
        held.append(raw)
        size += len(raw)
    if held:
        yield start, start + len(held), held


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PolynomialHash:
    """Hashes of many byte ranges at once: a polynomial over 64-bit letter values modulo 2**64."""

    def __init__(self) -> None:
        rng = np.random.default_rng(_SEED)
        self.letters = rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.inverse = pow(_MULTIPLIER, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _powers(self, n: int) -> None:
        if n > len(self.up):
            size = max(n, 1 << 16)
            for name, base in (("up", _MULTIPLIER), ("down", self.inverse)):
                factors = np.full(size, base, np.uint64)
                factors[0] = 1
                setattr(self, name, np.multiply.accumulate(factors))

    def ranges(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One hash per [start, end) of ``data`` (uint8); equal bytes give equal hashes."""
        self._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.letters[data] * self.up[:len(data)], out=total[1:])
        value = (total[ends] - total[starts]) * self.down[starts]
        return mix64(value + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SPACE = np.zeros(256, bool)
_SPACE[list(WHITESPACE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def word_ranges(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = ~_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(raw_texts: list[bytes], hasher: PolynomialHash, block: int = 1 << 20
                ) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of each text, in order, and the number of words per text.

    Works in blocks cut at white space, so a very long text needs memory for its hashes only.
    """
    data = np.frombuffer(b"\n".join(raw_texts), np.uint8)
    bounds = np.cumsum(np.fromiter((len(t) + 1 for t in raw_texts), np.int64, len(raw_texts)))
    hashes, places, at = [], [], 0
    while at < len(data):
        end = min(len(data), at + block)
        while end < len(data):
            cut = np.flatnonzero(_SPACE[data[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
                break
            end = min(len(data), end + block)
        piece = _LOWER[data[at:end]]
        starts, ends = word_ranges(piece)
        hashes.append(hasher.ranges(piece, starts, ends))
        places.append(starts + at)
        at = end
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(raw_texts), np.int64)
    owner = np.searchsorted(bounds, np.concatenate(places), side="right")
    return np.concatenate(hashes), np.bincount(owner, minlength=len(raw_texts)).astype(np.int64)
