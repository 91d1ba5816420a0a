"""Line dedup against plain sets, and the perfect hash by itself."""

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadscope.llm import op13_lines as op

SCHEMA = "doc_id long, text string"
WS = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(docs, least):
    held = {}
    for row, (_, text) in enumerate(docs):
        for line in (text or "").split("\n"):
            held.setdefault(key(line), set()).add(row)
    out = []
    for doc, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (key(x) and len(held[key(x)]) >= least)]
        out.append((doc, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def results(df):
    return sorted(((r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest())
                   for r in df.collect()), key=str)


def invented(seed, n):
    rng = random.Random(seed)
    lines = ["Home", " home ", "HOME\t", "", "  ", "É", "é", "\x0bmenu\x0c", "menu", "a b", "a  b", "x" * 3000]
    lines += [f"line {k}" for k in range(60)]
    return [(i % (n - 5), "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 12)))) for i in range(n)]


@pytest.mark.parametrize("least", [1, 2, 10])
def test_against_sets(spark, frame, least):
    docs = invented(least, 120) + [(None, None), (7, None), (8, ""), (9, "\n\n"), (None, "home\nrest")]
    got = results(op.deduplicate(frame(docs, SCHEMA), least))
    assert got == brute(docs, least) and any(r[2] for r in got)


def test_many_shards_give_the_same(spark, frame):
    docs = frame(invented(3, 150), SCHEMA)
    index = op.build_index(docs, 3, shard_keys=4)
    assert index.bits >= 3 and len(index.present) > 4
    assert results(op.cleaned(docs, index, 3)) == brute(invented(3, 150), 3)


def test_an_index_serves_other_documents_and_thresholds(spark, frame):
    docs, other = invented(4, 100), [(1, "Home\nnew line\nline 3"), (2, "nothing known")]
    index = op.build_index(frame(docs, SCHEMA), 2)
    whole = brute(docs + [(d, t) for d, t in other], 10 ** 9)
    assert len(whole) == 102
    got = {r["doc_id"]: r["text"] for r in op.cleaned(frame(other, SCHEMA), index, 2).collect()}
    assert got == {1: "new line", 2: "nothing known"}
    assert results(op.cleaned(frame(docs, SCHEMA), index, 20)) == brute(docs, 20)


def test_counts_are_documents_not_lines(spark, frame):
    docs = [(1, "a\na\nA "), (2, "b\na"), (3, "b")]
    rows = op.line_counts(frame(docs, SCHEMA), flush=1).collect()
    assert sorted(r["n"] for r in rows) == [2, 2]


def test_counts_over_many_flushes(spark, frame):
    docs = invented(9, 300)
    for flush in (1, 8, 1 << 20):
        total = op.line_counts(frame(docs, SCHEMA), flush=flush).agg(F.sum("n"), F.count("*")).first()
        keys = [{key(x) for x in t.split("\n")} - {""} for _, t in docs]
        assert tuple(total) == (sum(map(len, keys)), len(set().union(*keys)))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 1000, 50_000])
def test_perfect_hash(n):
    rng = np.random.default_rng(n)
    high, low = rng.integers(0, 1 << 64, (2, n), dtype=np.uint64)
    high[: n // 2] = high[n // 2:n // 2 * 2]                          # halves that are equal, the others not
    counts = rng.integers(1, 200, n).astype(np.uint8)
    shard = op.build(high, low, counts)
    assert sorted(op.slots(shard, high, low).tolist()) == list(range(n))
    assert np.array_equal(op.lookup(shard, high, low), counts)
    away = rng.integers(0, 1 << 64, (2, 1000), dtype=np.uint64)
    assert not op.lookup(shard, *away).any()
    if n >= 1000:
        assert len(shard["bits"]) * 64 <= 4.2 * n + 64 * 40           # a few bits a key


def test_hot_line_and_long_text(spark, frame):
    docs = [(i, "everywhere\n" + f"own {i}") for i in range(200)] + [(900, "everywhere\n" * 200_000 + "end"), (901, "z" * 3_000_000)]
    assert results(op.deduplicate(frame(docs, SCHEMA), 10)) == brute(docs, 10)


def test_empty_table_and_other_columns(spark, frame):
    assert op.deduplicate(frame([], SCHEMA), 10).collect() == []
    docs = invented(6, 60)
    extra = frame(docs, SCHEMA)
    for name in ("n_lines", "n_dropped", "high", "low", "n", "shard"):
        extra = extra.withColumn(name, F.lit("x"))
    assert results(op.deduplicate(extra, 5)) == brute(docs, 5)
