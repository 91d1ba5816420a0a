import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from leadscope.llm import arrays
from leadscope.llm import op01_ngram as op
from leadscope.llm.common import table

SCHEMA = "doc_id long, text string, score string"


def words(text):
    return [w.decode() for w in (text or "").encode().lower().split()]


def brute(rows, remainder=1):
    """Modified Kneser-Ney bigrams with plain dictionaries."""
    train = [t for i, t, *_ in rows if i is not None and zlib.crc32(str(i).encode()) % 5 != remainder]
    uni, bi = Counter(), Counter()
    for t in train:
        seq = ["<s>", *words(t), "</s>"]
        uni.update(seq[1:])
        bi.update(zip(seq, seq[1:]))

    def d_of(counts):
        n = Counter(counts)
        n1, n2, n3, n4 = (n[k] for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2) if n1 + n2 else 0
        d = [1 - 2 * y * n2 / n1 if n1 else 0, 2 - 3 * y * n3 / n2 if n2 else 0, 3 - 4 * y * n4 / n3 if n3 else 0]
        d = [x if 0 < x < k else y if 0 < y < 1 else .5 for k, x in enumerate(d, 1)]
        return lambda c: 0 if c == 0 else d[min(c, 3) - 1]

    follow, context = Counter(w for _, w in bi), defaultdict(list)
    for (a, _), c in bi.items():
        context[a].append(c)
    d1, d2 = d_of(follow.values()), d_of(bi.values())
    n, v = sum(uni.values()), len(uni)

    def p1(w):
        if not bi:
            return 1 / (v + 1)
        spare = sum(d1(c) for c in follow.values()) / len(bi)
        return max(follow[w] - d1(follow[w]), 0) / len(bi) + spare / (v + 1)

    def p2(a, w):
        if a not in context:
            return p1(w)
        total = sum(context[a])
        return max(bi[a, w] - d2(bi[a, w]), 0) / total + sum(map(d2, context[a])) / total * p1(w)

    out = []
    for i, t, *_ in rows:
        seq = ["<s>", *words(t), "</s>"]
        base = sum(math.log10((uni[w] + .5) / (n + .5 * (v + 1))) for w in seq[1:])
        out.append((i, i is None or zlib.crc32(str(i).encode()) % 5 == remainder, len(seq) - 1,
                    sum(uni[w] > 0 for w in seq[1:]), n, base, sum(math.log10(p2(*x)) for x in zip(seq, seq[1:]))))
    return out, p2, uni


def close(got, want):
    got = sorted(map(tuple, got), key=str)
    want = sorted(want, key=str)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9)


@pytest.mark.parametrize("seed", [1, 2])
def test_against_dictionaries(frame, prose, seed):
    rows = [(i, t, None) for i, t in enumerate(prose(seed, docs=60))]
    rows += [(100, None, "x"), (101, "", None), (102, " \n", None), (103, "unseen Words THE é É", None), (None, "abc abc", "y"),
             (104, "a " * 3000, None), (104, "a " * 3000, None)]
    want, _, _ = brute(rows)
    close(op.held_out_scores(frame(rows, SCHEMA)).collect(), want)


def test_probabilities_sum_to_one(prose):
    rows = [(i, t) for i, t in enumerate(prose(3))]
    _, p2, uni = brute(rows)
    for a in ["<s>", "never", *list(uni)[:5]]:
        assert abs(sum(p2(a, w) for w in uni) + p2(a, "<unknown>") - 1) < 1e-9


@pytest.mark.parametrize("times", [2, 3, 4, 7])
def test_corpora_of_copies_have_finite_scores(frame, prose, times):
    """Copies leave few counts of one: no estimate of a discount may take the mass of unseen words away."""
    texts = prose(6, docs=60)
    rows = [(k * 100 + i, t, None) for k in range(times) for i, t in enumerate(texts)]
    rows += [(10_000 + i, f"new words {i} " + t, None) for i, t in enumerate(texts[:30])]
    want, p2, uni = brute(rows)
    got = op.held_out_scores(frame(rows, SCHEMA)).collect()
    assert all(math.isfinite(r["score"]) for r in got)
    close(got, want)
    for a in ["<s>", *list(uni)[:5]]:
        assert abs(sum(p2(a, w) for w in uni) + p2(a, "<unknown>") - 1) < 1e-9 and p2(a, "<unknown>") > 0


def test_discounts_lie_between_zero_and_their_count():
    rng = np.random.default_rng(1)
    for n in [*rng.integers(0, 50, (500, 4)), (0, 0, 0, 0), (0, 5, 9, 9), (9, 0, 0, 0), (1, 1, 40, 40)]:
        d = op.discounts(np.array(n))
        assert all(0 < x < k for k, x in enumerate(d, 1))


def test_no_group_of_all_buckets(spark, tmp_path, prose):
    """Each bucket passes its summary on under a number of its own."""
    import pyarrow as pa
    model, numbers = op.Model(f"file:{tmp_path}", 8, 2), []
    texts = pa.RecordBatch.from_arrays([pa.array(prose(2))], names=["text"])
    for batch in op._pair_packer(model, 1 << 20)(iter([texts])):
        for row in range(batch.num_rows):
            out = op._pair_reducer(model)(pa.Table.from_batches([batch.slice(row, 1)]))
            numbers += [n for n in out.column("bucket").to_pylist() if n < 0]
    assert len(numbers) > 4 and len(set(numbers)) == len(numbers)


def test_mapped_files_are_bounded(tmp_path, monkeypatch):
    monkeypatch.setattr(arrays, "MOST_MAPPED", 3)
    for k in range(9):
        arrays.write_arrays(f"file:{tmp_path}/{k}", {"key": np.array([k])})
        assert arrays.map_arrays(f"file:{tmp_path}/{k}")["key"][0] == k and len(arrays._MAPPED) <= 3
    assert arrays.map_arrays(f"file:{tmp_path}/0")["key"][0] == 0


def test_hot_contexts_spread(frame, prose):
    """A context split over buckets scores as without the split."""
    rows = [(i, "the " + " the ".join((t or "").split()), None) for i, t in enumerate(prose(4, docs=40))]
    want, _, _ = brute(rows)
    docs = frame(rows, SCHEMA)
    learned = docs.where("crc32(encode(cast(doc_id as string), 'UTF-8')) % 5 <> 1")
    model = op.train(learned, group_bytes=200)
    assert len(model.hot) and model.pieces.max() > 2
    got = op.score(docs, model, group_bytes=500).orderBy("doc_id").collect()
    assert np.allclose([r["score"] for r in got], [w[6] for w in sorted(want, key=lambda w: w[0])], rtol=1e-9)


def test_better_than_baseline_held_out(spark):
    rows = op.held_out_scores(table(spark, "/root/testdata/sf0.01", "documents")).where("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_empty(spark, frame):
    assert op.held_out_scores(spark.createDataFrame([], SCHEMA)).collect() == []
    only_held = [(i, "a b", None) for i in range(40) if zlib.crc32(str(i).encode()) % 5 == 1]
    got = op.held_out_scores(frame(only_held, SCHEMA)).collect()
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 and abs(r["score"]) < 1e-12 for r in got)


def test_large_counts_and_files(tmp_path):
    counts = np.array([1, 254, 255, 256, 10 ** 10])
    uri = f"file:{tmp_path}/a/b"
    for _ in range(2):                                  # a repeated task writes the same file again
        arrays.write_arrays(uri, {"key": np.arange(5, dtype=np.uint64), **op._small(counts)})
    shard = arrays.map_arrays(uri)
    assert op._counts(shard, "key", np.array([0, 1, 2, 3, 4, 9], np.uint64)).tolist() == [*counts.tolist(), 0]
