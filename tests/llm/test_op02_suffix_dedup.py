import hashlib

import numpy as np
import pytest

from leadscope.llm import op02_suffix_dedup as op

SCHEMA = "doc_id long, text string"


def brute(rows, n):
    """Every n-byte string against the earliest (doc_id, start) it has anywhere."""
    first = {}
    for doc_id, text in rows:
        raw = (text or "").encode()
        for i in range(len(raw) - n + 1):
            key = raw[i:i + n]
            first[key] = min(first.get(key, (doc_id, i)), (doc_id, i))
    out = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - n + 1):
            if first[raw[i:i + n]] < (doc_id, i):
                gone[i:i + n] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted(tuple(r) for r in df.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect())


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_against_every_window(frame, prose, seed):
    texts = prose(seed)
    texts += [texts[3], texts[3] + " x", "ab" * 300, "ab" * 200, None, "", "short", "z" * 250, texts[5] * 3]
    rows = list(enumerate(texts))
    assert result(op.deduplicate(frame(rows, SCHEMA))) == brute(rows, 100)


def test_cut_prefixes_meet_across_buckets(frame, prose, monkeypatch):
    """Splitters inside hot prefixes: the windows of those prefixes are compared in the second shuffle."""
    texts = prose(7, docs=30)
    rows = list(enumerate(texts + ["header " * 20 + t for t in texts]))
    heads = []
    hasher = op.PolynomialHash()
    for _, t in rows:
        group = op.Group([t.encode()], np.zeros(1, np.int64), hasher, 100, 32)
        heads += op._as_keys(group.heads(np.arange(len(group.first)))).tolist()
    hot = max(set(heads), key=heads.count)
    cuts = np.array(sorted(sorted(set(heads))[::3] + [hot] * 5), "S32")
    same = np.frombuffer(hot.ljust(32, b"\1"), np.uint8)[None, :].repeat(64, axis=0)
    assert len(set(op.bucket_of(same, np.arange(64), cuts).tolist())) >= 5          # a hot prefix is dealt out
    monkeypatch.setattr(op, "sample_splitters", lambda *a, **k: cuts)
    assert result(op.deduplicate(frame(rows, SCHEMA))) == brute(rows, 100)


def test_small_chunks_of_one_prefix(prose):
    """A bucket that takes a large prefix a few distances at a time finds the same ranges."""
    texts = [t.encode() for t in prose(9)] + [b"ab" * 200 + b"q" + b"ab" * 100]
    group = op.Group(texts, np.arange(len(texts)), op.PolynomialHash(), 100, 32)
    found = group.stretches(np.arange(len(group.first)))
    covered = []
    for most in (1_000_000, 50):
        bucket = op.Bucket(found, 100, 32, most)
        bucket.run(np.zeros(0, "S32"))
        covered.append({(d, p) for part in bucket.ranges for d, s, n in part.tolist() for p in range(s, s + n)})
    assert covered[0] == covered[1] and covered[0]


def test_long_text_crosses_blocks(monkeypatch):
    monkeypatch.setattr(op, "BLOCK", 257)
    rng = np.random.default_rng(0)
    base = bytes(rng.integers(97, 123, 2000, dtype=np.uint8)).decode()
    rows = [(1, base), (2, base[500:1500] + "!" + base[:700] + "?" * 300)]
    raws = [t.encode() for _, t in rows]
    group = op.Group(raws, np.array([1, 2]), op.PolynomialHash(), 100, 32)
    bucket = op.Bucket(group.stretches(np.arange(len(group.first))), 100, 32)
    bucket.run(np.zeros(0, "S32"))
    ranges = np.concatenate(bucket.ranges)
    found = []
    for doc_id, raw in zip((1, 2), raws):
        mine = ranges[ranges[:, 0] == doc_id]
        runs = op.merge_ranges(mine[:, 1], mine[:, 2]) if len(mine) else []
        found.append((doc_id, len(raw), sum(b - a for a, b in runs), len(runs),
                      hashlib.sha256(op.without(raw, runs)).hexdigest()))
    assert found == brute(rows, 100)


def test_cases(frame, spark):
    assert result(op.deduplicate(spark.createDataFrame([], SCHEMA))) == []
    text = "é" * 200
    rows = [(4, text), (4, text), (None, text), (9, None)]
    got = {r["doc_id"]: r for r in op.deduplicate(frame(rows, SCHEMA)).collect()}
    assert got[4]["n_removed"] < 400 and got[None]["n_removed"] == 400 and got[9]["n_bytes"] == 0


def test_cleaned_keeps_columns(frame):
    text = "the quick brown fox jumps over the lazy dog and runs far away from the noisy crowd of people " * 2
    rows = [(1, "src", text[:150], 5), (2, None, "new " + text[:150] + " é tail", 5), (3, "x", None, None)]
    docs = frame(rows, "doc_id long, __text string, text string, n_chars int")
    out = {r["doc_id"]: r for r in op.cleaned(docs).collect()}
    assert out[1]["text"] == text[:150] and out[2]["text"] == "new " + " é tail" and out[3]["text"] is None
    assert op.cleaned(docs).columns == docs.columns


def by_version(spark, rows):
    """The rows' identity in order: doc_id (NULL last), then the hash of the text."""
    hashed = spark.createDataFrame(rows, SCHEMA).selectExpr("doc_id", "text", "xxhash64(text) as v").collect()
    return [((r["doc_id"] is None, r["doc_id"] or 0, r["v"]), r["text"]) for r in hashed]


def test_texts_under_one_id_are_apart(frame, spark, prose):
    """Different texts under one id and under NULL: no ranges of each other, and repeats among them are found."""
    texts = prose(13, docs=24)
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, t) for i, t in enumerate(texts)]
    rows += [(7, texts[1]), (None, texts[0]), (None, texts[2]), (7, None), (None, None), ((1 << 63) - 1, "tail " + texts[0])]
    got = op.deduplicate(frame(rows, SCHEMA))
    want = [((None if none else i), *rest) for (none, i, _), *rest in brute(by_version(spark, rows), 100)]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert any(r[0] is None and r[2] for r in want) and any(r[0] == 7 and r[2] for r in want)


def test_cleaned_keeps_texts_under_one_id_apart(frame):
    a, b = (" ".join(str(seed * 1000 + i) for i in range(200)) for seed in (1, 2))
    rows = [(1, a), (None, a + b[:300]), (None, "q" + b[300:])]
    assert sorted(r["text"] for r in op.cleaned(frame(rows, SCHEMA)).collect()) == sorted([a, b[:300], "q" + b[300:]])
