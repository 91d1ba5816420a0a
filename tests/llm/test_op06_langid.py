import zlib

import numpy as np

from leadscope.llm import op06_langid as op
from leadscope.llm.common import table

SCHEMA = "doc_id long, text string, lang string, score string"


def test_cosine_against_plain_vectors(frame, prose):
    """Trigram vectors formed one by one give the same prediction and cosine."""
    texts = prose(3, docs=30)
    rows = [(i, t, "xy"[i % 2], None) for i, t in enumerate(texts)]
    got = {r["doc_id"]: r for r in op.identify(frame(rows, SCHEMA), dims=64).collect()}
    enc = op.Encoder(64, 7)

    def vector(text):
        out = np.zeros(64)
        symbols = [int(enc._table[ord(c)]) for c in text]
        padded = [0, *symbols, 0]
        for i in range(1, len(padded) - 1):
            if padded[i]:
                out += enc.bound[0][padded[i - 1]].astype(float) * enc.bound[1][padded[i]] * enc.bound[2][padded[i + 1]]
        return out

    train = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 5 != 0]
    sums = {k: sum(vector(r[1]) for r in train if r[2] == k) for k in "xy"}
    for doc_id, text, _, _ in rows:
        v = vector(text)
        if not v.any():
            continue
        cosines = {k: float(v @ s / np.linalg.norm(v) / np.linalg.norm(s)) for k, s in sums.items()}
        best = max("xy", key=lambda k: cosines[k])
        assert got[doc_id]["lang_pred"] == best and abs(got[doc_id]["score"] - max(0, cosines[best])) < 1e-9
        assert got[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = op.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out and lang is not null")
    rows = out.collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)


def test_cases(spark, frame):
    assert op.identify(spark.createDataFrame([], SCHEMA)).collect() == []
    rows = [(1, None, "a", ""), (2, "", "a", ""), (3, "123 ..!", "a", ""), (None, "abc", "a", ""), (5, "abc abd", "a", "z"),
            (6, "abc", None, None), (5, "abc abd", "a", "z"), (7, "x" * 200_000, "b", None), (8, "ෟ\U0001d51e", "b", None)]
    got = [(r["doc_id"], r["lang_pred"], r["score"]) for r in op.identify(frame(rows, SCHEMA)).collect()]
    assert len(got) == 9
    assert {p for d, p, s in got if d in (1, 2, 3)} == {"und"} and all(0 <= s <= 1 for _, _, s in got)
    unlabelled = [(1, "some text", None, None)]
    assert [r["lang_pred"] for r in op.identify(frame(unlabelled, SCHEMA)).collect()] == ["und"]


def test_cache_reset_changes_nothing():
    texts = ["abc def ghi jkl", "mno pqr stu", "abc xyz éèà"]
    full, small = op.Encoder(32, 7), op.Encoder(32, 7, keep=5)
    for t in texts:
        a, b = full.trigrams([t])[0], small.trigrams([t])[0]
        assert np.array_equal(full.bundle(a), small.bundle(b))


def test_every_letter_has_a_vector_of_its_own():
    letters = op.Encoder(512, 7).bound[2][np.arange(0x4E00, 0xA000)]
    assert len(np.unique(letters, axis=0)) == 0xA000 - 0x4E00
    assert np.array_equal(letters[:3], op.Letters(7, 512, 0)[np.array([0x4E00, 0x4E01, 0x4E02])])


def test_alphabets_of_many_letters(frame):
    """Languages of one script that differ by a shift of their letters, in two scripts."""
    rng = np.random.default_rng(4)
    rows = []
    for lang, first, size in [("h1", 0x4E00, 101), ("h2", 0x4E00 + 101, 101), ("h3", 0x6000, 3000), ("c1", 0x430, 16), ("c2", 0x440, 16)]:
        words = ["".join(chr(first + int(i)) for i in rng.integers(0, size, 5)) for _ in range(200)]
        rows += [(len(rows) + i, " ".join(rng.choice(words, 60)), lang, None) for i in range(40)]
    got = op.identify(frame(rows, SCHEMA)).collect()
    want = {r[0]: r[2] for r in rows}
    assert sum(r["lang_pred"] == want[r["doc_id"]] for r in got) >= 0.97 * len(rows)


def test_vectors_beyond_the_kept_ones():
    """Trigrams whose vectors are not held give the same sums, in blocks of any size."""
    rng = np.random.default_rng(5)
    text = "".join(chr(0x4E00 + int(i)) for i in rng.integers(0, 500, 3000)) + " abc é"
    full, small = op.Encoder(64, 7), op.Encoder(64, 7, keep=100, block=64)
    assert np.array_equal(full.bundle(full.trigrams([text])[0]), small.bundle(small.trigrams([text])[0]))
    assert len(small.vectors) == 100
