import json

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from leadscope.llm import op09_tokencount as op
from leadscope.llm.common import table

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "a", " ", "  ", "\n\n a  b\t\tc  ", "it's we're  I'll 'tis ''s !'s 's's \n's ' re don't DON'T o'rea 'll've'd'D",
         "<|endoftext|>", "x <|endoftext|><|endoftext|> y  <|endoftext|>", "  <|endoftext|>  z's", "漢字かな交じり文 test",
         "\U0001F600\U0001F601 é̂", "a b　c", "12 3４ Ⅷ½", "\0\x01 \x7f", "aaaa" * 50, "ab" * 300, "  x\x85y",
         "x" * 9000 + " y", "word " * 3000, "re've", "'", "a'", "tab\tx", "!? ?!"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def own():
    return op._tokenizer(op.read_definition(PATH))


def want(library, texts):
    return [len(e.ids) for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_cases_against_library(library, own):
    assert own.counts(TEXTS).tolist() == want(library, TEXTS)


def test_random_strings_against_library(library, own):
    rng = np.random.default_rng(4)
    letters = list("abcdest 'rvelmIZ09.,!\n\t é漢") + ["  ", "'s", "'re", "the", "ing", "<|endoftext|>"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 60))) for _ in range(1500)]
    assert own.counts(texts).tolist() == want(library, texts)


def test_documents_against_library(spark, library):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = op.token_counts(docs, PATH).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert [r["n_tokens"] for r in rows] == want(library, [r["text"] for r in rows])
    assert all(r["n_bytes"] == len(r["text"].encode()) and r["over_limit"] == (r["n_tokens"] > 512) for r in rows)


def test_chunk_maps_compose():
    """Starts found chunk by chunk equal those of one pass, for any chunk length."""
    rng = np.random.default_rng(5)
    symbols = rng.integers(0, op.SYMBOLS, 2000).astype(np.uint8)
    state, plain = op.FRESH, []
    for i, s in enumerate(symbols.tolist()):
        if op.EMITS[state, s]:
            plain.append(i)
        state = op.NEXT[state, s]
    for chunk in (1, 7, 64, 5000):
        assert op.word_starts(symbols, chunk).tolist() == plain


def test_cache_reset_changes_nothing(library, monkeypatch):
    own = op.Tokenizer(op.read_definition(PATH))
    monkeypatch.setattr(op.Counter, "MOST", 20)
    for _ in range(2):
        assert own.counts(TEXTS).tolist() == want(library, TEXTS)


def test_long_text_in_parts(library, frame):
    text = "it's  a 'long' text, isn't it?\n  yes " * 300
    rows = [(1, text, "x"), (None, None, None), (3, "", "y"), (1, text, "x")]
    got = op.token_counts(frame(rows, "doc_id long, text string, n_tokens string"), PATH, group_chars=100).collect()
    n = want(library, [text])[0]
    assert sorted((r["doc_id"] or 0, r["n_tokens"]) for r in got) == [(0, 0), (1, n), (1, n), (3, 0)]


def test_empty_and_refused(spark):
    assert op.token_counts(spark.createDataFrame([], "doc_id long, text string"), PATH).collect() == []
    spec = json.loads(op.read_definition(PATH))
    spec["pre_tokenizer"]["add_prefix_space"] = True
    with pytest.raises(ValueError):
        op.Tokenizer(json.dumps(spec))


def _long_texts():
    rng = np.random.default_rng(9)
    letters = [chr(c) for c in (*range(65, 91), *range(97, 123))]
    return ["".join(rng.choice(letters, 120_000)), "a" * 100_003, "abcab" * 20_000, "=" * 70_001,
            ("a" * 5000 + "the" * 3000 + "é" * 7000) * 2, "".join(map(chr, rng.integers(0x4E00, 0x9FFF, 20_000))),
            "x" * 4096, "x" * 4097, "short " * 50]


def test_long_words_against_library(library, own):
    texts = _long_texts()
    assert own.counts(texts).tolist() == want(library, texts)
    assert [own.counts([t])[0] for t in texts] == want(library, texts)


def test_stretches_rounds_and_resets_change_nothing(library, own, monkeypatch):
    """Tiny chunks and stretches, states thrown away between stretches, and following words from their start."""
    texts = [t[:9_000] for t in _long_texts()]
    for name, value in (("LONG", 40), ("CHUNK", 16), ("WARM", 3), ("STRETCH", 1_000), ("MOST", 10)):
        monkeypatch.setattr(op.Counter, name, value)
    assert own.counts(texts).tolist() == want(library, texts)
    monkeypatch.setattr(op.Counter, "ROUNDS", 1)
    assert own.counts(texts).tolist() == want(library, texts)


def test_a_text_of_ten_megabytes_without_white_space(library, own):
    text = "QWxhZGRpbjpvcGVuIHNlc2FtZQ" * 400_000
    assert own.counts([text]).tolist() == want(library, [text])
