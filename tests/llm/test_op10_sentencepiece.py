import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from leadscope.llm import op10_sentencepiece as op
from leadscope.llm.common import table
from leadscope.llm.merges import merge_down

PATH = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = ["", "a", " ", "   ", "a  b\tc\n d ", "  x", "é漢\U0001F600", "▁a <s> </s> <0x41>", "a b　ﬁ", "a\0b", "aaaa" * 60,
         "ab" * 200, "don't  stop " * 50, "ßüöä", "￿�", "x" * 300 + " yy", "the " * 2000, "\U0001F600" * 40]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return op._vocabulary(op.read_model(PATH))


def split(ids, counts):
    ends = np.concatenate([[0], np.cumsum(counts)])
    return [ids[a:b].tolist() for a, b in zip(ends, ends[1:])]


def test_against_library(library, vocabulary):
    assert split(*op.encode_texts(TEXTS, vocabulary)) == library.encode(TEXTS)
    assert [op.decode_ids(i, vocabulary) for i in library.encode(TEXTS)] == library.decode(library.encode(TEXTS))


def test_random_strings(library, vocabulary):
    rng = np.random.default_rng(6)
    letters = list("abcdestinghe  rvlmIZ09.,!\n\té漢▁") + ["the", "tion", "\U0001F601"]
    texts = ["".join(rng.choice(letters, rng.integers(1, 80))) for _ in range(2000)]
    assert split(*op.encode_texts(texts, vocabulary, chars=5000)) == library.encode(texts)


def test_documents_and_round_trip(spark, library):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = op.encode(docs, PATH).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert [r["ids"] for r in rows] == library.encode([r["text"] for r in rows])
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)


def test_decode_frame(spark, library, frame):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(99, None)]
    docs = frame(rows, "doc_id long, text string")
    back = {r["doc_id"]: r["text"] for r in op.decode(op.encode(docs, PATH), PATH).collect()}
    assert back == {i: None if t is None else library.decode(library.encode(t)) for i, t in rows}


def test_long_words_and_parts(library, vocabulary, monkeypatch):
    monkeypatch.setattr(op, "LONG_WORD", 5)
    texts = TEXTS + ["internationalization of 漢字漢字 things", "a" * 50]
    assert split(*op.encode_texts(texts, vocabulary)) == library.encode(texts)
    text = "some words  and   more " * 40
    parts = [p for _, p in op._units([text], chars=17)]
    assert "".join(parts) == op.MARK + text.replace(" ", op.MARK) and all(p[0] == op.MARK for p in parts)


def test_adjacency_against_merging(vocabulary):
    """The border test agrees with merging the two tokens' characters."""
    rng = np.random.default_rng(7)
    rules = vocabulary.rules
    made = {int(r): i for i, r in enumerate(rules.rank.tolist()) if r >= 0}
    names = {i: p for p, i in vocabulary.text.items()}
    usable = [i for i in names if vocabulary.usable[i]]
    common = usable[:3000]
    a, b = rng.choice(common, 3000), rng.choice(common, 3000)
    got = rules.adjacent(a, b)
    for x, y, ok in zip(a.tolist(), b.tolist(), got.tolist()):
        tokens, _ = merge_down([vocabulary.text[c] for c in names[x] + names[y]], rules.pairs, made)
        assert ok == (tokens == [x, y]) == rules.adjacent_one(x, y)


def test_cases(spark, frame):
    schema = "doc_id long, text string, ids string, n_tokens int"
    assert op.encode(spark.createDataFrame([], schema), PATH).collect() == []
    got = op.encode(frame([(None, "a", "x", 1), (2, None, None, None), (3, "", "", 0), (3, "", "", 0)], schema), PATH).collect()
    by = sorted(((r["doc_id"] or 0, r["n_tokens"], r["ids"] is None, r["round_trip"]) for r in got), key=str)
    assert by == [(0, 1, False, True), (2, 0, True, None), (3, 0, False, True), (3, 0, False, True)]


def _coded(words, vocabulary):
    text = np.concatenate([np.append(vocabulary.code[[ord(c) for c in w]], 0) for w in words]).astype(np.uint16)[:-1]
    left = np.concatenate([np.arange(len(w), -1, -1) for w in words])[:-1].astype(np.int32)
    return text, left


@pytest.mark.parametrize("letters, length", [("a", 40), ("ab", 30), ("etaoins▁", 25), (None, 12)])
def test_occurrences_against_search(vocabulary, letters, length):
    """Letters of many widths: alphabets of one character up to all characters of the pieces."""
    rng = np.random.default_rng(8)
    letters = list(letters or sorted({c for p in vocabulary.text for c in p}) + ["\U0001F601"])
    words = ["".join(rng.choice(letters, rng.integers(1, length))) for _ in range(300 if len(letters) < 99 else 2000)]
    words += ["▁international" + w for w in words[:50]]
    start, row = op.occurrences(*_coded(words, vocabulary), vocabulary)
    assert (np.diff(vocabulary.piece_len[row]) <= 0).all()
    names = {i: p for p, i in [*vocabulary.text.items(), *vocabulary.atom.items()]}
    usable = {names[i]: k for k, i in enumerate(vocabulary.piece_ids.tolist())}
    text = "\n".join(words)
    expected = sorted((at, usable[text[at:at + n]]) for at in range(len(text)) for n in range(1, vocabulary.longest + 1)
                      if at + n <= len(text) and text[at:at + n] in usable)
    assert sorted(zip(start.tolist(), row.tolist())) == expected


def test_suffixes_are_sorted_deeply_only_where_they_tie(spark, vocabulary, monkeypatch):
    """The CPU time of a group is mostly its suffix sort: of all suffixes' letters only a part is compared."""
    texts = [r["text"] for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").limit(300).collect()]
    words = {w for t in texts for w in (op.MARK + t.replace(" ", " " + op.MARK)).split(" ")}
    sorted_letters, lexsort = [], np.lexsort
    monkeypatch.setattr(np, "lexsort", lambda keys, *a, **k: (sorted_letters.append(sum(map(len, keys))), lexsort(keys, *a, **k))[1])
    ids, counts = op.encode_words(sorted(words), vocabulary)
    assert len(counts) == len(words) and counts.sum() == len(ids)
    assert sum(sorted_letters) < sum(map(len, words))
