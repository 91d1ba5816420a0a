import random

import public_tokenizers
import sentencepiece

import corpus_pipeline
from tests.llm import test_op04_decontaminate as t04
from tests.llm import test_op08_simhash as t08

CLASHING = ["extra", "__version", "version", "lang_pred", "lang_pred_told", "told", "told_score", "__doc", "doc", "__ranges",
            "ranges", "none", "key", "hash", "id", "part", "at", "fp", "score", "term", "pos", "component_id"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def without_repeats(rows, n=100):
    """The texts without bytes of n-byte strings that start earlier; broken characters go whole."""
    first, out = {}, []
    for doc_id, text in rows:
        raw = text.encode()
        for i in range(len(raw) - n + 1):
            first[raw[i:i + n]] = min(first.get(raw[i:i + n], (doc_id, i)), (doc_id, i))
    for doc_id, text in rows:
        raw = text.encode()
        gone = set()
        for i in range(len(raw) - n + 1):
            if first[raw[i:i + n]] < (doc_id, i):
                gone |= set(range(i, i + n))
        out.append((doc_id, bytes(b for i, b in enumerate(raw) if i not in gone).decode("utf-8", "ignore")))
    return out


def brute(rows, items):
    kept = [(i, t) for i, t, *_ in rows if t and any(c.isalpha() for c in t)]
    last = 1 << 62                                              # rows without an id come last
    kept = [(last if i is None else i, t) for i, t in kept]
    groups = {i: c for i, _, c in t08.brute(kept, 3, 2)}
    kept = sorted({i: t for i, t in kept if groups[i] == i}.items())
    kept = [(None if i == last else i, t) for i, t in without_repeats(kept)]
    kept = [(i, t) for i, t in kept if not t04.brute([(i, t)], items, 10)[0][5]]
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    return {i: lib.encode(t) for i, t in kept}


def test_against_brute_force(spark, tmp_path, prose):
    rng = random.Random(1)
    texts = prose(11, docs=60, words=200)
    items = [(k, " ".join(rng.choice("red green blue été sea sky tree hill road".split()) for _ in range(20))) for k in range(5)]
    texts[7] += " " + items[1][1]
    texts[9] = items[2][1].upper() + "! " + texts[9]
    texts += [texts[20], texts[21] + " tail", texts[22], None, "", "123 456", " ", texts[30] * 2, "ß" * 300]
    rows = [(i, t, rng.choice(["xx", "yy", None]), "s", len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[3], (None, "no id here at all", "xx", "s", 5)]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path))
    want = brute(rows, items)
    found = got.collect()
    assert len(found) == len(want) and {r["doc_id"]: r["ids"] for r in found} == want
    assert all(r["round_trip"] for r in found) and 0 < len(want) < len(rows)


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name in CLASHING:
        docs = docs.withColumn(name, docs_extra())
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "/root/testdata/sf0.001")
        assert out.schema.names == docs.schema.names and [f.dataType for f in out.schema] == [f.dataType for f in docs.schema]
        assert out.where(" or ".join(f"`{c}` <> 'x' or `{c}` is null" for c in CLASHING)).count() == 0 < out.count()


def docs_extra():
    from pyspark.sql import functions as F
    return F.lit("x")


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_documents_stay_when_no_language_is_learned(spark, frame):
    texts = {1: "plain words", 2: "123 456", 3: None, 4: "ß", 5: ""}
    docs = frame([(i, t, None, "s", len(t or "")) for i, t in texts.items()], SCHEMA)
    assert sorted(r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()) == [1, 4]


def test_texts_under_one_id_stay_when_they_link_to_nothing(spark, frame):
    a, b, c = [" ".join(f"{w}{seed}{i}" for i in range(200) for w in ("x", "yz")) for seed in "abc"]
    rows = [(1, a), (1, b), (1, a), (2, b), (3, c), (3, c.upper()), (4, a)]
    docs = frame([(i, t, None, "s", len(t)) for i, t in rows], SCHEMA)
    got = sorted((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) h").collect()}
    assert got == sorted([(1, a), (1, b), (3, min(c, c.upper(), key=hashes.get))])


def test_rows_without_an_id_stay_when_they_link_to_nothing(spark, frame):
    a, b, c = [" ".join(f"{w}{seed}{i}" for i in range(200) for w in ("x", "yz")) for seed in "abc"]
    docs = frame([(i, t, None, "s", len(t)) for i, t in [(None, a), (None, a), (None, b), (7, b), (None, c)]], SCHEMA)
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()))
    assert got == sorted([(0, a), (7, b), (0, c)])


def test_clashing_columns_under_shared_ids(spark, frame):
    """Texts under one id take the way with numbers of their own."""
    texts = [" ".join(f"{w}{k}{i}" for i in range(60) for w in ("x", "yz")) for k in range(4)]
    docs = frame([(1, texts[0], None, "s", 1), (1, texts[1], None, "s", 1), (None, texts[2], None, "s", 1), (2, texts[3] + texts[0], None, "s", 1)], SCHEMA)
    plain = {r["text"] for r in corpus_pipeline.repeated_passages(spark, docs, "").collect()}
    for name in CLASHING:
        docs = docs.withColumn(name, docs_extra())
    rows = corpus_pipeline.repeated_passages(spark, docs, "").collect()
    assert {r["text"] for r in rows} == plain and all(r[c] == "x" for r in rows for c in CLASHING)
