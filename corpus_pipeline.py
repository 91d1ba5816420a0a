"""From raw documents to token ids: five stages over the ``documents`` table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of
``documents``.  ``run`` writes each stage's rows as Parquet in the shared folder and hands the reread table
to the next one.

Defined cases: documents without a letter (NULL and empty texts too) go in the first stage, and no others,
whatever languages were learned and also if none was; all rows but one of a near-duplicate group go in the
second (the smallest id stays, and of its texts there the one with the smallest XXH64; rows without an id
come last); rows without an id and texts under one id stay like any other where they link to nothing; texts
that the third stage empties stay as empty documents; extra columns are carried along whatever their names:
helper columns take names that the input does not have.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadscope.llm import op02_suffix_dedup, op04_decontaminate, op06_langid, op08_simhash, op10_sentencepiece
from leadscope.llm.common import fresh, table, written
from leadscope.llm.queries import tokenizer

#: SQL cannot form the language vectors, XXH64 fingerprints or token ids; tests/llm/test_pipeline.py
#: compares the rows with a brute-force version.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents in which no language can be told."""
    languages, vectors = op06_langid.prototypes(docs)
    if not languages:       # nothing learned: one name for every text with a letter
        languages, vectors = [""], np.zeros((1, vectors.shape[1]))
    names = fresh(docs, "told", "told_score")
    told = op06_langid.predict(docs, languages, vectors, keep=docs.columns, names=tuple(names))
    return told.where(F.col(names[0]) != op06_langid.UNDETERMINED).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row with the smallest (id, hash of the text) of each near-duplicate group; ids come before none."""
    first = op08_simhash.first_rows(docs, width=3, max_bits=2).select(F.col("doc_id").alias("id"), F.col("version").alias("hash"))
    version, = fresh(docs, "version")
    marked = docs.withColumn(version, F.xxhash64("text"))
    kept = marked.join(first.hint("shuffle_hash"), marked["doc_id"].eqNullSafe(first["id"])
                       & (marked[version] == first["hash"]), "left_semi")
    return kept.dropDuplicates(["doc_id", version]).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes strings of 100 bytes that an earlier document or place holds out of the texts."""
    out = op02_suffix_dedup.cleaned(docs, min_len=100)
    return out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold ten consecutive words of a benchmark item."""
    return op04_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"), width=10).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, round_trip."""
    return op10_sentencepiece.encode(docs, tokenizer("piece_bpe_32k.model"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_dedup", repeated_passages),
    ("decontamination", benchmark_free),
    ("sentencepiece", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
