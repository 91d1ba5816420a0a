"""The operators bound to the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadscope.llm import (op01_ngram, op02_suffix_dedup, op03_ann, op04_decontaminate, op05_sharding, op06_langid,
                           op07_license, op08_simhash, op09_tokencount, op10_sentencepiece, op11_repair,
                           op12_variants, op13_lines)
from leadscope.llm.common import table


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file on the driver."""
    import public_tokenizers
    return public_tokenizers.path(name)


def ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op01_ngram.held_out_scores(table(spark, sf_dir, "documents"), remainder=1)


def suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op02_suffix_dedup.deduplicate(table(spark, sf_dir, "documents"), min_len=100)


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op03_ann.neighbours(table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0", k=10)


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op04_decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents over 96 shards."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return op05_sharding.place(docs, "doc_id", [f"shard-{i:03d}" for i in range(96)], size=65_537)


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op06_langid.identify(table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op07_license.scan(table(spark, sf_dir, "documents"), op07_license.default_templates(spark))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op08_simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3, max_bits=2)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op09_tokencount.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), limit=512)


def sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_sentencepiece.encode(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_repair.audits(op11_repair.damage(table(spark, sf_dir, "conversations")), "present")


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = op12_variants.word_counts(table(spark, sf_dir, "documents"), least_length=5, least_count=3, damage=97)
    return op12_variants.variants(words, ratio=2)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op13_lines.deduplicate(table(spark, sf_dir, "documents"), least=10)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_scores": ngram_scores,
    "op2_suffix_dedup": suffix_dedup,
    "op3_nearest_neighbours": nearest_neighbours,
    "op4_decontamination": decontamination,
    "op5_sharding": sharding,
    "op6_language_id": language_id,
    "op7_license_scan": license_scan,
    "op8_simhash_near_dedup": simhash_near_dedup,
    "op9_token_counts": token_counts,
    "op10_sentencepiece": sentencepiece,
    "op11_conversation_repair": conversation_repair,
    "op12_spelling_variants": spelling_variants,
    "op13_line_dedup": line_dedup,
}
