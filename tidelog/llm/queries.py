"""Registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import (
    bpe, embedding_dedup, kneser_ney, lines, merkle, mixing, nn_descent, passages, resampling, simhash, token_counts,
    topk, toxicity,
)
from tidelog.llm.common import table


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    _, verdicts = kneser_ney.judge(documents, trusted)
    return verdicts.select("doc_id", "lang", "perplexity", "threshold", "keep")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(documents).select("doc_id", "size", "source_size", "target", "taken")


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary = bpe.from_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.digests(bpe.encode(documents, vocabulary, public_tokenizers.PATTERN), vocabulary).drop("text")


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.near_passages(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return simhash.near_duplicates(documents).select("doc_id", digits.alias("fingerprint"), "component_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    vocabulary, specials, _ = bpe.from_json(public_tokenizers.path("byte_bpe_50k.json"))
    counted = token_counts.token_counts(documents, vocabulary, specials, public_tokenizers.PATTERN)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.size("removed").cast("long").alias("lines_removed")
    return lines.dedup_lines(documents).select("doc_id", "text", removed)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_copies(table(spark, sf_dir, "embeddings"), threshold=0.98)


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return merkle.audit(table(spark, sf_dir, "documents"), tampered, merkle.lowered(F.col("text")))


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_top_k": op1_top_k,
    "op2_quality": op2_quality,
    "op3_mixing": op3_mixing,
    "op4_bpe": op4_bpe,
    "op5_passages": op5_passages,
    "op6_simhash": op6_simhash,
    "op7_token_counts": op7_token_counts,
    "op8_line_dedup": op8_line_dedup,
    "op9_nn_descent": op9_nn_descent,
    "op10_toxicity": op10_toxicity,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_manifest": op12_manifest,
    "op13_resampling": op13_resampling,
}
