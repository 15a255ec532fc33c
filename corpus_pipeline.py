"""A corpus pipeline made of the operators in ``tidelog.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` applies them to the
``documents`` table, writing each stage's rows as Parquet for the next one to read.

Every stage takes the columns of documents by name and drops others, reads whole texts however
long they are, and returns no rows for an empty table. What it does with nulls, empty texts and
repeated rows is said at each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.llm import bpe, kneser_ney, lines, mixing, near_copies
from tidelog.llm.common import table
from tidelog.plans.scratch import written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity under the model of trusted texts is too high.

    Null and empty texts have no perplexity and stay, and so do languages without held-out
    trusted documents; a null lang is a language of its own, a null doc_id is never trusted, and
    repeated rows are judged each.
    """
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return kneser_ney.accepted(docs.select(*COLUMNS), trusted)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deletes later copies of every line, whatever its neighbours; n_chars follows the text.

    Null texts stay null (n_chars too), a text that loses all its lines becomes empty, blank
    lines stay, and repeated rows are copies of each other. No row is dropped.
    """
    kept = lines.dedup_lines(docs.select(*COLUMNS), min_lines=1).drop("removed")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the smallest doc_id, of each group of near copies:
    fingerprints at most eight bits apart and a Jaccard similarity of five-word shingles of 0.8.

    Null, empty and blank texts have one fingerprint, so one of them stays; of repeated rows one
    stays; a null doc_id is kept only where its group has no other.
    """
    return near_copies.one_of_each(docs.select(*COLUMNS))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats and samples documents until every source meets its target.

    A null source is a source of its own; texts without words have size 0; repeated rows are
    sampled together.
    """
    return mixing.mixed(docs.select(*COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the ids and of what they decode to, for every document.

    A null or empty text has no tokens and the digests of nothing; repeated rows are counted each.
    """
    import public_tokenizers

    vocabulary = bpe.from_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    encoded = bpe.encode(docs.select("doc_id", "source", "text"), vocabulary, public_tokenizers.PATTERN)
    return bpe.digests(encoded, vocabulary).drop("text")


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]

# SQL expresses no language model, fingerprint search or merge; tests hold the stages against
# brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage: doc_id, source, n_tokens, ids_sha256, decoded_sha256."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
