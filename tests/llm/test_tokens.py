"""BPE encoding, decoding and counting against the libraries."""

import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidelog.llm import bpe, token_counts

PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def ranks():
    return bpe.from_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def library():
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def key(row):
    return (row.doc_id is None, row.doc_id, row.source or "")


def test_encoding_equals_the_library_and_decodes_back(messy, ranks, library):
    encoded = bpe.encode(messy, ranks, PATTERN, rows=4)
    assert encoded.columns == [*messy.columns, "ids"]
    rows = encoded.withColumn("back", bpe.decode(F.col("ids"), ranks)).collect()
    assert len(rows) == messy.count()
    for row in rows:
        assert row.ids == library.encode_ordinary(row.text or "")
        assert bytes(row.back).decode() == (row.text or "")
    for row in bpe.digests(encoded, ranks).select("text", "n_tokens", "ids_sha256", "decoded_sha256").collect():
        ids = library.encode_ordinary(row.text or "")
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256((row.text or "").encode()).hexdigest()


def test_native_fold_equals_the_other(spark, ranks):
    words = [" thblestand", "zzzzq", "naïveté", " a", "\n\n\n", " " * 40, "ab" * 90, "日本語"]
    table = spark.createDataFrame([(w,) for w in words], "key string")
    start = ranks.start
    for row in bpe.encode_words(table, ranks, native=True).collect():
        assert row.ids == bpe.merge_bytes(row.key.encode(), start, ranks.merges)


def test_short_and_long_merges_agree(ranks):
    word = b"thhhhhinkingeseses"
    one = bpe.merge_bytes(word, ranks.start, ranks.merges)
    two = bpe.merge_bytes(word + b"\n" * 40, ranks.start, ranks.merges)
    assert two[: len(one)] == one


def test_counts_equal_the_library(messy, none):
    path = public_tokenizers.path("byte_bpe_50k.json")
    vocabulary, specials, _ = bpe.from_json(path)
    library = Tokenizer.from_file(path)
    counted = token_counts.token_counts(messy, vocabulary, specials, PATTERN, rows=4)
    rows = counted.collect()
    assert len(rows) == messy.count()
    for row in rows:
        text = row.text or ""
        wanted = len(library.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), wanted, wanted > 512)
    assert token_counts.token_counts(none, vocabulary, specials, PATTERN).count() == 0


def test_empty_table(none, ranks):
    assert bpe.encode(none, ranks, PATTERN).count() == 0


def test_a_column_named_like_the_ids_is_replaced(messy, ranks, library):
    clash = messy.withColumnRenamed("key", "ids")
    rows = bpe.encode(clash, ranks, PATTERN, rows=4).collect()
    assert all(r.ids == library.encode_ordinary(r.text or "") for r in rows) and len(rows) == messy.count()
