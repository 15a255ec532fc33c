"""Importance resampling against a plain version."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidelog.llm import resampling
from tidelog.llm.common import table

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def windows(text, longest):
    words = WORD.findall((text or "").encode().lower().decode())
    runs = [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
    return len(words), runs


def literal(rows, wanted, longest=1, buckets=10_000, percent=10, min_words=20):
    def hashed(text):
        return [zlib.crc32(w.encode()) % buckets for w in windows(text, longest)[1]]

    corpus, target = Counter(), Counter()
    for row in rows:
        corpus.update(hashed(row.text))
    for row in wanted:
        target.update(hashed(row.text))
    s, t = sum(corpus.values()), sum(target.values())
    out = []
    for row in rows:
        ratios = [(target[b] + 1) * (s + buckets) / ((corpus[b] + 1) * (t + buckets)) for b in hashed(row.text)]
        weight = sum(math.floor(1000 * math.log(r)) for r in ratios)
        name = "" if row.doc_id is None else row.doc_id
        h = int(hashlib.sha256(f"2024:{name}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([row.doc_id, len(ratios), weight, weight + noise, None, windows(row.text, 1)[0]])
    able = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for place, row in enumerate(able[: percent * len(able) // 100]):
        row[4] = place + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def found(*args, **how):
    rows = resampling.importance(*args, **how)
    assert rows.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    return sorted(map(tuple, rows.collect()), key=repr)


def test_the_table(spark, sf):
    documents, benchmark = table(spark, sf, "documents"), table(spark, sf, "benchmark")
    assert found(documents, benchmark) == literal(documents.collect(), benchmark.collect())


@pytest.mark.parametrize("longest", [1, 3])
def test_odd_rows(messy, longest):
    target = messy.where("doc_id in (6, 7) or doc_id = 2").select("text", "key")
    how = {"longest": longest, "buckets": 500, "percent": 50, "min_words": 5}
    assert found(messy, target, **how) == literal(messy.collect(), target.collect(), **how)


def test_empty_tables(messy, none):
    assert found(none, messy) == []
    assert found(messy, none) == literal(messy.collect(), [])


def test_drawn_documents_keep_their_columns(spark, sf):
    documents = table(spark, sf, "documents").withColumn("_drawn", F.lit("x"))
    benchmark = table(spark, sf, "benchmark")
    kept = resampling.resampled(documents, benchmark)
    assert kept.columns == documents.columns
    ranked = {r[0] for r in found(documents, benchmark) if r[4] is not None}
    assert {r.doc_id for r in kept.collect()} == ranked and ranked


def test_windows_are_joined_by_single_spaces():
    split = resampling.splitter()
    words, hashes = resampling.window_hashes("Don't  É9-x".encode(), 2, split)
    told = ["don", "t", "É9", "x", "don t", "t É9", "É9 x"]
    assert words == 4 and hashes.tolist() == [zlib.crc32(w.encode()) for w in told]
