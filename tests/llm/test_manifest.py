"""The manifest against a tree built in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tidelog.llm import merkle
from tidelog.llm.common import table
from tidelog.llm.oracles import ORACLES
from tidelog.llm.queries import QUERIES
from tests.compare import compare, database


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(row, text):
    return digest(*map(told, (row.doc_id, row.source, row.lang, row.n_chars, text)))


def tree(nodes, arity):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([digest(*below[i : i + arity]) for i in range(0, len(below), arity)])
    return levels


def path_of(levels, i, arity):
    out = []
    for nodes in levels[:-1]:
        start = i // arity * arity
        out.append((nodes[start:i], nodes[i + 1 : start + arity]))
        i //= arity
    return out


def lowered(text):
    return text.encode().lower().decode()


def audited(rows, arity):
    by = {}
    for row in rows:
        by.setdefault(row.source, []).append(row)
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for name in names:
        by[name].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf_of(r, r.text)))
    trees = {name: tree([leaf_of(r, r.text) for r in by[name]], arity) for name in names}
    top = tree([trees[name][-1][0] for name in names], arity)
    out = []
    for at, name in enumerate(names):
        for i, row in enumerate(by[name]):
            path = path_of(trees[name], i, arity) + path_of(top, at, arity)
            text = row.text
            if row.doc_id is not None and text is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0:
                text = lowered(text)
            end = leaf_of(row, text)
            for left, right in path:
                end = digest(*left, end, *right)
            siblings = digest(*[d for left, right in path for d in left + right])
            root = top[-1][0]
            out.append((row.doc_id, trees[name][0][i], trees[name][-1][0], root, siblings, end, end == root))
    return sorted(out, key=repr)


def audit(documents, **shape):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    found = merkle.audit(documents, tampered, merkle.lowered(F.col("text")), **shape)
    assert found.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, found.collect()), key=repr)


@pytest.mark.parametrize("arity, keep", [(16, 2), (2, 2), (2, 3), (3, 1)])
def test_table_of_many_sources(spark, arity, keep):
    """A source with most rows, sources of one row, and more levels than a subtree holds."""
    rows = spark.range(190).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 31 == 0, F.concat(F.lit("s"), F.col("id")))
        .when(F.col("id") % 7 != 1, F.concat(F.lit("é"), F.col("id") % 5)).alias("source"),
        F.lit("en").alias("lang"),
        F.col("id").alias("n_chars"),
        F.concat(F.lit("Text Ä "), F.col("id") % 50).alias("text"),
    )
    assert audit(rows, arity=arity, keep=keep) == audited(rows.collect(), arity)


def test_odd_rows(messy):
    got = audit(messy)
    assert got == audited(messy.collect(), 16)
    assert len(got) == messy.count()


def test_one_row_and_none(messy, none):
    lone = messy.where("doc_id = 3")
    assert audit(lone) == audited(lone.collect(), 16)
    assert audit(none) == []


def test_proof_paths_and_subroots(spark, sf):
    documents = table(spark, sf, "documents").select(
        "doc_id", "source", merkle.leaf_digest(*[F.col(c) for c in merkle.COLUMNS]).alias("leaf"), "n_chars"
    )
    manifest = merkle.build(documents)
    assert manifest.subroots().count() == documents.select("source").distinct().count()
    rows = manifest.proofs().collect()
    assert len(rows) == documents.count()
    for row in rows:
        end = row.leaf
        for step in row.path:
            end = digest(step.left, end, step.right)
        assert end == manifest.root and row.n_chars is not None
    manifest.delete()


@pytest.mark.parametrize("name", ["op11_embedding_dedup", "op12_manifest", "op13_resampling"])
def test_query_matches_sql(spark, sf, name):
    assert compare(spark, database(sf), QUERIES[name], ORACLES[name], sf) is None
