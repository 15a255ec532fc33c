"""Exact and approximate search against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelog.llm import nn_descent, topk
from tidelog.llm.common import table

SCHEMA = "vec_id long, embedding array<float>, query int, kind string"


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [
        (0, [0.5, 0.25, -1.0], 1, None),
        (1, [0.5, 0.25, -1.0], None, "x"),
        (2, None, 1, "x"),
        (3, [0.5, None, 1.0], 1, "x"),
        (4, [float("nan"), 0.0, 1.0], 1, "x"),
        (5, [float("inf"), 0.0, 1.0], 1, "x"),
        (6, [0.0, 0.0, 0.0], 1, "x"),
        (7, [1e30, 1.0, -1e30], 1, "x"),
        (8, [0.5], 1, "x"),
        (9, [], 1, "x"),
        (None, [1.0, 1.0, 1.0], 1, "x"),
        (100, [-0.001, 2.0, 0.3], 1, "x"),
        (1, [0.5, 0.25, -1.0], None, "x"),
    ]
    return spark.createDataFrame(rows, SCHEMA)


def literal_top(rows, k):
    held = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows]
    out = []
    for q, own in {i: v for i, v in held if i % 100 == 0}.items():
        scores = sorted(((-sum(a * b for a, b in zip(own, v)), i) for i, v in held if i != q))[:k]
        out += [(q, n + 1, i, max(min(-s, 2**63 - 1), -(2**63))) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def test_top_k_on_odd_rows(vectors):
    good = [(i, v) for i, v, *_ in vectors.collect() if i is not None and v is not None and i not in (3, 4, 5)]
    found = topk.top_k(vectors, F.col("vec_id") % 100 == 0, k=4, chunk_rows=3)
    assert sorted(map(tuple, found.collect())) == literal_top(good, 4)


def test_top_k_on_the_table(spark, sf):
    embeddings = table(spark, sf, "embeddings")
    rows = [(r.vec_id, r.embedding) for r in embeddings.collect()]
    found = topk.top_k(embeddings, F.col("vec_id") % 100 == 0, k=10)
    assert sorted(map(tuple, found.collect())) == literal_top(rows, 10)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert topk.top_k(empty, F.col("vec_id") % 100 == 0).count() == 0
    assert nn_descent.nearest(empty, F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_on_odd_rows(vectors):
    found = nn_descent.nearest(vectors, F.col("vec_id") % 50 == 0, k=3).collect()
    held = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect() if r.vec_id in (0, 1, 7, 100)}
    held[8] = np.array([0.5, 0, 0])
    for q in (0, 100):
        near = sorted((-float(np.float64(held[q] @ v) / np.linalg.norm(held[q]) / np.linalg.norm(v)), i) for i, v in held.items() if i != q)
        mine = sorted((r.rank, r.vec_id, r.score) for r in found if r.query_id == q)
        assert [i for _, i, _ in mine] == [i for _, i in near[:3]]
        assert all(abs(s + n) < 1e-9 for (_, _, s), (n, _) in zip(mine, near))


def test_recall_against_brute_force(spark, tmp_path):
    embeddings = table(spark, "/root/testdata/sf0.01", "embeddings")
    rows = {r.vec_id: np.array(r.embedding, float) for r in embeddings.collect()}
    ids = np.array(sorted(rows))
    unit = np.array([rows[i] / np.linalg.norm(rows[i]) for i in ids])
    found = {}
    for r in nn_descent.nearest(embeddings, F.col("vec_id") % 50 == 0, k=5).collect():
        found.setdefault(r.query_id, {})[r.vec_id] = r.score
    hits = 0
    for q in (queries := [i for i in ids if i % 50 == 0]):
        score = unit @ unit[np.searchsorted(ids, q)]
        score[np.searchsorted(ids, q)] = -9
        best = ids[np.lexsort((ids, -score))[:5]]
        hits += len(set(best) & set(found[q]))
        assert all(abs(score[np.searchsorted(ids, i)] - s) < 1e-12 for i, s in found[q].items())
    assert hits >= 0.9 * 5 * len(queries)


def test_recall_among_vectors_that_lie_close_together(spark):
    """Three crowds of vectors whose cosines differ from the sixth digit on, one vector many times."""
    rng = np.random.default_rng(3)
    crowd = rng.standard_normal((3, 32))[rng.integers(0, 3, 1500)] + 1e-3 * rng.standard_normal((1500, 32))
    held = np.concatenate((crowd, np.repeat(crowd[:1], 300, axis=0))).astype(np.float32)
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(held)], "vec_id long, embedding array<float>")
    found = {}
    for r in nn_descent.nearest(frame, F.col("vec_id") % 50 == 0, k=5).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id))
    unit = held.astype(float) / np.linalg.norm(held.astype(float), axis=1, keepdims=True)
    hits, queries = 0, range(0, 1500, 50)
    for q in queries:
        score = unit @ unit[q]
        score[q] = -9
        hits += len(set(np.argsort(-score, kind="stable")[:5]) & {i for _, i in found[q]})
    assert hits >= 0.9 * 5 * len(queries)
    same = [0, *range(1500, 1800)]
    for q in (i for i in same if i % 50 == 0):
        assert sorted(found[q]) == list(enumerate([i for i in same if i != q][:5], 1))
