"""Near-duplicate vectors against brute force."""

import numpy as np
import pytest

from tidelog.llm import embedding_dedup as dedup
from tidelog.llm.common import table

SCHEMA = "vec_id long, embedding array<double>, label int, number int, salt string"


def literal(rows, threshold):
    """n_links, component and kept by comparing every pair of rows."""
    def able(row):
        v = row.embedding
        fine = v is not None and all(x is not None and np.isfinite(x) for x in v) and any(v)
        return fine and row.label is not None and row.vec_id is not None

    width = max((len(r.embedding) for r in rows if r.embedding), default=1)
    vectors = [np.array([*r.embedding, *[0.0] * (width - len(r.embedding))]) if able(r) else None for r in rows]
    # Powers of two keep squares in range.
    vectors = [v if v is None else np.ldexp(v, -np.frexp(np.abs(v).max())[1]) for v in vectors]
    near = [[] for _ in rows]
    for i, a in enumerate(vectors):
        for j in range(i):
            b = vectors[j]
            if a is None or b is None or rows[i].label != rows[j].label:
                continue
            if a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) >= threshold:
                near[i].append(j)
                near[j].append(i)
    out = []
    for i, row in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        root = row.vec_id if len(seen) == 1 else min(rows[j].vec_id for j in seen)
        out.append((row.vec_id, len(near[i]), root, row.vec_id is not None and row.vec_id == root))
    return sorted(out, key=repr)


def found(vectors, **how):
    rows = dedup.near_copies(vectors, **how)
    assert [t for _, t in rows.dtypes] == ["bigint", "bigint", "bigint", "boolean"]
    return sorted(map(tuple, rows.collect()), key=repr)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0, 0.0], 1, 5, "x"), (2, [1.0, 0.01, 0.0], 1, None, None), (3, [1.0, 0.0, 0.0], 2, 1, ""),
        (4, None, 1, 1, "x"), (5, [0.0, 0.0, 0.0], 1, 1, "x"), (6, [1.0, None, 0.0], 1, 1, "x"),
        (7, [nan, 1.0, 0.0], 1, 1, "x"), (8, [inf, 1.0, 0.0], 1, 1, "x"), (9, [1.0, 0.0, 0.0], None, 1, "x"),
        (10, [1.0, 0.0, 0.0], None, 1, "x"), (None, [1.0, 0.0, 0.0], 1, 1, "x"), (11, [2.0], 1, 1, "x"),
        (12, [], 1, 1, "x"), (13, [1e300, 1e298, 0.0], 1, 1, "x"), (14, [1e-310, 0.0, -0.0], 1, 1, "x"),
        (1, [1.0, 0.0, 0.0], 1, 5, "x"), (15, [-1.0, 0.0, 0.0], 1, 1, "x"), (0, [-1.0, -0.1, 0.0], 1, 1, "x"),
        (16, [0.0, 0.0, 7.0], 3, 1, "x"),
    ]
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert found(vectors) == literal(vectors.collect(), 0.98)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []


@pytest.mark.parametrize("threshold", [0.98, 0.7, -0.2])
def test_groups_chains_and_noise(spark, threshold):
    """A label with most vectors: copies, a tight group, a chain and noise, in small tiles."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=20)
    chain, step = [], base
    for _ in range(30):
        step = step + rng.normal(size=20) * 0.1 * np.linalg.norm(step) / np.sqrt(20)
        chain.append(step)
    tight = [rng.normal(size=20) * 0.02 + rng.normal(size=20) * 0 + base[::-1] for _ in range(60)]
    noise = list(rng.normal(size=(80, 20)))
    copies = [base * 3] * 40
    rows = [(1000 - i, list(map(float, v)), 1 if i % 9 else 2, i, None) for i, v in enumerate([*chain, *tight, *noise, *copies])]
    vectors = spark.createDataFrame(rows, SCHEMA)
    assert found(vectors, threshold=threshold, tile=16) == literal(vectors.collect(), threshold)


def test_threshold_must_leave_an_angle(spark):
    with pytest.raises(ValueError):
        dedup.near_copies(spark.createDataFrame([], SCHEMA), threshold=1.0)


def test_the_table(spark):
    vectors = table(spark, "/root/testdata/sf0.1", "embeddings")
    kept = vectors.where("label < 4")
    assert found(kept) == literal(kept.collect(), 0.98)


def test_bounds_drop_no_pair():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(300, 40))
    rows[100:200] = rows[:100] + rng.normal(size=(100, 40)) * 0.15
    basis, _ = np.linalg.qr(rng.normal(size=(40, 40)))
    stops = dedup.stops_of(40)
    ids = np.arange(300, dtype=np.int64)
    tile = dedup.Tile(ids.tobytes(), np.ones(300, np.int64).tobytes(), rows.tobytes(), basis, stops)
    got = {(a, b) for i, j in dedup.linked(tile, tile, True, 0.98, stops) for a, b in zip(i.tolist(), j.tolist())}
    unit = rows / np.linalg.norm(rows, axis=1, keepdims=True)
    cosine = unit @ unit.T
    assert got == {(a, b) for a in range(300) for b in range(a + 1, 300) if cosine[a, b] >= 0.98} and got
