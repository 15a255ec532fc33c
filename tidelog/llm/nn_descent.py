"""Approximate nearest neighbours by cosine: NN-descent builds a graph, a greedy search uses it.

Every vector starts with neighbours picked by random projections and by chance. In each round
a vector's neighbours, in both directions, are brought together, since neighbours of neighbours
are likely to be neighbours: all pairs among the few that meet at a vector are measured, and
each vector keeps those nearer than what it has. Joins and windows do the exchange; a meeting has a bounded number
of members, for the number of neighbours and of reverse neighbours kept is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import Stored
from tidelog.llm.topk import usable

DEGREE = 24
ROUNDS = 5
TREES = 6  # ways the first neighbours are drawn together
CUTS = 4  # planes by which the places of all trees are cut at a time
BEAM = 128
SEED = 11
SETTLED = 0.002  # share of changed edges below which no further round is made


def _unit(column) -> np.ndarray:
    """Unit vectors as rows of a matrix; missing positions of shorter vectors count as 0."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(lengths), int(lengths.max(initial=0))))
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    largest = np.abs(out).max(1, keepdims=True, initial=0)
    out /= np.where(largest > 0, largest, 1)
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def cosines(one: pa.Array, other: pa.Array) -> np.ndarray:
    """Cosines of pairs of original vectors, in double precision."""
    a, b = _unit(one), _unit(other)
    width = min(a.shape[1], b.shape[1])
    return np.einsum("ij,ij->i", a[:, :width], b[:, :width])


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole runs of equal keys, as many together as a batch holds."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
        change = np.flatnonzero(keys != keys[-1])
        cut = int(change[-1]) + 1 if len(change) else 0
        if cut:
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest = [batch.slice(cut)]
        elif rest and rest[-1].column(rest[-1].schema.get_field_index(key))[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(rest)
            rest = [batch]
        else:
            rest.append(batch)
    if rest:
        yield pa.Table.from_batches(rest)


def centre(vectors: DataFrame, width: int) -> np.ndarray:
    """The mean of the unit vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(width), 0
        for batch in batches:
            units = _unit(batch.column("vector"))
            total[: units.shape[1]] += units.sum(0)
            count += len(units)
        yield pa.RecordBatch.from_arrays([pa.array([total]), pa.array([count])], names=["total", "count"])

    sums = vectors.select("vector").mapInArrow(run, "total array<double>, count long")
    by = sums.select(F.posexplode("total").alias("at", "x"), "count").groupBy("at").agg(F.sum("x") / F.sum("count"))
    out = np.zeros(width)
    for at, mean in by.where("at is not null").collect():
        out[at] = mean or 0.0
    return out


def coded(vectors: DataFrame, width: int) -> DataFrame:
    """Rows (id, code): unit vectors less their mean, in single precision. They choose the edges of
    the graph; answers are measured on the original vectors.

    Without the mean, what tells vectors apart that all point one way keeps its digits.
    """
    mean = centre(vectors, width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _unit(batch.column("vector"))
            codes = np.zeros((len(units), width))
            codes[:, : units.shape[1]] = units
            codes = (codes - mean).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array([c.tobytes() for c in codes], pa.binary())], names=["id", "code"]
            )

    return vectors.select("id", "vector").mapInArrow(run, "id long, code binary")


def _decoded(codes: list[bytes]) -> np.ndarray:
    """Vectors, as rows, from their codes."""
    return np.frombuffer(b"".join(codes), np.float32).reshape(len(codes), -1).astype(np.float64)


def _meet(most: int):
    """Of the vectors that meet at a place, each gets the ``most`` nearest of the others, if they
    are nearer than its bar, the farthest neighbour it has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "place"):
            places, ids, bars = (table.column(c).to_numpy() for c in ("place", "id", "bar"))
            vectors = _decoded(table.column("code").to_pylist())
            cuts = np.flatnonzero(np.diff(places)) + 1
            out = []
            for lo, hi in zip([0, *cuts], [*cuts, len(places)], strict=True):
                n = hi - lo
                if n < 2:
                    continue
                # minus the squared distance, which orders unit vectors as their cosine does, from
                # one of them: vectors that lie close together keep their differences
                own = vectors[lo:hi] - vectors[lo]
                square = np.einsum("ij,ij->i", own, own)
                near = 2 * (own @ own.T) - square[:, None] - square
                np.fill_diagonal(near, -np.inf)
                k = min(most, n - 1)
                best = np.argpartition(-near, k - 1, axis=1)[:, :k]
                own = np.repeat(np.arange(n), k)
                other = best.ravel()
                score = near[own, other]
                nearer = score > bars[lo:hi][own]
                out.append((ids[lo:hi][own[nearer]], ids[lo:hi][other[nearer]], score[nearer]))
            if out:
                a, b, s = (np.concatenate(c) for c in zip(*out, strict=True))
                apart = a != b
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a[apart]), pa.array(b[apart]), pa.array(s[apart].astype(np.float32))], names=["a", "b", "near"]
                )

    return run


def _nearest(edges: DataFrame, degree: int) -> DataFrame:
    """The ``degree`` nearest of each vector's neighbours."""
    each = edges.groupBy("a", "b").agg(F.max("near").alias("near"))
    order = Window.partitionBy("a").orderBy(F.col("near").desc(), "b")
    return each.withColumn("n", F.row_number().over(order)).where(F.col("n") <= degree).drop("n")


def _reverse(edges: DataFrame, order: Column, most: int) -> DataFrame:
    """Of the edges that lead to a vector, the first ``most`` in the order given.

    A first choice among salted parts leaves few rows of even a hub for the second.
    """
    salted = edges.withColumn("_salt", F.pmod(F.xxhash64("a"), F.lit(64))).withColumn("_by", order)
    first = salted.withColumn("_n", F.row_number().over(Window.partitionBy("b", "_salt").orderBy("_by"))).where(F.col("_n") <= most)
    second = first.withColumn("_n", F.row_number().over(Window.partitionBy("b").orderBy("_by"))).where(F.col("_n") <= most)
    return second.drop("_salt", "_by", "_n")


def _by_projection(codes: DataFrame, count: int, seed: int, leaf: int, trees: int) -> DataFrame:
    """For every tree, places of about ``leaf`` vectors that lie on the same sides of random planes.

    Planes go through the medians of the place they cut, so vectors crowded together are told
    apart as others are. ``CUTS`` planes cut all places of all trees at a time.
    """
    depth = min(max(int(np.ceil(np.log2(max(count / leaf, 1)))), 1), 48)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = _decoded(batch.column("code").to_pylist())
            planes = np.random.default_rng(seed).standard_normal((trees, depth, vectors.shape[1]))
            for tree in range(trees):
                on = pa.array(list(vectors @ planes[tree].T), pa.list_(pa.float64()))
                ids = batch.column("id")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), tree, np.int64)), ids, on], names=["place", "id", "on"])

    places = codes.mapInArrow(run, "place long, id long, on array<double>")
    for first in range(0, depth, CUTS):
        axes = range(first, min(first + CUTS, depth))
        known = Stored(places, "places").df
        middles = known.groupBy("place").agg(*[F.percentile_approx(F.col("on")[n], 0.5, 1000).alias(f"m{n}") for n in axes])
        sides = [(F.col("on")[n] > F.col(f"m{n}")) for n in axes]
        places = known.join(middles, "place").select(F.xxhash64("place", *sides).alias("place"), "id", "on")
    places = Stored(places.select("place", "id"), "places").df
    sizes = places.groupBy("place").count()
    # places that stay crowded are cut into pieces by chance
    cut = F.pmod(F.xxhash64("id", F.lit(seed)), F.ceil(F.col("count") / (3 * leaf)))
    return places.join(sizes, "place").select(F.xxhash64(F.lit(seed), "place", cut).alias("place"), "id")


def build(codes: DataFrame, *, degree: int = DEGREE, rounds: int = ROUNDS, seed: int = SEED) -> DataFrame:
    """The neighbour graph: rows (a, b, near), ``degree`` per vector (id, code) at most."""
    far = F.lit(float("-inf"))
    count = codes.count()

    def meeting(places: DataFrame, members: DataFrame, most: int) -> DataFrame:
        rows = places.join(members, "id").select("place", "id", "bar", "code")
        return rows.repartition("place").sortWithinPartitions("place").mapInArrow(_meet(most), "a long, b long, near float")

    starts = _by_projection(codes, count, seed, 3 * degree, TREES)
    graph = Stored(_nearest(meeting(starts, codes.withColumn("bar", far), degree), degree), "graph")
    for turn in range(rounds):
        edges = graph.df
        reverse = _reverse(edges, F.xxhash64("a", "b", F.lit(seed + turn)), degree)
        places = (
            edges.select(F.col("a").alias("place"), F.col("b").alias("id"))
            .unionByName(reverse.select(F.col("b").alias("place"), F.col("a").alias("id")))
            .unionByName(codes.select(F.col("id").alias("place"), "id"))
            .distinct()
        )
        full = F.when(F.count(F.lit(1)) >= degree, F.min("near"))
        bars = edges.groupBy(F.col("a").alias("id")).agg(F.coalesce(full, far).cast("double").alias("bar"))
        members = codes.join(bars, "id", "left").withColumn("bar", F.coalesce("bar", far))
        following = Stored(_nearest(meeting(places, members, degree // 3).unionByName(edges), degree), "graph")
        changed = following.df.join(edges, ["a", "b"], "left_anti").count()
        graph.delete()
        graph = following
        if changed <= SETTLED * degree * count:
            break
    return graph.df


def _measure(pairs: DataFrame, vectors: DataFrame) -> DataFrame:
    """Adds ``score`` to rows (query, id): the cosine of the two original vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = cosines(batch.column("own"), batch.column("vector"))
            yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("id"), pa.array(score)], names=["query", "id", "score"])

    own = vectors.select(F.col("id").alias("query"), F.col("vector").alias("own"))
    rows = pairs.join(own, "query").join(vectors, "id").select("query", "id", "own", "vector")
    return rows.mapInArrow(run, "query long, id long, score double")


def search(vectors: DataFrame, graph: DataFrame, queries: DataFrame, *, k: int, beam: int = BEAM) -> DataFrame:
    """Rows (query, id, score): the nearest found for each query (column query, ids of vectors).

    The search starts at the query's own neighbours, in both directions, goes on to the neighbours of the ``beam``
    nearest found that it has not been at, and ends when no query finds anything nearer.
    """
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "id")
    back = _reverse(graph, -F.col("near"), DEGREE).select(F.col("b").alias("a"), F.col("a").alias("b"))
    links = Stored(graph.select("a", "b").unionByName(back).distinct(), "graph").df
    first = links.join(queries, F.col("a") == F.col("query")).select("query", F.col("b").alias("id"))
    found = Stored(_measure(first, vectors).withColumn("been", F.lit(False)), "found")
    while True:
        best = found.df.withColumn("n", F.row_number().over(order))
        front = best.where((F.col("n") <= beam) & ~F.col("been"))
        steps = front.select("query", F.col("id").alias("a")).join(links, "a").select("query", F.col("b").alias("id"))
        fresh = steps.distinct().where("query <> id").join(found.df.select("query", "id"), ["query", "id"], "left_anti")
        been = best.withColumn("been", F.col("been") | (F.col("n") <= beam)).drop("n")
        grown = been.unionByName(_measure(fresh, vectors).withColumn("been", F.lit(False)))
        ranked = grown.withColumn("n", F.row_number().over(order)).where((F.col("n") <= 4 * beam) | F.col("been"))
        following = Stored(ranked.withColumn("open", (F.col("n") <= beam) & ~F.col("been")), "found")
        more = not following.df.where("open").isEmpty()
        found.delete()
        found = Stored(following.df.drop("n", "open"), "found")
        following.delete()
        if not more:
            break
    return found.df.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k).select("query", "id", "score")


def nearest(
    table: DataFrame,
    is_query: Column,
    *,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    degree: int = DEGREE,
    rounds: int = ROUNDS,
    beam: int = BEAM,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` nearest found of each query.

    Queries are the rows where ``is_query`` holds, candidates all rows with another id. The
    score is the cosine of the original vectors in double precision; ties go to the smaller id.
    All vectors are in the graph. Rows whose id or vector is null, and vectors that are zero or
    hold null or non-finite components, take no part; missing positions of shorter vectors count
    as 0. Of rows with the same id one takes part, the one with the least vector. A query finds
    every candidate if there are no more than the graph's degree. Other columns are ignored; an
    empty table gives no rows.
    """
    ids = table.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("vector"), is_query.alias("query")
    ).where(F.col("id").isNotNull() & usable(F.col("vector")) & F.exists(F.col("vector"), lambda x: x != 0))
    single = ids.groupBy("id").agg(F.min(F.struct("vector", "query")).alias("v")).select("id", "v.vector", "v.query")
    whole = Stored(single, "whole").df
    # Equal vectors are one in the graph, the one with the least id; of the others the first that
    # can be answers stand by it.
    place = Window.partitionBy("vector").orderBy("id")
    first = whole.groupBy("vector").agg(F.min("id").alias("first"), F.max(F.col("query").cast("int")).alias("query"))
    firsts = first.select(F.col("first").alias("id"), "vector", (F.coalesce("query", F.lit(0)) == 1).alias("query"))
    vectors = Stored(firsts, "vectors").df
    copies = whole.withColumn("n", F.row_number().over(place)).where(F.col("n") <= k + 1).select("vector", F.col("id").alias("copy"))
    copies = Stored(copies.join(first.select("vector", "first"), "vector").select(F.col("first").alias("id"), "copy"), "copies").df
    asking = whole.where("query").select("vector", F.col("id").alias("query_id"))
    asking = Stored(asking.join(first.select("vector", "first"), "vector").select(F.col("first").alias("query"), "query_id"), "asking").df
    width = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    codes = Stored(coded(vectors, width), "codes").df
    graph = build(codes, degree=degree, rounds=rounds)
    queries = vectors.where("query").select(F.col("id").alias("query"))
    pairs = vectors.select("id", "vector")
    others = search(pairs, graph, queries, k=k, beam=beam)
    itself = _measure(queries.withColumn("id", F.col("query")), pairs)
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id")
    each = others.unionByName(itself).join(copies, "id").select("query", F.col("copy").alias("vec_id"), "score")
    answers = each.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")
    found = asking.join(answers, "query").where("query_id <> vec_id").drop("query")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
