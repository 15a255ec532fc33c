"""Exact top-k search by inner product.

Every query is compared with every candidate, term at a time: a term (vector position) of the
query scatters its weight times the term's postings into a dense array of scores. Candidates
lie in chunks; each chunk meets the query rows once, in batches, keeps its k best per query,
and a final ranking merges the chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import parallelism

CHUNK_ROWS = 65_536
QUERY_ROWS = 64
EXACT = 2.0**53  # integers up to here are exact in double precision
LONG_MAX = 2**63 - 1


def usable(vector: Column) -> Column:
    """False for null vectors and for those that hold null or non-finite components."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def _matrix(column: pa.Array, width: int | None = None) -> np.ndarray:
    """Vectors as rows of a double matrix; shorter ones lack terms, which weigh nothing."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    width = max(int(lengths.max(initial=0)), width or 0)
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Scores of integral vectors, one row per query, one column per candidate.

    Sums stay exact: in doubles while they cannot leave 2^53, else in Python's integers, and
    what exceeds a long is cut to its bounds.
    """
    width = min(queries.shape[1], candidates.shape[1])
    reach = np.abs(queries).max(initial=0) * np.abs(candidates).max(initial=0) * max(width, 1)
    exact = reach < EXACT
    kind = np.float64 if exact else object
    if not exact:
        queries, candidates = (
            np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)
            for m in (queries, candidates)
        )
    scores = np.zeros((len(queries), len(candidates)), kind)
    for term in range(width):
        weights, postings = queries[:, term], candidates[:, term]
        rows, held = np.flatnonzero(weights), np.flatnonzero(postings)
        if len(rows) == len(weights) and len(held) == len(postings):
            scores += weights[:, None] * postings[None, :]
        elif len(rows) and len(held):
            scores[np.ix_(rows, held)] += weights[rows, None] * postings[None, held]
    if not exact:
        scores = np.clip(scores, -LONG_MAX - 1, LONG_MAX)
    return scores.astype(np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        kept = np.flatnonzero(scores >= least)
    else:
        kept = np.arange(len(scores))
    return kept[np.lexsort((ids[kept], -scores[kept]))[:k]]


def _search(scale: float, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, gathered, held = None, [], None
        for batch in batches:
            data = pa.Table.from_batches([batch])
            chunks = data.column("chunk").to_numpy()
            kinds = data.column("kind").to_numpy()
            cuts = np.flatnonzero((np.diff(chunks) != 0) | (np.diff(kinds) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(chunks)], strict=True):
                part = data.slice(lo, hi - lo)
                ids = part.column("id").to_numpy()
                vectors = np.floor(_matrix(part.column("vector")) * scale)
                if chunk != chunks[lo]:
                    chunk, gathered, held = chunks[lo], [], None
                if kinds[lo] == 0:
                    gathered.append((ids, vectors))
                    continue
                if held is None:
                    width = max((v.shape[1] for _, v in gathered), default=0)
                    found = np.concatenate([i for i, _ in gathered] or [np.empty(0, np.int64)])
                    rows = np.zeros((len(found), width), order="F")
                    at = 0
                    for _, v in gathered:
                        rows[at : at + len(v), : v.shape[1]] = v
                        at += len(v)
                    held, gathered = (found, rows), []
                yield from _answer(ids, vectors, *held)

    def _answer(ids, vectors, others, rows):
        for lo in range(0, len(ids), QUERY_ROWS):
            scores = accumulate(vectors[lo : lo + QUERY_ROWS], rows)
            out = []
            for own, line in zip(ids[lo : lo + QUERY_ROWS], scores, strict=True):
                apart = np.flatnonzero(others != own)
                line, names = (line, others) if len(apart) == len(others) else (line[apart], others[apart])
                top = best(line, names, k)
                out.append((np.full(len(top), own), names[top], line[top]))
            columns = [np.concatenate(c).astype(np.int64) for c in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["query_id", "vec_id", "score"]
            )

    return run


def top_k(
    vectors: DataFrame,
    is_query: Column,
    *,
    k: int = 10,
    scale: float = 1024.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's ``k`` best candidates.

    Queries are the rows where ``is_query`` (over the columns of ``vectors``) holds, candidates
    all rows with another id. Components become floor(scale * x); the score is their inner
    product. Ranks start at 1; ties go to the smaller id.

    Rows whose id or vector is null, or whose vector holds null or non-finite components, take
    no part; an empty vector scores 0 with everything, and missing positions of a shorter one
    count as 0. Repeated rows are candidates each on their own, and each repeated query row
    answers once (its ranks are shared). Other columns are ignored. An empty table gives no
    rows. Scores are exact integers, cut to the range of a long.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(vector_column).cast("array<double>").alias("vector"),
        is_query.alias("query"),
    ).where(F.col("id").isNotNull() & usable(F.col("vector")))
    chunks = max(-(-vectors.count() // chunk_rows), parallelism(spark))
    salt = F.xxhash64(F.monotonically_increasing_id())
    candidates = rows.select(
        F.pmod(salt, F.lit(chunks)).cast("int").alias("chunk"), F.lit(0).alias("kind"), "id", "vector"
    )
    queries = (
        rows.where("query")
        .dropDuplicates(["id"])
        .select(
            F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"),
            F.lit(1).alias("kind"),
            "id",
            "vector",
        )
    )
    partial = (
        candidates.unionByName(queries)
        .repartitionById(chunks, "chunk")
        .sortWithinPartitions("chunk", "kind")
        .mapInArrow(_search(scale, k), "query_id long, vec_id long, score long")
    )
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        partial.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
