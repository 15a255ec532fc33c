"""Near-duplicate vectors by a PCA-ordered, tiled comparison.

Vectors are turned into the basis of their principal components, ordered by the leading ones
within their label and cut into tiles. Two tiles meet only if the boxes around them come close
enough. Where they meet, products over the leading components are accumulated first; what the
rest can add is at most the product of the two suffix norms (Cauchy-Schwarz), and a pair is
dropped as soon as that cannot reach the threshold. The few pairs left are decided by the
cosine of the vectors themselves, so the basis changes the work and never the result.

Equal vectors of a label are compared once. A meeting of two tiles reports how many vectors each
of its vectors is linked to and a spanning forest of the links, never the links one by one, so
a group of n near copies makes about n rows for each meeting it takes part in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Stored, parallelism
from tidelog.llm.components import connected_components
from tidelog.llm.topk import usable
from tidelog.plans.spread import join_spread

TILE = 1024
# Rows the basis is fitted on; it orders the comparison and decides nothing.
FIT_ROWS = 20_000
CELLS = 4
BOX = 8
LEADING = 8
SALTS = 64
# Room for rounding in bounds; links are decided without it.
SLACK = 1e-9
_SLICE = 256
_PAIRS = 65_536


def scaled(lists: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows, each times a power of two that brings its largest component near 1.

    Cosines do not change, and no square leaves the range of doubles. Missing positions are 0.
    """
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    _, exponent = np.frexp(np.abs(out).max(axis=1, initial=0))
    return np.ldexp(out, -exponent[:, None])


def unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _moments(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                rows = unit(scaled(batch.column(0).slice(at, TILE), width))
                total += rows.T @ rows
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["sums"])

    return run


def principal(classes: DataFrame, count: int, width: int) -> np.ndarray:
    """An orthonormal basis as columns, the direction with most weight first."""
    step = -(-count // FIT_ROWS) or 1
    sample = classes.where(F.pmod(F.xxhash64("number"), F.lit(step)) == 0)
    sums = sample.select("vector").repartition(1).mapInArrow(_moments(width), "sums binary").collect()
    moments = sum((np.frombuffer(r.sums).reshape(width, width) for r in sums), np.zeros((width, width)))
    _, vectors = np.linalg.eigh(moments)
    return np.ascontiguousarray(vectors[:, ::-1])


def _place(basis: np.ndarray, reach: float, cells: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                rows = unit(scaled(part.column(3), len(basis))) @ basis[:, :cells]
                at_cells = np.floor(rows / reach).astype(np.int32)
                added = [pa.array(np.ascontiguousarray(c)) for c in at_cells.T]
                names = [*part.schema.names, *[f"c{i}" for i in range(cells)]]
                yield pa.RecordBatch.from_arrays([*part.columns, *added], names=names)

    return run


def _cut(basis: np.ndarray, tile: int):
    """Consecutive rows of a label as packed tiles with the box around their leading parts."""
    width, depth = len(basis), min(BOX, len(basis))

    def packed(label, parts: list[pa.RecordBatch]) -> dict:
        table = pa.Table.from_batches(parts)
        rows = scaled(table.column("vector"), width)
        lead = unit(rows) @ basis[:, :depth]
        narrow = rows.astype(np.float32)
        values = narrow if np.array_equal(narrow, rows) else rows
        return {
            "label": label,
            "low": lead.min(axis=0).tolist(),
            "high": lead.max(axis=0).tolist(),
            "numbers": table.column("number").to_numpy().tobytes(),
            "copies": table.column("n").to_numpy().tobytes(),
            "vectors": values.tobytes(),
        }

    schema = pa.schema(
        [
            ("label", pa.string()), ("low", pa.list_(pa.float64())), ("high", pa.list_(pa.float64())),
            ("numbers", pa.binary()), ("copies", pa.binary()), ("vectors", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        label, held, count = None, [], 0
        for batch in batches:
            labels = batch.column("label").to_pylist()
            at = 0
            while at < len(labels):
                if count and (labels[at] != label or count == tile):
                    yield pa.RecordBatch.from_pylist([packed(label, held)], schema)
                    held, count = [], 0
                label, end = labels[at], at + 1
                while end < len(labels) and labels[end] == label and count + end - at < tile:
                    end += 1
                held.append(batch.slice(at, end - at))
                count += end - at
                at = end
        if count:
            yield pa.RecordBatch.from_pylist([packed(label, held)], schema)

    return run


class Tile:
    def __init__(self, numbers: bytes, copies: bytes, vectors: bytes, basis: np.ndarray, stops: list[int]):
        self.numbers = np.frombuffer(numbers, np.int64)
        self.copies = np.frombuffer(copies, np.int64)
        count = len(self.numbers)
        kind = np.float32 if len(vectors) == count * len(basis) * 4 else np.float64
        self.rows = np.frombuffer(vectors, kind).reshape(count, -1).astype(np.float64)
        self.norms = np.linalg.norm(self.rows, axis=1)
        self.turned = unit(self.rows) @ basis
        squares = np.cumsum(self.turned[:, ::-1] ** 2, axis=1)[:, ::-1]
        # The norm of what is left after each stop; nothing is left after the last.
        left = np.concatenate([squares, np.zeros((count, 1))], axis=1)
        self.left = np.sqrt(left[:, stops])


def stops_of(width: int) -> list[int]:
    """Where the accumulation pauses: after the leading part, then at twice as much each time."""
    stops, at = [], LEADING
    while at < width:
        stops.append(at)
        at *= 2
    return [*stops, width]


def linked(a: Tile, b: Tile, same: bool, threshold: float, stops: list[int]) -> Iterator[tuple]:
    """Positions (i, j) of linked pairs, some at a time; i < j within one tile."""
    least = threshold - SLACK
    for lo in range(0, len(a.rows), _SLICE):
        hi = min(lo + _SLICE, len(a.rows))
        first = stops[0]
        begun = a.turned[lo:hi, :first] @ b.turned[:, :first].T
        open_ = begun + a.left[lo:hi, :1] * b.left[:, 0] >= least
        if same:
            open_ &= np.arange(len(b.rows)) > np.arange(lo, hi)[:, None]
        all_i, all_j = np.nonzero(open_)
        sums = begun[all_i, all_j]
        all_i += lo
        for at in range(0, len(all_i), _PAIRS):
            i, j, so_far = (x[at : at + _PAIRS] for x in (all_i, all_j, sums))
            for k in range(1, len(stops)):
                part = slice(stops[k - 1], stops[k])
                so_far = so_far + np.einsum("ij,ij->i", a.turned[i, part], b.turned[j, part])
                alive = so_far + a.left[i, k] * b.left[j, k] >= least
                i, j, so_far = i[alive], j[alive], so_far[alive]
            cosine = np.einsum("ij,ij->i", a.rows[i], b.rows[j]) / (a.norms[i] * b.norms[j])
            yes = cosine >= threshold
            if yes.any():
                yield i[yes], j[yes]


def join_groups(groups: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """``groups`` (each node's least member known) after joining the nodes i with the nodes j."""
    while True:
        u, v = groups[i], groups[j]
        apart = u != v
        if not apart.any():
            return groups
        i, j, u, v = i[apart], j[apart], u[apart], v[apart]
        np.minimum.at(groups, np.maximum(u, v), np.minimum(u, v))
        while not np.array_equal(following := groups[groups], groups):
            groups = following


def _compare(basis: np.ndarray, threshold: float):
    stops = stops_of(len(basis))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                cells = [batch.column(c)[row].as_py() for c in range(8)]
                same = cells[0] == cells[1]
                a = Tile(*cells[2:5], basis, stops)
                b = a if same else Tile(*cells[5:8], basis, stops)
                shift = 0 if same else len(a.rows)
                numbers = a.numbers if same else np.concatenate((a.numbers, b.numbers))
                copies = a.copies if same else np.concatenate((a.copies, b.copies))
                links, groups = np.zeros(len(numbers), np.int64), np.arange(len(numbers))
                for i, j in linked(a, b, same, threshold, stops):
                    np.add.at(links, i, copies[j + shift])
                    np.add.at(links, j + shift, copies[i])
                    groups = join_groups(groups, i, j + shift)
                met = np.flatnonzero(links)
                if len(met):
                    columns = [numbers[met], links[met], numbers[groups[met]]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in columns], names=["number", "links", "hub"]
                    )

    return run


def _meetings(tiles: DataFrame, reach: float) -> DataFrame:
    """Pairs (a, b), a <= b, of tiles of a label whose boxes come within ``reach``."""

    def cell(bound):
        return F.floor(bound[0] / reach)

    def side(name: str, room: int) -> DataFrame:
        spread = F.explode(F.sequence(cell(F.col("low")) - room, cell(F.col("high")) + room)).alias("cell")
        return tiles.select("label", spread, *[F.col(c).alias(f"{c}_{name}") for c in ("tile", "low", "high")])

    met = side("a", 0).join(side("b", 1), ["label", "cell"]).where("tile_a <= tile_b")
    gaps = F.zip_with(
        F.arrays_zip("low_a", "high_a"), F.arrays_zip("low_b", "high_b"),
        lambda x, y: F.greatest(F.lit(0.0), x["low_a"] - y["high_b"], y["low_b"] - x["high_a"]),
    )
    apart = F.aggregate(gaps, F.lit(0.0), lambda total, gap: total + gap * gap)
    return met.where(apart <= reach * reach).select("tile_a", "tile_b").distinct()


def near_copies(
    vectors: DataFrame,
    *,
    threshold: float = 0.98,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    tile: int = TILE,
) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept), one per row of ``vectors``.

    Two rows are linked if their labels are equal and their cosine, in double precision, is
    ``threshold`` (below 1) or more. ``n_links`` counts the other rows linked directly,
    ``component_id`` is the smallest id reachable by links, itself included, and ``kept`` marks
    the rows whose id that is.

    A null label, id or vector, a vector of zeros, an empty one and one with null or non-finite
    components link with nothing: no links, the own id as component (null for a null id, which
    is not kept). Missing positions of a shorter vector count as 0. Repeated rows are rows each:
    they link with each other. Other columns, whatever their names, are ignored. An empty table
    gives no rows.
    """
    if not -1 < threshold < 1:
        raise ValueError("threshold must lie between -1 and 1")
    spark = vectors.sparkSession
    vector = F.col(vector_column).cast("array<double>")
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("string").alias("label"),
        vector.alias("vector"),
    )
    able = usable(F.col("vector")) & F.exists("vector", lambda x: x != 0)
    able = able & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    keys = ["label", "a", "b"]
    rows = rows.select(
        "vec_id",
        F.when(able, F.col("label")).alias("label"),
        F.xxhash64(F.lit(1), "vector").alias("a"),
        F.xxhash64(F.lit(2), "vector").alias("b"),
        F.pmod(F.xxhash64("vec_id"), F.lit(SALTS)).cast("int").alias("salt"),
        "vector",
    )
    # Equal vectors are counted in salted parts first: most rows may be copies of one vector.
    counted = [F.min("least").alias("least"), F.sum("n").alias("n"), F.first("vector").alias("vector")]
    usable_rows = rows.where("label is not null").withColumnRenamed("vec_id", "least").withColumn("n", F.lit(1))
    parts = Stored(usable_rows.groupBy(*keys, "salt").agg(*counted), "parts")
    classes = Stored(
        parts.df.groupBy(*keys).agg(*counted).withColumn("number", F.monotonically_increasing_id()), "classes"
    )

    count, width = classes.df.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    width = max(width or 0, 1)
    basis = principal(classes.df, count, width)
    reach = float(np.sqrt(2 - 2 * threshold) + SLACK)
    cells = min(CELLS, width)
    order = [f"c{i}" for i in range(cells)]
    placed = classes.df.select("number", "n", "label", "vector").mapInArrow(
        _place(basis, reach, cells),
        "number long, n long, label string, vector array<double>, " + ", ".join(f"{c} int" for c in order),
    )
    ways = max(parallelism(spark), -(-count // (64 * tile)))
    cut = (
        placed.repartitionByRange(ways, "label", *order, "number")
        .sortWithinPartitions("label", *order, "number")
        .drop(*order)
        .mapInArrow(
            _cut(basis, tile),
            "label string, low array<double>, high array<double>, numbers binary, copies binary, vectors binary",
        )
    )
    tiles = Stored(cut.withColumn("tile", F.monotonically_increasing_id()), "tiles")
    met = Stored(_meetings(tiles.df.select("tile", "label", "low", "high"), reach), "meetings")
    packed = ["numbers", "copies", "vectors"]
    shipped = met.df
    for name in ("a", "b"):
        side = tiles.df.select(F.col("tile").alias(f"tile_{name}"), *[F.col(c).alias(f"{c}_{name}") for c in packed])
        shipped = shipped.join(side, f"tile_{name}")
    shipped = shipped.select("tile_a", "tile_b", *[f"{c}_{name}" for name in ("a", "b") for c in packed])
    found = Stored(shipped.mapInArrow(_compare(basis, threshold), "number long, links long, hub long"), "links")

    links = found.df.groupBy("number").agg(F.sum("links").alias("links"))
    groups = connected_components(found.df.select(F.col("number").alias("u"), F.col("hub").alias("v")))
    member = classes.df.select(F.col("number").alias("node"), "least")
    grouped = groups.join(member, "node")
    roots = grouped.groupBy("component").agg(F.min("least").alias("root"))
    reached = join_spread(grouped, roots, ["component"], ["node"]).select(F.col("node").alias("number"), "root")
    told = classes.df.select(*keys, "number", "least", F.col("n").alias("copies"))
    told = told.join(links, "number", "left").join(reached, "number", "left")
    told = told.select(
        *keys,
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        F.coalesce("root", "least").alias("component"),
    )
    by_part = parts.df.select(*keys, "salt").join(told, keys)
    out = rows.drop("vector").join(by_part, [*keys, "salt"], "left")
    component = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
