"""SimHash fingerprints and near-duplicate groups found with BK-trees.

Two fingerprints within radius r agree on at least two of r + 2 groups of bits, so they meet
in one of the shards keyed by two groups and their values. A shard is indexed by BK-trees:
children are keyed by their Hamming distance to the parent, and a query follows only the edges
within the radius of its own distance. Large shards are cut into pieces, and every piece is
sent to every other one, so no tree and no task grows with a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import Stored, free_name, shuffled, word_bytes
from tidelog.llm.components import connected_components

BITS = 64
SEED = 42
PIECE = 2_048
FRONTIER = 4_000_000


def shingle_hashes(text: str | None, width: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of ``width`` words, lower-cased in A-Z; of all, if fewer."""
    from xxhash import xxh64_intdigest

    joined, starts, ends = word_bytes(text, lower=True)
    if not len(starts):
        return np.empty(0, np.uint64)
    last = max(len(starts) - width, 0)
    spans = zip(starts[: last + 1].tolist(), ends[min(width, len(ends)) - 1 :].tolist(), strict=True)
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, last + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """A bit is 1 if more than half of the hashes have it; 0 without hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(BITS, np.int64)
    for lo in range(0, len(hashes), 4_096):
        part = hashes[lo : lo + 4_096].astype(">u8").view(np.uint8)
        ones += np.unpackbits(part).reshape(-1, BITS).sum(0, dtype=np.int64)
    packed = np.packbits(2 * ones > len(hashes))
    return int(packed.view(">i8")[0])


def with_fingerprint(documents: DataFrame, name: str, *, width: int = 4) -> DataFrame:
    """Adds the SimHash of ``text`` as a (signed) long; texts without words get 0."""
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            found = [fingerprint(shingle_hashes(t.as_py(), width)) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.int64())], names=[*batch.schema.names, name]
            )

    return documents.mapInArrow(run, schema)


def _bit_groups(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of the radius + 2 groups the bits are cut into."""
    bounds = np.linspace(0, BITS, radius + 3).astype(int)
    return [(int(a), int(b - a)) for a, b in zip(bounds, bounds[1:], strict=False)]


class Forest:
    """BK-trees over ``values``, one for each run of equal ``tree``, grown level by level."""

    def __init__(self, tree: np.ndarray, values: np.ndarray):
        self.values = values
        self.trees, self.roots = np.unique(tree, return_index=True)
        parent = self.roots[np.searchsorted(self.trees, tree)]
        waiting = np.setdiff1d(np.arange(len(values)), self.roots)
        keys, children = [], []
        while len(waiting):
            apart = np.bitwise_count(values[waiting] ^ values[parent[waiting]]).astype(np.int64)
            edge = parent[waiting] * (BITS + 1) + apart
            found, first, at = np.unique(edge, return_index=True, return_inverse=True)
            child = waiting[first]
            keys.append(found)
            children.append(child)
            parent[waiting] = child[at]
            waiting = waiting[np.isin(np.arange(len(waiting)), first, invert=True)]
        keys = np.concatenate(keys or [np.empty(0, np.int64)])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.children = np.concatenate(children or [np.empty(0, np.int64)])[order]

    def within(self, tree: np.ndarray, values: np.ndarray, radius: int):
        """Pairs (query, member) of the query's tree that differ in ``radius`` bits at most."""
        at = np.searchsorted(self.trees, tree)
        known = np.flatnonzero((at < len(self.trees)) & (self.trees[np.minimum(at, len(self.trees) - 1)] == tree)) if len(self.trees) else np.empty(0, np.int64)
        query, node = known, self.roots[at[known]]
        while len(query):
            apart = np.bitwise_count(values[query] ^ self.values[node]).astype(np.int64)
            near = apart <= radius
            yield query[near], node[near]
            base = node * (BITS + 1)
            lo = np.searchsorted(self.keys, base + np.maximum(apart - radius, 0))
            hi = np.searchsorted(self.keys, base + np.minimum(apart + radius, BITS), "right")
            many = hi - lo
            query = np.repeat(query, many)
            ends = np.cumsum(many)
            node = self.children[np.arange(len(query)) - np.repeat(ends - many, many) + np.repeat(lo, many)]


def _labels(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        following = label.copy()
        np.minimum.at(following, label[a], low)
        np.minimum.at(following, label[b], low)
        following = following[following]
        if np.array_equal(following, label):
            return label
        label = following


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Rows of whole cells, as many together as a batch holds."""
    rest = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if not len(columns[0]):
            continue
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
        last = np.ones(len(columns[0]), bool)
        for c in columns[:4]:
            last &= c == c[-1]
        cut = len(last) - int(np.argmin(last[::-1])) if not last.all() else 0
        rest = [c[cut:] for c in columns]
        if cut:
            yield [c[:cut] for c in columns]
    if rest is not None:
        yield rest


def _linked(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _whole_cells(batches):
            *cell, piece, value = columns
            change = np.zeros(len(value), bool)
            for c in cell:
                change[1:] |= c[1:] != c[:-1]
            group = np.cumsum(change)
            bits = value.view(np.uint64)
            planted, asking = np.flatnonzero(piece == cell[2]), np.flatnonzero(piece == cell[3])
            forest = Forest(group[planted], bits[planted])
            one, two = [], []
            reach = np.cumsum(np.bincount(group)[group[asking]])
            for part in np.split(asking, np.searchsorted(reach, np.arange(FRONTIER, reach[-1], FRONTIER))):
                for query, member in forest.within(group[part], bits[part], radius):
                    a, b = part[query], planted[member]
                    one.append(a[a != b])
                    two.append(b[a != b])
            label = _labels(len(value), np.concatenate(one), np.concatenate(two))
            moved = np.flatnonzero(label != np.arange(len(value)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[moved]), pa.array(value[label[moved]])], names=["u", "v"]
            )

    return run


def cells_within(fingerprints: DataFrame, radius: int, piece: int = PIECE) -> DataFrame:
    """Rows (shard, key, a, b, piece, fp, ...), whole cells together: fingerprints that differ
    in ``radius`` bits at most meet in a cell.

    ``fingerprints`` has distinct longs in ``fp``; its other columns come along.
    """
    bits = _bit_groups(radius)
    fields = [F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1)) for s, w in bits]
    shards = [
        F.struct(F.lit(n).alias("shard"), (fields[i] * (1 << bits[j][1]) + fields[j]).alias("key"))
        for n, (i, j) in enumerate(combinations(range(len(bits)), 2))
    ]
    held = fingerprints.columns
    spread = fingerprints.select(*held, F.explode(F.array(*shards)).alias("s")).select("s.shard", "s.key", *held)
    sizes = spread.groupBy("shard", "key").count().where("count > 1")
    pieces = F.ceil(F.col("count") / piece).cast("int")
    cells = (
        spread.join(shuffled(sizes), ["shard", "key"])
        .withColumn("pieces", pieces)
        .withColumn("piece", F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)))
        .select("shard", "key", F.least("piece", "other").alias("a"), F.greatest("piece", "other").alias("b"), "piece", *held)
    )
    at = ["shard", "key", "a", "b"]
    return cells.repartition(*at).sortWithinPartitions(*at)


def links_within(fingerprints: DataFrame, radius: int, *, piece: int = PIECE) -> DataFrame:
    """Links (u, v) that connect exactly what distances up to ``radius`` connect.

    ``fingerprints`` has distinct longs in ``fp``. Within a cell, links that add no connection
    are left out.
    """
    return cells_within(fingerprints, radius, piece).mapInArrow(_linked(radius), "u long, v long").distinct()


def near_duplicates(documents: DataFrame, *, width: int = 4, radius: int = 4, piece: int = PIECE) -> DataFrame:
    """Adds ``fingerprint`` (long) and ``component_id`` to every document.

    Documents whose fingerprints differ in ``radius`` bits at most are linked, and
    ``component_id`` is the smallest doc_id reachable, its own included. Null, empty and blank
    texts have fingerprint 0 and are linked like any other. A null doc_id is never the
    smallest, unless a component has no other. Repeated rows share a component; other columns
    pass through, columns named like the added ones are replaced; an empty table stays empty.
    Whole texts are read, of any length.
    """
    kept = documents.select(*[c for c in documents.columns if c.lower() not in ("fingerprint", "component_id")])
    marked = with_fingerprint(kept, "fingerprint", width=width)
    known = Stored(marked.groupBy("fingerprint").agg(F.min("doc_id").alias("least")), "fingerprints")
    nodes = known.df.select(F.col("fingerprint").alias("fp"))
    links = Stored(links_within(nodes, radius, piece=piece), "links")
    parts = connected_components(links.df)
    named = known.df.join(parts, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("component", "fingerprint").alias("component")
    )
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    own = free_name(marked, "_fp")
    classes = Stored(named.join(least, "component").select(F.col("fingerprint").alias(own), "component_id"), "classes")
    return marked.join(classes.df, F.col("fingerprint") == F.col(own)).drop(own)


def one_of_each(documents: DataFrame, **how) -> DataFrame:
    """The documents with the smallest doc_id of their group, with their own columns.

    Of repeated rows of that doc_id one stays. A group without a doc_id keeps one row.
    """
    marked = near_duplicates(documents, **how)
    first = marked.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    return first.dropDuplicates(["doc_id", "component_id"]).select(*documents.columns)
