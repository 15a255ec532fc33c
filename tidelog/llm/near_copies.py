"""Near copies of documents: SimHash finds candidates, the shingles of their texts decide.

At a similarity of 0.8 two fingerprints differ in about ten bits, and unrelated ones in 32, so
a radius that finds near copies also finds a few pairs that are none. Candidates are therefore
compared by the Jaccard similarity of their word shingles before groups are formed. A fingerprint
is first paired with its closest neighbours only. What these links do not connect is paired
further, with more neighbours in every round, until no candidate of another group is left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Stored, free_name, shuffled
from tidelog.llm.components import connected_components
from tidelog.llm.simhash import FRONTIER, PIECE, Forest, _whole_cells, cells_within, with_fingerprint

WIDTH = 5
RADIUS = 8
SIMILARITY = 0.8
PER_ROUND = 8  # candidates a round, times as many in the next
PARTNERS = 256  # candidates compared with one copy of a text's shingles

_FAR = np.iinfo(np.int64).max
_PLACE = np.int64(1 << 40)


def _close(columns: list[np.ndarray], radius: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places (low, high) of pairs within the radius, by value, and their distances."""
    *cell, piece, value = columns[:6]
    change = np.zeros(len(value), bool)
    for c in cell:
        change[1:] |= c[1:] != c[:-1]
    group = np.cumsum(change)
    bits = value.view(np.uint64)
    planted, asking = np.flatnonzero(piece == cell[2]), np.flatnonzero(piece == cell[3])
    if not len(asking):
        return
    forest = Forest(group[planted], bits[planted])
    reach = np.cumsum(np.bincount(group)[group[asking]])
    for part in np.split(asking, np.searchsorted(reach, np.arange(FRONTIER, reach[-1], FRONTIER))):
        for query, member in forest.within(group[part], bits[part], radius):
            a, b = part[query], planted[member]
            a, b = a[a != b], b[a != b]
            apart = np.bitwise_count(bits[a] ^ bits[b]).astype(np.int64)
            yield np.where(value[a] < value[b], a, b), np.where(value[a] < value[b], b, a), apart


def _closest(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of every cell, each fingerprint with its closest neighbour, and with its closest
        smaller one, which connects what the cell connects."""
        for columns in _whole_cells(batches):
            value = columns[5]
            # (distance, place) in one number, so that the least is the closest
            nearest, smaller = np.full(len(value), _FAR), np.full(len(value), _FAR)
            for low, high, apart in _close(columns, radius):
                np.minimum.at(nearest, low, apart * _PLACE + high)
                np.minimum.at(nearest, high, apart * _PLACE + low)
                np.minimum.at(smaller, high, apart * _PLACE + low)
            pairs = []
            for found in (nearest, smaller):
                at = np.flatnonzero(found != _FAR)
                pairs.append((value[at], value[found[at] % _PLACE]))
            one, two = (np.concatenate(x) for x in zip(*pairs, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.maximum(one, two)), pa.array(np.minimum(one, two))], names=["u", "v"]
            )

    return run


def _crossing(radius: int, most: int):
    def first(low: np.ndarray, high: np.ndarray, apart: np.ndarray):
        """The ``most`` closest for every ``high``, and which of these have more."""
        order = np.lexsort((low, apart, high))
        low, high, apart = low[order], high[order], apart[order]
        same = np.concatenate(([True], (low[1:] != low[:-1]) | (high[1:] != high[:-1])))[: len(low)]
        low, high, apart = low[same], high[same], apart[same]
        rank = np.arange(len(high)) - np.searchsorted(high, high)
        return low[rank < most], high[rank < most], apart[rank < most], high[rank == most]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of every cell, each fingerprint with its closest smaller ones of other groups, and
        whether it has further ones."""
        for columns in _whole_cells(batches):
            value, label = columns[5], columns[6]
            none = np.empty(0, np.int64)
            held, cut, waiting, size = (none, none, none), none, [], 0

            def settle():
                low, high, apart, further = first(*(np.concatenate(x) for x in zip(held, *waiting, strict=True)))
                return (low, high, apart), np.union1d(cut, further)

            for low, high, apart in _close(columns, radius):
                other = label[low] != label[high]
                waiting.append((low[other], high[other], apart[other]))
                size += len(waiting[-1][0])
                if size > FRONTIER:
                    (held, cut), waiting, size = settle(), [], 0
            held, cut = settle()
            low, high, _ = held
            yield pa.RecordBatch.from_arrays(
                [pa.array(value[high]), pa.array(value[low]), pa.array(np.isin(high, cut))], names=["u", "v", "more"]
            )

    return run


def shingle_set(text: Column, width: int = WIDTH) -> Column:
    """The distinct hashes of all runs of ``width`` words, lower-cased in A-Z; of all words, if
    fewer; null without words."""
    lowered = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lowered, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def runs(held: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(held) - width)
        many = F.transform(starts, lambda i: F.xxhash64(*[F.get(held, i + n) for n in range(width)]))
        return F.when(F.size(held) >= width, many).when(F.size(held) > 0, F.array(F.xxhash64(held)))

    # a fold of one element, so that the words are cut once
    return F.array_distinct(F.get(F.transform(F.array(words), runs), 0))


def similar_pairs(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The rows (u, v) of ``pairs`` whose shingles, rows (fp, shingles), are similar enough."""
    sizes = pairs.groupBy("v").count()
    salt = F.pmod(F.xxhash64("u"), F.ceil(F.col("count") / PARTNERS)).cast("int")
    dealt = Stored(pairs.join(shuffled(sizes), "v").select("u", "v", salt.alias("salt")), "pairs")
    ours = sets.select(F.col("fp").alias("u"), F.col("shingles").alias("x"))
    theirs = dealt.df.select("v", "salt").distinct().join(
        shuffled(sets.select(F.col("fp").alias("v"), F.col("shingles").alias("y"))), "v"
    )
    common = F.size(F.array_intersect("x", "y"))
    alike = common / (F.size("x") + F.size("y") - common)
    return dealt.df.join(shuffled(ours), "u").join(shuffled(theirs), ["v", "salt"]).where(alike >= similarity).select("u", "v")


def one_of_each(
    documents: DataFrame,
    *,
    width: int = WIDTH,
    radius: int = RADIUS,
    similarity: float = SIMILARITY,
    piece: int = PIECE,
) -> DataFrame:
    """The documents with the smallest doc_id of their group of near copies, with their columns.

    Texts are linked if their fingerprints differ in ``radius`` bits at most and their sets of
    word shingles have at least the Jaccard similarity; groups are what links connect. Texts
    with one fingerprint are copies. Null, empty and blank texts have fingerprint 0 and are one
    group; texts of fewer than ``width`` words are one shingle. A null doc_id is never the
    smallest, unless a group has no other; of repeated rows of the smallest doc_id one stays.
    An empty table stays empty. Whole texts are read, of any length.
    """
    own = free_name(documents, "_fp")
    marked = Stored(with_fingerprint(documents, own, width=width), "fingerprints").df
    known = Stored(marked.groupBy(F.col(own).alias("fp")).agg(F.min("doc_id").alias("least")), "fingerprints").df
    pairs = Stored(cells_within(known.select("fp"), radius, piece).mapInArrow(_closest(radius), "u long, v long").distinct(), "pairs").df
    paired = pairs.select(F.col("u").alias("fp")).union(pairs.select("v")).distinct()
    wanted = Stored(known.join(shuffled(paired), "fp"), "paired").df
    texts = marked.select(F.col(own).alias("fp"), "doc_id", "text").join(shuffled(wanted), "fp").where(F.col("doc_id").eqNullSafe(F.col("least")))
    sets = Stored(texts.dropDuplicates(["fp"]).select("fp", shingle_set(F.col("text"), width).alias("shingles")), "shingles").df
    links = Stored(similar_pairs(pairs, sets, similarity), "links").df
    parts = connected_components(links)
    most = PER_ROUND
    while True:
        labels = Stored(
            wanted.join(shuffled(parts), F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("component", "fp").alias("label")),
            "labels",
        ).df
        crossing = Stored(cells_within(labels, radius, piece).mapInArrow(_crossing(radius, most), "u long, v long, more boolean"), "pairs").df
        fresh = Stored(crossing.select("u", "v").distinct().join(shuffled(pairs), ["u", "v"], "left_anti"), "pairs").df
        further = Stored(similar_pairs(fresh, sets, similarity), "links").df
        if not further.isEmpty():
            links = links.union(further)
            parts = connected_components(links)
        if crossing.where("more").isEmpty():
            break
        pairs = pairs.union(fresh)
        most *= PER_ROUND
    named = known.join(shuffled(parts), known["fp"] == parts["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    least = named.groupBy("component").agg(F.min("least").alias("smallest"))
    group, smallest = free_name(documents, "_group"), free_name(documents, "_smallest")
    classes = Stored(
        named.join(shuffled(least), "component").where(F.col("least").eqNullSafe(F.col("smallest"))).select(
            F.col("fp").alias(own), F.col("component").alias(group), F.col("smallest").alias(smallest)
        ),
        "classes",
    ).df
    kept = marked.join(shuffled(classes), own).where(F.col("doc_id").eqNullSafe(F.col(smallest)))
    return kept.dropDuplicates(["doc_id", group]).select(*documents.columns)
