"""Shard lineage: which shards may start, and in which order a resharded log is replayed.

``shards`` follow ``schema.SHARD``. A shard has up to two parents; a parent that is no longer
listed was trimmed past retention.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.positions import LATEST
from tidelog.functions.sequence import with_order_key
from tidelog.plans.prefix import Scan, prefix
from tidelog.plans.scratch import written
from tidelog.plans.spread import join_spread
from tidelog.schema import SHARD_END, SHARD_KEYS


def is_closed() -> Column:
    """A shard with an ending sequence number receives nothing more."""
    return F.col("ending_sequence").isNotNull()


def parent_edges(shards: DataFrame) -> DataFrame:
    """One row per named parent: (stream, shard_id, parent_id)."""
    parents = F.array_distinct(F.array_compact(F.array("parent_id", "adjacent_parent_id")))
    return shards.select(*SHARD_KEYS, F.explode(parents).alias("parent_id"))


def _listed_edges(shards: DataFrame) -> DataFrame:
    """Edges whose parent is listed, with the parent's closed flag."""
    parents = shards.select(
        "stream", F.col("shard_id").alias("parent_id"), is_closed().alias("parent_closed")
    )
    return parent_edges(shards).join(parents, ["stream", "parent_id"])


def blockers(
    shards: DataFrame, checkpoints: DataFrame, installed: DataFrame | None = None
) -> DataFrame:
    """Parents that are not finished yet, one row per (shard, blocking parent).

    A parent is done at ``SHARD_END``, and also when it is closed without a checkpoint while
    its stream is read from the tip: its history is skipped on purpose.
    """
    points = checkpoints.select(
        "stream", F.col("shard_id").alias("parent_id"), F.col("checkpoint").alias("parent_point")
    )
    edges = _listed_edges(shards).join(points, ["stream", "parent_id"], "left")
    if installed is None:
        from_tip = F.lit(True)
    else:
        edges = join_spread(edges, installed.select("stream", "kind"), ["stream"], ["shard_id"])
        from_tip = F.col("kind").isNull() | (F.col("kind") == LATEST)
    point = F.col("parent_point")
    done = F.coalesce(point == SHARD_END, F.lit(False)) | (
        point.isNull() & F.col("parent_closed") & from_tip
    )
    return edges.filter(~done).select(*SHARD_KEYS, "parent_id", "parent_point")


def parents_done(
    shards: DataFrame, checkpoints: DataFrame, installed: DataFrame | None = None
) -> DataFrame:
    """Shards none of whose parents hold them back."""
    return shards.join(blockers(shards, checkpoints, installed), SHARD_KEYS, "left_anti")


def startable(
    shards: DataFrame,
    checkpoints: DataFrame,
    leases: DataFrame,
    readers: DataFrame,
    owner: str,
    now_ms: int,
    installed: DataFrame | None = None,
    *,
    strict_expiry: bool = False,
) -> DataFrame:
    """Shards ``owner`` may start reading now.

    Their parents are done, they are not finished, no other owner's lease is running and no
    reader has them already.
    """
    expires = F.col("expires_ms")
    running = (expires >= now_ms) if strict_expiry else (expires > now_ms)
    taken = leases.filter((F.col("owner") != owner) & running)
    finished = checkpoints.filter(F.col("checkpoint") == SHARD_END)
    return (
        parents_done(shards, checkpoints, installed)
        .join(finished, SHARD_KEYS, "left_anti")
        .join(taken, SHARD_KEYS, "left_anti")
        .join(readers, SHARD_KEYS, "left_anti")
    )


def depths(shards: DataFrame) -> DataFrame:
    """Generation of each shard: the longest chain of listed parents above it.

    Peels the lineage from the top. A round takes the edges below the shards that are free,
    and frees those that no edge is left above; edges that were taken are out of the way, and
    every shard is placed once, in the round that is its generation.
    """
    columns = [*SHARD_KEYS, "parent_id", "adjacent_parent_id", "ending_sequence"]
    nodes = written(shards.select(*columns), "shards")
    waiting = written(_listed_edges(nodes).select(*SHARD_KEYS, "parent_id"), "edges")
    free = written(nodes.select(*SHARD_KEYS).distinct().join(waiting, SHARD_KEYS, "left_anti"), "generation")
    rounds = []
    while not free.isEmpty():
        rounds.append(free.withColumn("depth", F.lit(len(rounds)).cast("long")))
        above = free.select("stream", F.col("shard_id").alias("parent_id"), F.lit(True).alias("_free"))
        told = waiting.join(above, ["stream", "parent_id"], "left")
        split = written(told.withColumn("_free", F.coalesce("_free", F.lit(False))), "edges", by="_free")
        taken, waiting = split.where("_free").select(*SHARD_KEYS), split.where("not _free").drop("_free")
        free = written(taken.distinct().join(waiting, SHARD_KEYS, "left_anti"), "generation")
    if not waiting.isEmpty():
        raise ValueError("shard lineage does not end: a shard descends from itself")
    return reduce(DataFrame.unionByName, rounds) if rounds else free.withColumn("depth", F.lit(0).cast("long"))


def key_order(records: DataFrame, shards: DataFrame, **scan) -> DataFrame:
    """Position of each record within its partition key, across splits and merges.

    Sequence numbers compare within a shard only; a key's records on a parent come first.
    """
    generations = written(depths(shards), "depths")
    placed = with_order_key(records).join(generations, SHARD_KEYS, "left")
    placed = placed.withColumn("depth", F.coalesce("depth", F.lit(0).cast("long")))
    return prefix(
        placed,
        ["stream", "partition_key"],
        ["depth", "shard_id", "seq_key"],
        {"key_position": Scan("count", inclusive=False)},
        **scan,
    )


def trimmed_parents(shards: DataFrame) -> DataFrame:
    """Parents that are named but not listed, with the shards that name them."""
    listed = shards.select("stream", F.col("shard_id").alias("parent_id"))
    return parent_edges(shards).join(listed, ["stream", "parent_id"], "left_anti")
