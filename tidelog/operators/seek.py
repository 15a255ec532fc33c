"""Seek generations: what a reposition makes stale.

A seek ends a generation of the shards it moves. The generation (``epoch``) of a record is
the number of seeks on its shard, or on its whole stream, that came before it was read.
Seeks are rows (stream, shard_id, at, kind); a null ``shard_id`` is stream-wide. ``at`` and
the read and settle positions of deliveries are on one integer clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.functions import errors
from tidelog.functions.positions import STREAM_WIDE
from tidelog.operators.settlement import final_checkpoints
from tidelog.plans.prefix import Scan, prefix
from tidelog.plans.scratch import written
from tidelog.schema import SHARD_KEYS


def dispatch(seeks: DataFrame, live: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Seeks by the readers they move; returns (applied, error rows).

    A stream-wide kind moves every shard of the stream and cannot fail for want of a reader.
    A pinned one needs a live reader of its shard, from ``live(stream, shard_id)``.
    """
    wide = seeks.filter(F.col("kind").isin(STREAM_WIDE)).withColumn(
        "shard_id", F.lit(None).cast("string")
    )
    pinned = seeks.filter(~F.col("kind").isin(STREAM_WIDE))
    applied = wide.unionByName(pinned.join(live, SHARD_KEYS, "left_semi"))
    kind = F.lit(errors.READ)
    failed = pinned.join(live, SHARD_KEYS, "left_anti")
    return applied, failed.withColumn("error", kind).withColumn(
        "error_detail", errors.detail(kind)
    )


def _among_seeks(rows: DataFrame, seeks: DataFrame, keys: list[str], at: str, name: str) -> DataFrame:
    """Adds to each row, per key, ``<name>``: how many seeks came before it, and
    ``<name>_next``: the position of the first one after.

    Rows and seeks are merged into one order, a seek before the rows at its position, and
    scanned once in each direction. Rows without a position have no seeks around them.
    """
    marks = seeks.select(*keys, F.col("at").alias("_at"), F.lit(1).alias("_n"), F.col("at").alias("_seek"))
    placed = rows.withColumns({"_at": F.col(at), "_n": F.lit(0), "_seek": F.lit(None).cast("long")})
    merged = placed.unionByName(marks, allowMissingColumns=True)
    scans = {
        name: Scan("sum", F.col("_n")),
        f"{name}_next": Scan("latest", F.col("_seek"), inclusive=False, reverse=True),
    }
    # Seeks sort before rows: 1 before 0.
    scanned = prefix(merged.withColumn("_row", 1 - F.col("_n")), keys, ["_at", "_row"], scans)
    return scanned.where("_n = 0").drop("_at", "_n", "_seek", "_row")


def _around(rows: DataFrame, seeks: DataFrame, at: str) -> DataFrame:
    """Adds ``epoch`` and ``_until``, the position at which the generation of a row ends.

    Pinned seeks are merged with the rows of their shard, stream-wide ones with those of their
    stream, so nothing is multiplied by the number of shards.
    """
    pinned = seeks.filter(F.col("shard_id").isNotNull())
    wide = seeks.filter(F.col("shard_id").isNull())
    both = _among_seeks(_among_seeks(rows, pinned, SHARD_KEYS, at, "_own"), wide, ["stream"], at, "_all")
    epoch = (F.col("_own") + F.col("_all")).cast("long")
    until = F.least("_own_next", "_all_next")
    return both.withColumn("epoch", epoch).withColumn("_until", until).drop("_own", "_all", "_own_next", "_all_next")


def with_epoch(rows: DataFrame, seeks: DataFrame, at: str, name: str = "epoch") -> DataFrame:
    """Adds the generation each row belongs to by its integer position ``at``.

    A seek at the very position of a row comes before it.
    """
    kept = [c for c in rows.columns if c != name]
    return _around(rows, seeks, at).select(*kept, F.col("epoch").alias(name))


def current_deliveries(rows: DataFrame, seeks: DataFrame, at: str) -> DataFrame:
    """Rows of the present generation: those read at or after the last seek on their shard.

    Needs no epochs, only the last seek of each shard and of each stream.
    """
    own = seeks.filter(F.col("shard_id").isNotNull()).groupBy(*SHARD_KEYS)
    all_ = seeks.filter(F.col("shard_id").isNull()).groupBy("stream")
    own_last = written(own.agg(F.max("at").alias("_own")), "seeks")
    all_last = written(all_.agg(F.max("at").alias("_all")), "seeks")
    joined = rows.join(own_last, SHARD_KEYS, "left").join(all_last, "stream", "left")
    last = F.greatest("_own", "_all")
    return joined.filter(last.isNull() | (F.col(at) >= last)).drop("_own", "_all")


def live_settlements(deliveries: DataFrame, seeks: DataFrame, at: str) -> DataFrame:
    """Adds ``epoch`` and ``stale_ack``; a stale settlement loses its ``outcome``.

    An acknowledgement counts only while its shard is in the generation it was read under:
    before the first seek that follows the read.
    """
    stale = F.col("settle_ord").isNotNull() & F.coalesce(F.col("settle_ord") >= F.col("_until"), F.lit(False))
    return (
        _around(deliveries, seeks, at)
        .withColumn("stale_ack", stale)
        .withColumn("outcome", F.when(~F.col("stale_ack"), F.col("outcome")))
        .withColumn("settle_ord", F.when(~F.col("stale_ack"), F.col("settle_ord")))
        .drop("_until")
    )


def epoch_checkpoints(settlements: DataFrame) -> DataFrame:
    """Checkpoint reached in each generation of a shard: every seek starts a new tracker."""
    return final_checkpoints(settlements, [*SHARD_KEYS, "epoch"])


def stored_checkpoints(settlements: DataFrame) -> DataFrame:
    """What is stored per shard: the newest generation that advanced, even if it is lower."""
    reached = epoch_checkpoints(settlements).filter(F.col("checkpoint").isNotNull())
    return reached.groupBy(*SHARD_KEYS).agg(
        F.max_by("checkpoint", "epoch").alias("checkpoint"),
        F.max("epoch").alias("epoch"),
    )


def epoch_index(deliveries: DataFrame, **scan) -> DataFrame:
    """Delivery index restarted by every seek: rows need ``epoch`` and ``seq_key``."""
    return prefix(
        deliveries,
        [*SHARD_KEYS, "epoch"],
        ["seq_key"],
        {"epoch_idx": Scan("count", inclusive=False)},
        **scan,
    )


def skip_backlog(records: DataFrame, is_marker, at: str, tips: DataFrame) -> DataFrame:
    """Reads up to a marker record, drops the backlog behind it and follows the tip.

    The seek moves the whole stream: on every shard, records that came after the first marker
    but were there when it was handled (``tips(stream, tip_at)``) are skipped.
    """
    markers = records.filter(is_marker).groupBy("stream").agg(F.min(at).alias("_marker_at"))
    bounds = written(markers.join(tips, "stream", "left"), "markers")
    joined = records.join(bounds, "stream", "left")
    position, marker, tip = F.col(at), F.col("_marker_at"), F.col("tip_at")
    kept = marker.isNull() | (position <= marker) | (position > F.coalesce(tip, marker))
    return joined.filter(kept).drop("_marker_at", "tip_at")

