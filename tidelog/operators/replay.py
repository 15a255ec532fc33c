"""Where reading starts: positions resolved per shard, and the records they select.

Every filter compares ``seq_key`` with at most one bound per shard. The bounds form a
per-shard table that is written out first, so that its size decides how it is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions import positions as P
from tidelog.functions.sequence import order_key, with_order_key
from tidelog.plans.scratch import written
from tidelog.plans.spread import deal, join_spread
from tidelog.schema import SHARD_END, SHARD_KEYS

_MAX_TIMESTAMP_MS = (1 << 63) // 1000 - 1


def since(ts: Column, millis: int) -> Column:
    """``ts`` at or after an instant given in milliseconds, in a form the scan can use."""
    if millis > _MAX_TIMESTAMP_MS:
        return F.lit(False)
    return ts >= F.timestamp_millis(F.lit(millis))


def from_horizon(records: DataFrame) -> DataFrame:
    """Every retained record."""
    return with_order_key(records)


def shard_tips(records: DataFrame, before: Column | None = None) -> DataFrame:
    """The last ``seq_key`` of each shard, optionally as of a cut."""
    kept = records if before is None else records.filter(before)
    return with_order_key(kept).groupBy(*SHARD_KEYS).agg(F.max("seq_key").alias("tip_key"))


def from_tip(records: DataFrame, tips: DataFrame) -> DataFrame:
    """Records published after the tips were taken, new shards included."""
    joined = with_order_key(records).join(written(tips, "tips"), SHARD_KEYS, "left")
    after = F.col("tip_key").isNull() | (F.col("seq_key") > F.col("tip_key"))
    return joined.filter(after).drop("tip_key")


def from_timestamp(records: DataFrame, millis: int) -> DataFrame:
    """Each shard from its own first record at or after an instant.

    Later records of the shard are kept whatever their timestamp.
    """
    keyed = with_order_key(records)
    opening = (
        keyed.filter(since(F.col("arrival_ts"), millis))
        .groupBy(*SHARD_KEYS)
        .agg(F.min("seq_key").alias("_open_key"))
    )
    joined = keyed.join(written(opening, "opening"), SHARD_KEYS)
    return joined.filter(F.col("seq_key") >= F.col("_open_key")).drop("_open_key")


def from_sequence(records: DataFrame, shard_id: str, sequence: str) -> DataFrame:
    """One shard from exactly one record, which is included."""
    keyed = with_order_key(records).filter(F.col("shard_id") == shard_id)
    return keyed.filter(F.col("seq_key") >= order_key(F.lit(sequence)))


def after_checkpoints(records: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Each shard after its checkpoint; all of a shard without one, none of a finished one."""
    bounds = checkpoints.select(*SHARD_KEYS, F.col("checkpoint").alias("_checkpoint"))
    joined = with_order_key(records).join(written(bounds, "bounds"), SHARD_KEYS, "left")
    point = F.col("_checkpoint")
    open_ = point.isNull() | ((point != SHARD_END) & (F.col("seq_key") > order_key(point)))
    return joined.filter(open_).drop("_checkpoint")


def resolve_starts(
    shards: DataFrame,
    checkpoints: DataFrame,
    installed: DataFrame | None = None,
    why: Column | str = "start",
) -> DataFrame:
    """The position each shard opens at: ``start_kind``, ``start_ts_ms``, ``start_sequence``.

    ``installed(stream, kind, ts_ms)`` is the stream-wide position in force, so it reaches
    shards discovered after it was set. ``why`` is ``start`` for a reader that begins and
    ``recover`` for one that lost its place. A finished shard has a null kind: it is skipped.
    """
    reason = why if isinstance(why, Column) else F.lit(why)
    points = checkpoints.select(*SHARD_KEYS, "checkpoint")
    joined = deal(shards, SHARD_KEYS).join(deal(points, SHARD_KEYS), SHARD_KEYS, "left")
    if installed is None:
        joined = joined.withColumns(
            {"kind": F.lit(None).cast("string"), "ts_ms": F.lit(None).cast("long")}
        )
    else:
        position = installed.select("stream", "kind", "ts_ms")
        joined = join_spread(joined, position, ["stream"], ["shard_id"])
    point, kind = F.col("checkpoint"), F.col("kind")
    finished = F.coalesce(point == SHARD_END, F.lit(False))
    forced = kind.isNotNull() & ((reason == "start") | point.isNull())
    start_kind = (
        F.when(finished, F.lit(None))
        .when(forced, kind)
        .when(point.isNotNull(), F.lit(P.AFTER))
        .otherwise(F.lit(P.LATEST))
    )
    return joined.select(
        *SHARD_KEYS,
        start_kind.alias("start_kind"),
        F.when(~finished & forced, F.col("ts_ms")).alias("start_ts_ms"),
        F.when(~finished & ~forced, point).alias("start_sequence"),
    )


def replay_from(records: DataFrame, starts: DataFrame, tips: DataFrame) -> DataFrame:
    """Records selected by resolved starts. Shards that are skipped yield nothing."""
    keyed = with_order_key(records)
    bounds = written(starts.join(tips, SHARD_KEYS, "left"), "starts")
    timed = (
        keyed.join(bounds.filter(F.col("start_kind") == P.TIMESTAMP), SHARD_KEYS)
        .filter(F.unix_millis(F.col("arrival_ts").cast("timestamp")) >= F.col("start_ts_ms"))
        .groupBy(*SHARD_KEYS)
        .agg(F.min("seq_key").alias("_open_key"))
    )
    bounds = written(bounds.join(timed, SHARD_KEYS, "left"), "starts")
    kind, key = F.col("start_kind"), F.col("seq_key")
    selected = (
        (kind == P.HORIZON)
        | ((kind == P.LATEST) & (F.col("tip_key").isNull() | (key > F.col("tip_key"))))
        | ((kind == P.TIMESTAMP) & (key >= F.col("_open_key")))
        | ((kind == P.AFTER) & (key > order_key(F.col("start_sequence"))))
    )
    extra = ["start_kind", "start_ts_ms", "start_sequence", "tip_key", "_open_key"]
    return keyed.join(bounds, SHARD_KEYS).filter(selected).drop(*extra)
