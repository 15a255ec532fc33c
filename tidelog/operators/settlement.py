"""Acknowledgement checkpoints: how far each shard is handled without a gap.

A shard's checkpoint is the last record whose whole prefix is settled. The first record that
is not settled wedges it; reading goes on, but a later reader starts again from the wedge.
``deliveries`` carry (stream, shard_id, sequence_number, outcome) and, where the order of
settling matters, ``settle_ord``. Only the order of ``seq_key`` matters, so the reductions
need no delivery index: they are plain aggregates, combined on the map side whatever the size
of a shard.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.sequence import order_key, with_order_key
from tidelog.operators.records import accepted
from tidelog.plans.prefix import Scan, prefix
from tidelog.plans.scratch import written
from tidelog.schema import SHARD_END, SHARD_KEYS

# Fixed outcomes of a handled record.
ACK = "ack"
NACK_SKIP = "nack_skip"
NACK_REQUEUE = "nack_requeue"

_NEVER = (1 << 63) - 1


def is_done(outcome: Column) -> Column:
    """Handled or skipped counts as done; a requeue, or no outcome yet, does not."""
    return F.coalesce(outcome.isin(ACK, NACK_SKIP), F.lit(False))


def with_done(deliveries: DataFrame) -> DataFrame:
    return deliveries.withColumn("done", is_done(F.col("outcome")))


def with_delivery_index(records: DataFrame, **scan) -> DataFrame:
    """Arrival index per shard from 0, over the records that are delivered."""
    keyed = with_order_key(accepted(records) if "data" in records.columns else records)
    return prefix(
        keyed, SHARD_KEYS, ["seq_key"], {"idx": Scan("count", inclusive=False)}, **scan
    )


def _settled(deliveries: DataFrame) -> DataFrame:
    return with_order_key(with_done(deliveries))


def wedges(deliveries: DataFrame, keys: Sequence[str] = SHARD_KEYS) -> DataFrame:
    """Per wedged shard, the ``seq_key`` of the first record that is not done.

    Only the records still pending are aggregated, and those are few.
    """
    pending = _settled(deliveries).filter(~F.col("done"))
    return pending.groupBy(*keys).agg(F.min("seq_key").alias("wedge_key"))


def final_checkpoints(
    deliveries: DataFrame, keys: Sequence[str] = SHARD_KEYS
) -> DataFrame:
    """Per shard, the checkpoint once everything settled so far has been counted."""
    found = written(wedges(deliveries, keys), "wedges")
    joined = _settled(deliveries).join(found, list(keys), "left")
    before = F.col("wedge_key").isNull() | (F.col("seq_key") < F.col("wedge_key"))
    return joined.groupBy(*keys).agg(
        F.max_by("sequence_number", F.when(before, F.col("seq_key"))).alias("checkpoint")
    )


def advance_log(
    deliveries: DataFrame, keys: Sequence[str] = SHARD_KEYS, **scan
) -> DataFrame:
    """Every advance of a checkpoint: the settle call that caused it and the sequence reached.

    A record is released by the latest settle among itself and all before it, which is a
    running maximum; the last record of each run is the one checkpointed.
    """
    when = F.when(F.col("done"), F.col("settle_ord"))
    ready = _settled(deliveries).select(
        *keys, "seq_key", "sequence_number", F.coalesce(when, F.lit(_NEVER)).alias("_at")
    )
    released = prefix(ready, keys, ["seq_key"], {"released_at": Scan("max", F.col("_at"))}, **scan)
    return (
        released.filter(F.col("released_at") < _NEVER)
        .groupBy(*keys, F.col("released_at").alias("settle_ord"))
        .agg(
            F.max_by("sequence_number", "seq_key").alias("checkpoint"),
            F.count(F.lit(1)).alias("released"),
        )
    )


def settle_results(deliveries: DataFrame, keys: Sequence[str] = SHARD_KEYS, **scan) -> DataFrame:
    """Every settle call with the checkpoint it returned, null when it was held back."""
    calls = with_done(deliveries).filter(F.col("done") & F.col("settle_ord").isNotNull())
    calls = calls.select(*keys, "settle_ord", "sequence_number")
    return calls.join(advance_log(deliveries, keys, **scan), [*keys, "settle_ord"], "left")


def drained(deliveries: DataFrame) -> DataFrame:
    """Per shard, whether nothing is outstanding, and how many records are."""
    return with_done(deliveries).groupBy(*SHARD_KEYS).agg(
        F.bool_and("done").alias("drained"),
        F.count_if(~F.col("done")).alias("outstanding"),
    )


def wedge_report(deliveries: DataFrame) -> DataFrame:
    """Per wedged shard: the blocking record, how much it holds back and for how long."""
    found = written(wedges(deliveries), "wedges")
    behind = _settled(deliveries).join(found, SHARD_KEYS).filter(
        F.col("seq_key") >= F.col("wedge_key")
    )
    first = F.col("seq_key") == F.col("wedge_key")
    return behind.groupBy(*SHARD_KEYS).agg(
        F.max(F.when(first, F.col("sequence_number"))).alias("blocked_by"),
        F.count(F.lit(1)).alias("redelivered"),
        F.count_if(F.col("done")).alias("handled_again"),
        (
            F.unix_millis(F.max(F.col("arrival_ts").cast("timestamp")))
            - F.unix_millis(F.max(F.when(first, F.col("arrival_ts").cast("timestamp"))))
        ).alias("blocked_ms"),
    )


def replay_set(deliveries: DataFrame) -> DataFrame:
    """What the next reader is given: the wedge and all after it, handled or not."""
    found = written(wedges(deliveries), "wedges")
    joined = with_order_key(deliveries).join(found, SHARD_KEYS)
    return joined.filter(F.col("seq_key") >= F.col("wedge_key")).drop("wedge_key")


def shard_checkpoints(shards: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Stored checkpoint per listed shard; a closed shard read to its end is marked finished.

    ``shards`` has ``ending_sequence`` (null while open) and may have ``last_key``, the order
    key of the last record the shard holds (null if it holds none; without the column, the
    ending sequence must be reached) and ``checkpoint``, what is stored so far, which stands
    where there are no deliveries. A shard is finished once it is closed, its last record has
    been delivered and nothing is outstanding.
    """
    tip = _settled(deliveries).groupBy(*SHARD_KEYS).agg(F.max("seq_key").alias("_tip"))
    state = final_checkpoints(deliveries).join(drained(deliveries), SHARD_KEYS).join(tip, SHARD_KEYS)
    state = state.withColumnRenamed("checkpoint", "_reached")
    joined = shards.join(written(state, "state"), SHARD_KEYS, "left")
    last = F.col("last_key") if "last_key" in shards.columns else order_key(F.col("ending_sequence"))
    read = last.isNull() | F.coalesce(F.col("drained") & (F.col("_tip") >= last), F.lit(False))
    stored = F.col("checkpoint") if "checkpoint" in shards.columns else F.lit(None).cast("string")
    finished = F.col("ending_sequence").isNotNull() & read
    return joined.select(
        *SHARD_KEYS,
        F.when(finished, F.lit(SHARD_END)).otherwise(F.coalesce("_reached", stored)).alias("checkpoint"),
    )


def last_writes(writes: DataFrame) -> DataFrame:
    """Checkpoint per shard after a series of writes (``checkpoint``, ``write_ord``).

    The last write stands, also when it moves a shard back.
    """
    return writes.groupBy(*SHARD_KEYS).agg(
        F.max_by("checkpoint", "write_ord").alias("checkpoint"),
        F.max("write_ord").alias("write_ord"),
    )
