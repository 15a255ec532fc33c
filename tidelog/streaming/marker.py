"""Skipping a backlog when a marker record comes by, in a running stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidelog.plans.scratch import written
from tidelog.streaming.snapshot import Snapshot, run_of

_MARKERS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("marker_at", T.LongType()),
        T.StructField("tip_at", T.LongType()),
    ]
)


def follow_tip(
    records: DataFrame,
    is_marker: Column,
    at: str,
    tips: Callable[[], DataFrame],
    state: str,
    out: str,
) -> DataStreamWriter:
    """Stores what is read up to a marker, drops the backlog behind it and follows the tip.

    Kept in ``state`` is one row per stream: where its first marker was, and the tip
    (``tips()``: stream, tip_at) when that marker was handled. Records between the two are
    dropped on every shard, in this micro-batch and in later ones; no record passes through
    state. Micro-batches follow ``at`` in each stream. Rows land in one folder of ``out`` per
    run of the query and micro-batch; a repeated batch replaces its own.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_of(spark)
        kept = Snapshot(spark, state, _MARKERS, ["stream"])
        known = kept.before(run, batch_id)
        met = batch.where(is_marker).groupBy("stream").agg(F.min(at).cast("long").alias("marker_at"))
        new = met.join(known, "stream", "left_anti").join(tips(), "stream", "left")
        new = written(new.select("stream", "marker_at", F.col("tip_at").cast("long")), "markers")
        bounds = known.unionByName(new)
        place, marker = F.col(at), F.col("marker_at")
        through = marker.isNull() | (place <= marker) | (place > F.coalesce("tip_at", marker))
        read = batch.join(bounds, "stream", "left").where(through).select(*batch.columns)
        read.write.mode("overwrite").parquet(f"{out}/run={run}/batch={batch_id}")
        kept.apply(new, run, batch_id)

    return records.writeStream.foreachBatch(handle)
