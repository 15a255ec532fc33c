"""Acknowledgement checkpoints of a running subscription.

A shard's checkpoint is the end of the settled positions that run from its start without a gap.
A position that was never seen is a gap like one that is not settled, so nothing is passed that
has not arrived. What is kept between micro-batches are the settled ranges beyond the checkpoint;
they merge as gaps close and vanish once passed.

So that a shard with most of the traffic is not one task, the settlements of a micro-batch are
made into ranges in chunks of positions first; a shard's state sees one row per chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.settlement import is_done, last_writes
from tidelog.schema import SHARD_KEYS
from tidelog.streaming import ranges as R
from tidelog.streaming.snapshot import Snapshot, run_of

CHUNK = 65_536
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_SHARD = [T.StructField("stream", T.StringType()), T.StructField("shard_id", T.StringType())]
_CHUNK_ROW = T.StructType([*_SHARD, T.StructField("ranges", R.RANGES)])
_STATE = T.StructType([T.StructField("reached", T.LongType()), T.StructField("ahead", R.RANGES)])
_ADVANCE = T.StructType(
    [*_SHARD, T.StructField("checkpoint", T.StringType()), T.StructField("checkpoint_idx", T.LongType())]
)
CHECKPOINT_TABLE = T.StructType(
    [*_SHARD, T.StructField("checkpoint", T.StringType()), T.StructField("write_ord", T.LongType())]
)


def range_arrays(found: list[R.Range]) -> list[dict]:
    return [dict(zip(("low", "high", "sequence"), r, strict=True)) for r in found]


def _chunk_ranges(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The settled ranges of one chunk, merged batch by batch: no more is held than they need."""
    found: list[R.Range] = []
    for batch in batches:
        new = R.of_positions(batch.column("idx").to_pylist(), batch.column("sequence_number").to_pylist())
        found = R.merged([*found, *new])
    row = {"stream": key[0].as_py(), "shard_id": key[1].as_py(), "ranges": range_arrays(found)}
    yield pa.RecordBatch.from_pylist([row], _CHUNK_ARROW)


_RANGE_ARROW = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64()), ("sequence", pa.string())]))
_CHUNK_ARROW = pa.schema([("stream", pa.string()), ("shard_id", pa.string()), ("ranges", _RANGE_ARROW)])


class RangeTracker(StatefulProcessor):
    """Per shard: the first position that is not settled, and the settled ranges beyond it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("settled", _STATE)

    def handleInputRows(self, key, rows, timerValues):
        start, ahead = 0, []
        if self._state.exists():
            start, held = self._state.get()
            ahead = R.of_rows(held)
        reached, sequence, left = R.advance(start, [*ahead, *(r for row in rows for r in R.of_rows(row.ranges))])
        if left != ahead or reached != start:
            self._state.update((reached, left))
        if sequence is not None:
            yield Row(stream=key[0], shard_id=key[1], checkpoint=sequence, checkpoint_idx=reached - 1)

    def close(self) -> None:
        pass


def track_checkpoints(settlements: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Checkpoint advances of a stream of (stream, shard_id, idx, sequence_number, outcome).

    ``idx`` numbers the records a shard delivers, from 0 and without gaps (the ``idx`` of the
    source). Rows without an outcome that settles them change nothing. Rows may come in any
    order, late, and more than once.
    """
    done = settlements.where(is_done(F.col("outcome"))).select(
        *SHARD_KEYS, F.floor(F.col("idx") / chunk).alias("chunk"), "idx", "sequence_number"
    )
    found = done.groupBy(*SHARD_KEYS, "chunk").applyInArrow(_chunk_ranges, _CHUNK_ROW)
    return found.groupBy(*SHARD_KEYS).transformWithState(RangeTracker(), _ADVANCE, "Append", "None")


def use_state_store(spark: SparkSession) -> None:
    """Stateful queries of this package keep their state in RocksDB."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)


def keep_checkpoints(writes: DataFrame, path: str, order: str | Column) -> DataStreamWriter:
    """Maintains the table of stored checkpoints from a stream of writes.

    Within a micro-batch the write with the highest ``order`` stands, and a later batch
    replaces an earlier one, also when that lowers a checkpoint. Only the shards a batch
    writes are stored anew.
    """
    ordered = writes.withColumn("write_ord", F.col(order) if isinstance(order, str) else order)

    def upkeep(batch: DataFrame, batch_id: int) -> None:
        table = checkpoint_table(batch.sparkSession, path)
        table.apply(last_writes(batch), run_of(batch.sparkSession), batch_id)

    return ordered.writeStream.foreachBatch(upkeep)


def checkpoint_table(spark: SparkSession, path: str) -> Snapshot:
    return Snapshot(spark, path, CHECKPOINT_TABLE, SHARD_KEYS)
