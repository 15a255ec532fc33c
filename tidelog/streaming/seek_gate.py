"""The seek gate of a running reader: deliveries, acknowledgements and seeks in one stream.

A seek ends a generation of a shard: its acknowledgements are forgotten, and those that still
come for what was read before are stale. State is kept per shard for the present generation only
and cleared at each seek. A generation is told by the position its deliveries start from, so an
acknowledgement needs no stamp: whatever lies before that position is stale.

Events of a micro-batch are brought together by shard and stretch of the clock first; within a
stretch they become segments between seeks, with deliveries and acknowledgements as ranges. A
shard's state sees its segments in order, a few rows per stretch, however many records it has.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.settlement import is_done
from tidelog.schema import SHARD_KEYS
from tidelog.streaming import ranges as R
from tidelog.streaming.tracker import _RANGE_ARROW, _SHARD, range_arrays

# Kinds of events, in the order in which simultaneous ones count.
SEEK, DELIVER, SETTLE = 0, 1, 2
EVENT = "stream string, shard_id string, at long, kind int, idx long, sequence_number string"

_SEGMENT = T.StructType(
    [
        *_SHARD,
        T.StructField("at", T.LongType()),
        T.StructField("seeks", T.LongType()),
        T.StructField("delivered", T.LongType()),
        T.StructField("ranges", R.RANGES),
    ]
)
_SEGMENT_ARROW = pa.schema(
    [
        ("stream", pa.string()), ("shard_id", pa.string()), ("at", pa.int64()),
        ("seeks", pa.int64()), ("delivered", pa.int64()), ("ranges", _RANGE_ARROW),
    ]
)
_GENERATION = T.StructType(
    [
        T.StructField("epoch", T.LongType()),
        T.StructField("base", T.LongType()),
        T.StructField("delivered", T.LongType()),
        T.StructField("reached", T.LongType()),
        T.StructField("ahead", R.RANGES),
    ]
)
_ADVANCE = T.StructType(
    [
        *_SHARD,
        T.StructField("epoch", T.LongType()),
        T.StructField("at", T.LongType()),
        T.StructField("checkpoint", T.StringType()),
        T.StructField("checkpoint_idx", T.LongType()),
        T.StructField("stale_acks", T.LongType()),
    ]
)


def _segments(table: pa.Table) -> pa.Table:
    """The events of a shard in one stretch of the clock, cut at its seeks."""
    columns = [table.column(c).to_pylist() for c in ("at", "kind", "idx", "sequence_number")]
    events = sorted(zip(*columns, strict=True), key=lambda e: e[:2])
    out: list[list] = []
    for at, kind, idx, sequence in events:
        # A seek opens a segment; further seeks of the same instant belong to it.
        if not out or (kind == SEEK and (not out[-1][1] or out[-1][0] != at)):
            out.append([at, 0, 0, [], []])
        segment = out[-1]
        if kind == SEEK:
            segment[1] += 1
        elif kind == DELIVER:
            segment[2] = max(segment[2], idx + 1)
        else:
            segment[3].append(idx)
            segment[4].append(sequence)
    shard = {c: table.column(c)[0].as_py() for c in SHARD_KEYS}
    rows = [
        {**shard, "at": at, "seeks": seeks, "delivered": delivered,
         "ranges": range_arrays(R.of_positions(positions, sequences))}
        for at, seeks, delivered, positions, sequences in out
    ]
    return pa.Table.from_pylist(rows, _SEGMENT_ARROW)


class SeekGate(StatefulProcessor):
    """Per shard: the present generation, where it starts and what of it is settled."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("generation", _GENERATION)

    def handleInputRows(self, key, rows, timerValues):
        epoch, base, delivered, reached, ahead = 0, 0, 0, 0, []
        if self._state.exists():
            epoch, base, delivered, reached, held = self._state.get()
            ahead = R.of_rows(held)
        for segment in sorted(rows, key=lambda s: s.at):
            if segment.seeks:
                epoch, base, reached, ahead = epoch + segment.seeks, delivered, delivered, []
            delivered = max(delivered, segment.delivered)
            live, stale = R.clipped(R.of_rows(segment.ranges), base)
            reached, sequence, ahead = R.advance(reached, [*ahead, *live])
            if sequence is not None or stale:
                yield Row(
                    stream=key[0], shard_id=key[1], epoch=epoch, at=segment.at, checkpoint=sequence,
                    checkpoint_idx=None if sequence is None else reached - 1, stale_acks=stale,
                )
        self._state.update((epoch, base, delivered, reached, ahead))

    def close(self) -> None:
        pass


def on_every_shard(seeks: DataFrame, shards: DataFrame) -> DataFrame:
    """A stream of seeks with one row per shard they move: (stream, shard_id, at).

    A null ``shard_id`` moves every shard of the stream that ``shards`` lists; the list is
    read anew for every micro-batch.
    """
    listed = shards.select("stream", F.col("shard_id").alias("_listed"))
    wide = seeks.where("shard_id is null").join(listed, "stream").withColumn("shard_id", F.col("_listed"))
    rows = seeks.where("shard_id is not null").select(*SHARD_KEYS, "at")
    return rows.unionByName(wide.select(*SHARD_KEYS, "at"))


def events(deliveries: DataFrame, settlements: DataFrame, seeks: DataFrame) -> DataFrame:
    """One stream of events out of three.

    ``deliveries`` (stream, shard_id, at, idx) are numbered per shard in the order they were
    read, across seeks. ``settlements`` (also sequence_number and outcome) name the delivery
    they settle by its ``idx``; ``seeks`` (stream, shard_id, at) move one shard each.
    """
    none = F.lit(None)
    settled = settlements.where(is_done(F.col("outcome")))
    parts = [
        seeks.select(*SHARD_KEYS, "at", F.lit(SEEK).alias("kind"), none.cast("long").alias("idx"), none.cast("string").alias("sequence_number")),
        deliveries.select(*SHARD_KEYS, "at", F.lit(DELIVER).alias("kind"), "idx", none.cast("string").alias("sequence_number")),
        settled.select(*SHARD_KEYS, "at", F.lit(SETTLE).alias("kind"), "idx", "sequence_number"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def gate(happened: DataFrame, stretch: int) -> DataFrame:
    """Checkpoint advances by generation, from a stream of :func:`events`.

    Rows (stream, shard_id, epoch, at, checkpoint, checkpoint_idx, stale_acks): where the
    checkpoint of a generation came to, and how many stale acknowledgements were dropped with
    it (``checkpoint`` is null where nothing else happened). ``at`` grows along a shard's rows, so
    they can be kept by ``tracker.keep_checkpoints(..., "at")``. Micro-batches follow the
    clock; inside one, events come in any order. An acknowledgement that arrives in a batch
    after a seek is judged by that seek. ``stretch`` is how much of the clock one task brings
    together.
    """
    rows = happened.withColumn("stretch", F.floor(F.col("at") / stretch))
    segments = rows.groupBy(*SHARD_KEYS, "stretch").applyInArrow(_segments, _SEGMENT)
    return segments.groupBy(*SHARD_KEYS).transformWithState(SeekGate(), _ADVANCE, "Append", "None")
