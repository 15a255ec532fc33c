"""Positions in a retained log, as structs of (kind, ts_ms, shard_id, sequence)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed position kinds. The first three apply to a whole stream, the last to one shard.
HORIZON = "horizon"
LATEST = "latest"
TIMESTAMP = "timestamp"
SEQUENCE = "sequence"
# How a shard resumes from a stored checkpoint.
AFTER = "after"

STREAM_WIDE = [HORIZON, LATEST, TIMESTAMP]

POSITION = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("ts_ms", T.LongType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("sequence", T.StringType()),
    ]
)

_MAX_LONG = (1 << 63) - 1


def _position(kind: str, ts_ms=None, shard_id=None, sequence=None) -> Column:
    def field(value, type_, name):
        column = value if isinstance(value, Column) else F.lit(value)
        return column.cast(type_).alias(name)

    return F.struct(
        F.lit(kind).alias("kind"),
        field(ts_ms, "long", "ts_ms"),
        field(shard_id, "string", "shard_id"),
        field(sequence, "string", "sequence"),
    )


def horizon() -> Column:
    """Everything the log still retains."""
    return _position(HORIZON)


def latest() -> Column:
    """The tip: only what is published from now on."""
    return _position(LATEST)


def timestamp(millis: int) -> Column:
    """The first record of each shard at or after an instant; clamped to a signed 64-bit."""
    if millis < 0:
        raise ValueError("a timestamp position is not negative")
    return _position(TIMESTAMP, ts_ms=min(millis, _MAX_LONG))


def sequence(shard_id: Column | str, number: Column | str) -> Column:
    """Exactly one record on one shard."""
    return _position(SEQUENCE, shard_id=shard_id, sequence=number)


def of_record() -> Column:
    """The pinned position of a delivered record."""
    return sequence(F.col("shard_id"), F.col("sequence_number"))
