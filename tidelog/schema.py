"""Table schemas and the fixed values of the record format."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the record format: headers, magic bytes and markers on the wire.
PARTITION_KEY_HEADER = "partition-key"
SEQUENCE_HEADER = "kinesis-sequence-number"
SHARD_HEADER = "kinesis-shard-id"
ENVELOPE_MAGIC = b"RSK1"
AGGREGATED_MAGIC = bytes([0xF3, 0x89, 0x9A, 0xC2])
SPREAD_KEY_PREFIX = "rs"
SHARD_END = "SHARD_END"

# Fixed limits and defaults.
MAX_SEQUENCE_DIGITS = 129
DEFAULT_BATCH = 1000
MAX_BATCH = 10_000
LEASE_TTL_MS = 10_000
RENEW_EVERY_MS = 3_000

SHARD_KEYS = ["stream", "shard_id"]

RECORD = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("sequence_number", T.StringType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("arrival_ts", T.TimestampType()),
        T.StructField("data", T.BinaryType()),
    ]
)

SHARD = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("parent_id", T.StringType()),
        T.StructField("adjacent_parent_id", T.StringType()),
        T.StructField("ending_sequence", T.StringType()),
    ]
)

CHECKPOINT = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("checkpoint", T.StringType()),
    ]
)

LEASE_COMMAND = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("t_ms", T.LongType()),
        T.StructField("owner", T.StringType()),
        T.StructField("op", T.StringType()),
        T.StructField("ttl_ms", T.LongType()),
        T.StructField("sequence", T.StringType()),
    ]
)

LEASE_STATE = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("owner", T.StringType()),
        T.StructField("expires_ms", T.LongType()),
        T.StructField("checkpoint", T.StringType()),
        T.StructField("counter", T.LongType()),
    ]
)
