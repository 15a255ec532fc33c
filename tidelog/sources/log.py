"""A shard-partitioned log on shared storage: append, catalogue, batch read.

Layout below the log folder, all of it plain parquet written by Spark:

* ``data/segment=N/attempt=A/stream=S/shard_id=H/`` holds the records of one append, sorted
  by ``seq_key``; a large shard spans many files, split by key range;
* ``index/segment=N/`` holds one row per data file with its row count and bounds. It is
  written after the data, and only indexed attempts are read, so an append that fails half
  way is never seen and can simply be repeated under the same number. A segment that is
  indexed is done: repeating it changes nothing, and no reader loses a file.

* ``compacted/upto=N/`` is an index in place of those of the segments up to N, whose small files
  were packed into larger ones (``compact``). It counts once its success marker is there, so
  every reader sees either the old files or the new ones. A row without a file stands for
  records past retention: they keep their numbers, and readers open behind them.

A log has one writer at a time, which also compacts it, and its segments are appended in rising
order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.errors import LogError
from tidelog.functions.sequence import with_order_key
from tidelog.operators.records import pack_records
from tidelog.plans.scratch import written
from tidelog.schema import SHARD_KEYS

LOG_SCHEMA = T.StructType(
    [
        T.StructField("sequence_number", T.StringType()),
        T.StructField("partition_key", T.StringType()),
        T.StructField("arrival_ts", T.TimestampType()),
        T.StructField("data", T.BinaryType()),
        T.StructField("seq_key", T.StringType()),
        T.StructField("segment", T.LongType()),
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
    ]
)

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("file", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("first_key", T.StringType()),
        T.StructField("last_key", T.StringType()),
        T.StructField("last_ts_us", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("attempt", T.StringType()),
        T.StructField("segment", T.LongType()),
    ]
)

_STORED = [f.name for f in LOG_SCHEMA.fields if f.name != "segment"]
_ATTEMPT = T.StructField("attempt", T.StringType())
# Records of a file that compaction writes.
FILE_RECORDS = 1_000_000


def shard_of(partition_key: Column, shards: int) -> Column:
    """The shard a key is routed to; all records of a key share it."""
    return F.concat(F.lit("shard-"), F.pmod(F.xxhash64(partition_key), F.lit(shards)))


def append_log(records: DataFrame, path: str, segment: int) -> None:
    """Appends records that have a sequence number as segment ``segment``.

    Range partitioning gives a shard as many tasks and files as its size asks for.
    """
    keyed = with_order_key(records)
    _write_segment(keyed.repartitionByRange(*SHARD_KEYS, "seq_key"), path, segment)


def _write_segment(laid_out: DataFrame, path: str, segment: int) -> None:
    if segment < 0:
        raise LogError("a segment number is not negative")
    spark = laid_out.sparkSession
    known, upto = _segments(spark, path), _compacted(spark, path)
    if segment in known or (upto is not None and segment < upto):
        return
    if known and segment < max(known):
        raise LogError(f"segment {segment} comes before {max(known)}, which is already in the log")
    attempt = uuid.uuid4().hex
    folder = f"{path}/data/segment={segment}/attempt={attempt}"
    stored = laid_out.withColumn("arrival_ts", F.col("arrival_ts").cast("timestamp"))
    (
        stored.sortWithinPartitions(*SHARD_KEYS, "seq_key")
        .select(*_STORED)
        .write.partitionBy(*SHARD_KEYS)
        .parquet(folder)
    )
    _indexed(spark, folder, attempt).write.mode("overwrite").parquet(f"{path}/index/segment={segment}")


def _indexed(spark: SparkSession, folder: str, attempt: str) -> DataFrame:
    """One row per data file of an attempt; compacted files know where they start."""
    fields = [f for f in LOG_SCHEMA.fields if f.name != "segment"]
    stored = T.StructType([*fields, T.StructField("idx", T.LongType())])
    return (
        spark.read.schema(stored)
        .parquet(folder)
        .groupBy(*SHARD_KEYS, F.col("_metadata.file_path").alias("file"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("seq_key").alias("first_key"),
            F.max("seq_key").alias("last_key"),
            F.unix_micros(F.max("arrival_ts")).alias("last_ts_us"),
            F.min("idx").alias("start"),
        )
        .withColumn("attempt", F.lit(attempt))
    )


def publish(
    messages: DataFrame,
    path: str,
    segment: int,
    *,
    order: list[str],
    writer: str,
    row_id: Column,
    shards: int = 1,
) -> None:
    """Packs, routes and appends messages (``stream``, ``headers``, ``payload``).

    Sequence numbers rise along ``order`` within a shard and from segment to segment. A
    ``shard_id`` or ``arrival_ts`` already on the messages is kept.
    """
    if shards < 1:
        raise LogError("a log needs at least one shard")
    packed = pack_records(messages, writer, row_id)
    if "shard_id" not in packed.columns:
        packed = packed.withColumn("shard_id", shard_of(F.col("partition_key"), shards))
    if "arrival_ts" not in packed.columns:
        packed = packed.withColumn("arrival_ts", F.current_timestamp())
    # Row ids rise with the partition, and the partitions are ranges of (shard, order).
    laid_out = packed.repartitionByRange(*SHARD_KEYS, *order).sortWithinPartitions(
        *SHARD_KEYS, *order
    )
    base = F.lit(10**18).cast("decimal(38,0)") * F.lit(segment + 1)
    number = base + F.monotonically_increasing_id().cast("decimal(38,0)")
    numbered = laid_out.withColumn("sequence_number", number.cast("decimal(38,0)").cast("string"))
    _write_segment(with_order_key(numbered), path, segment)


def log_index(spark: SparkSession, path: str) -> DataFrame:
    """One row per data file of the log."""
    return _entries(spark, path).where(F.col("file").isNotNull())


def _entries(spark: SparkSession, path: str) -> DataFrame:
    """The index in force, with the rows that stand for trimmed records."""
    upto = _compacted(spark, path)
    rows = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/index")
    if upto is None:
        return rows
    packed = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/compacted/upto={upto}")
    later = rows.where(F.col("segment") > upto)
    return later.unionByName(packed.withColumn("segment", F.lit(upto).cast("long")))


def log_files(spark: SparkSession, path: str) -> DataFrame:
    """The index with ``start``, the arrival index of a file's first record on its shard.

    Rows without a file stand for records that were trimmed.
    """
    before = Window.partitionBy(*SHARD_KEYS).orderBy("segment", "start", "first_key")
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    return _entries(spark, path).withColumn("start", F.coalesce(F.sum("rows").over(before), F.lit(0)))


def read_log(spark: SparkSession, path: str, stream: str | None = None) -> DataFrame:
    """Records of the log as a table; streams and shards prune folders, ``seq_key`` row groups."""
    names = ["segment", "attempt"]
    committed = log_index(spark, path).select(*names).distinct()
    records = spark.read.schema(T.StructType([*LOG_SCHEMA.fields, _ATTEMPT])).parquet(f"{path}/data")
    if stream is not None:
        records = records.filter(F.col("stream") == stream)
    return records.join(committed, names, "left_semi").drop(*names)


def compact(
    spark: SparkSession, path: str, *, file_records: int = FILE_RECORDS, before_ms: int | None = None
) -> None:
    """Packs the data files so far into files of ``file_records`` records, in the same order.

    With ``before_ms``, files at the front of a shard that hold nothing from that time on are
    past retention and left out. Every record keeps its arrival index. Readers go on with the
    old files until the new index is complete, and the old ones stay until ``drop_replaced``.
    """
    upto = newest_segment(spark, path)
    if upto is None or upto == _compacted(spark, path):
        return
    files = log_files(spark, path)
    kept = F.col("file").isNotNull()
    if before_ms is not None:
        kept = kept & (F.col("last_ts_us") >= before_ms * 1000)
    bounds = files.groupBy(*SHARD_KEYS).agg(
        F.coalesce(F.min(F.when(kept, F.col("start"))), F.sum("rows")).alias("bound")
    )
    bounds = written(bounds, "bounds")
    placed = files.where(F.col("file").isNotNull()).select("file", "start")
    names = [f.name for f in LOG_SCHEMA.fields if f.name != "segment"]
    records = spark.read.schema(LOG_SCHEMA).parquet(f"{path}/data").select(
        *names, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("_row")
    )
    indexed = records.join(placed, "file").withColumn("idx", F.col("start") + F.col("_row"))
    retained = indexed.join(bounds, SHARD_KEYS).where(F.col("idx") >= F.col("bound")).select(*names, "idx")
    attempt = uuid.uuid4().hex
    folder = f"{path}/data/segment={upto}/attempt={attempt}"
    (
        retained.repartitionByRange(*SHARD_KEYS, "idx")
        .sortWithinPartitions(*SHARD_KEYS, "idx")
        .select(*[n for n in names if n not in SHARD_KEYS], "idx", *SHARD_KEYS)
        .write.option("maxRecordsPerFile", file_records)
        .partitionBy(*SHARD_KEYS)
        .parquet(folder)
    )
    packed = _indexed(spark, folder, attempt)
    gone = bounds.where(F.col("bound") > 0).select(
        *SHARD_KEYS, F.col("bound").alias("rows"), F.lit(0).cast("long").alias("start"), F.lit(attempt).alias("attempt")
    )
    every = packed.unionByName(gone, allowMissingColumns=True)
    every.coalesce(1).write.mode("overwrite").parquet(f"{path}/compacted/upto={upto}")


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Deletes the files and indexes that a compaction has replaced; returns how many folders.

    A reader whose poll is under way may still hold the old names, so run this between polls.
    """
    upto = _compacted(spark, path)
    if upto is None:
        return 0
    committed = {r.attempt for r in _entries(spark, path).select("attempt").distinct().toLocalIterator()}
    root, files = _folder(spark, path)
    old = files.globStatus(root(f"{path}/data/segment=*/attempt=*")) or ()
    stale = [f.getPath() for f in old if _number(f.getPath().getParent()) <= upto]
    stale = [p for p in stale if p.getName().partition("=")[2] not in committed]
    for pattern, last in (("index/segment=*", upto), ("compacted/upto=*", upto - 1)):
        found = files.globStatus(root(f"{path}/{pattern}")) or ()
        stale += [f.getPath() for f in found if _number(f.getPath()) <= last]
    return sum(files.delete(p, True) for p in stale)


def read_shard(spark: SparkSession, path: str, stream: str, shard_id: str) -> DataFrame:
    """The records of one shard, in order."""
    one = read_log(spark, path, stream).filter(F.col("shard_id") == shard_id)
    return one.orderBy("seq_key")


def shard_catalogue(spark: SparkSession, path: str, stream: str | None = None) -> DataFrame:
    """Every shard the log holds, with its size and bounds, from the index alone."""
    index = log_index(spark, path)
    if stream is not None:
        index = index.filter(F.col("stream") == stream)
    return index.groupBy(*SHARD_KEYS).agg(
        F.sum("rows").alias("records"),
        F.countDistinct("segment").alias("segments"),
        F.min("first_key").alias("first_key"),
        F.max("last_key").alias("last_key"),
    )


def shard_listing(
    spark: SparkSession, path: str, lineage: DataFrame, stream: str | None = None
) -> DataFrame:
    """The catalogue with every shard of the lineage, those without a record among them.

    Adds the parents and whether a shard is closed; a shard the lineage does not name counts
    as open and has no parents.
    """
    known = lineage if stream is None else lineage.filter(F.col("stream") == stream)
    told = known.select(
        *SHARD_KEYS, "parent_id", "adjacent_parent_id", F.col("ending_sequence").isNotNull().alias("closed")
    )
    every = shard_catalogue(spark, path, stream).join(told, SHARD_KEYS, "full")
    none = {"records": F.lit(0).cast("long"), "segments": F.lit(0).cast("long"), "closed": F.lit(False)}
    return every.withColumns({c: F.coalesce(c, value) for c, value in none.items()})


def _folder(spark: SparkSession, path: str):
    """Hadoop's path constructor and the file system of ``path``."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path
    return root, root(path).getFileSystem(context._jsc.hadoopConfiguration())


def _number(folder) -> int:
    return int(folder.getName().partition("=")[2])


def _complete(spark: SparkSession, path: str, pattern: str) -> set[int]:
    """Numbers of the folders that have a success marker, from their names alone."""
    root, files = _folder(spark, path)
    found = files.globStatus(root(f"{path}/{pattern}/_SUCCESS")) or ()
    return {_number(f.getPath().getParent()) for f in found}


def _compacted(spark: SparkSession, path: str) -> int | None:
    """The segment up to which the index was replaced; null if it never was."""
    return max(_complete(spark, path, "compacted/upto=*"), default=None)


def _segments(spark: SparkSession, path: str) -> set[int]:
    """Numbers of the segments that are in the log, as far as they are not replaced."""
    upto = _compacted(spark, path)
    return _complete(spark, path, "index/segment=*") | (set() if upto is None else {upto})


def newest_segment(spark: SparkSession, path: str) -> int | None:
    """Number of the last segment; null when the log does not exist yet."""
    return max(_segments(spark, path), default=None)
