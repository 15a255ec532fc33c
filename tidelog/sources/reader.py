"""Readers of a log: one row of state per shard, and polls that Spark answers.

A poll joins the positions of the shards with the index of the log (one row per data file) and
says per shard how far to read: to its end, to the cap, or not yet, while a parent is unread. The
data files that lie between are opened by Spark, and the arrival index of a record is where its
file starts plus its row number there. A shard that opens at a time or a sequence number in the
middle is looked up in the index first, so one file of it is searched, not its records.

What a poll reads is written down before it is handled, and the positions move on after. A poll
that was broken off is handled again with the same number and the same records.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import errors
from tidelog.functions import positions as P
from tidelog.functions.sequence import order_key
from tidelog.operators.lineage import is_closed, parent_edges
from tidelog.plans.scratch import written
from tidelog.schema import SHARD_END, SHARD_KEYS
from tidelog.sources.descriptor import RESUME, LogStream
from tidelog.sources.log import LOG_SCHEMA, log_files, newest_segment
from tidelog.streaming.snapshot import Snapshot

RECORD_DDL = (
    "stream string, shard_id string, sequence_number string, partition_key string, "
    "arrival_ts timestamp, data binary, seq_key string, idx long, error string"
)
# ``next`` is the arrival index a shard is read from. While ``how`` is set, the shard opens at the
# first record from there on that meets ``bound``, and none has come yet.
POSITIONS = T.StructType(
    [
        T.StructField("stream", T.StringType()),
        T.StructField("shard_id", T.StringType()),
        T.StructField("next", T.LongType()),
        T.StructField("how", T.StringType()),
        T.StructField("bound", T.StringType()),
    ]
)
_PLAN = T.StructType([*POSITIONS.fields, T.StructField("stop", T.LongType())])
# How a bound is met: by arrival time, at or after an order key, after an order key.
_TIME, _FROM, _AFTER = "time", "from", "after"


def _meets(how: Column, bound: Column, time_us: Column, key: Column) -> Column:
    """Whether a record, or the last of a file, lies at or past a bound."""
    by_time = time_us >= bound.try_cast("long")
    return F.when(how == _TIME, by_time).when(how == _FROM, key >= bound).otherwise(key > bound)


class Reader:
    """Reads the streams that ``sources`` describe from the log at ``path``.

    ``state`` is the folder of the reader's positions; a reader opened on it again goes on
    where the last one came to.
    """

    def __init__(self, spark: SparkSession, path: str, sources: Sequence[LogStream], state: str) -> None:
        self.spark = spark
        self.path = path.rstrip("/")
        self.sources = [s.validate() for s in sources]
        self.state = state.rstrip("/")
        self._kept = Snapshot(spark, f"{self.state}/positions", POSITIONS, SHARD_KEYS)

    def positions(self) -> DataFrame:
        """(stream, shard_id, next, how, bound) per shard met so far."""
        return self._kept.current()

    # Planning ----------------------------------------------------------------------------

    def _opened(self, source: LogStream, shards: DataFrame, late: bool) -> DataFrame:
        """Positions of shards (stream, shard_id, end, trimmed) met for the first time.

        All of a shard that appears ``late`` lies past the tip.
        """
        if source.checkpoints:
            points = self.spark.read.parquet(source.checkpoints).select(*SHARD_KEYS, "checkpoint")
            shards = shards.join(points, SHARD_KEYS, "left")
        else:
            shards = shards.withColumn("checkpoint", F.lit(None).cast("string"))
        point, text = F.col("checkpoint"), F.lit(None).cast("string")
        finished = F.coalesce(point == SHARD_END, F.lit(False))
        how, bound, start = text, text, F.col("trimmed") if late else F.col("end")
        if source.kind == P.HORIZON:
            start = F.col("trimmed")
        elif source.kind == P.TIMESTAMP:
            how, bound = F.lit(_TIME), F.lit(str(min(source.ts_ms * 1000, (1 << 63) - 1)))
        elif source.kind in (RESUME, P.SEQUENCE):
            usable = F.when(~finished, point)
            how = F.when(usable.isNotNull(), F.lit(_AFTER))
            bound = order_key(usable)
            if source.kind == P.SEQUENCE:
                pinned = F.col("shard_id") == source.shard_id
                how = F.when(pinned, F.lit(_FROM)).otherwise(how)
                bound = F.when(pinned, order_key(F.lit(source.sequence))).otherwise(bound)
        how = F.when(~finished, how)
        start = F.when(finished, F.col("end")).when(how.isNotNull(), F.col("trimmed")).otherwise(start)
        return shards.select(
            *SHARD_KEYS, start.cast("long").alias("next"), how.alias("how"),
            F.when(how.isNotNull(), bound).alias("bound"), "end",
        )

    def _looked_up(self, seeking: DataFrame, files: DataFrame) -> DataFrame:
        """Positions with a bound, moved to the first record that meets it: per shard, the
        index names the file and that file alone is opened. Without one they move to the end."""
        last = _meets(F.col("how"), F.col("bound"), F.col("last_ts_us"), F.col("last_key"))
        ahead = files.join(seeking, SHARD_KEYS).where((F.col("start") + F.col("rows") > F.col("next")) & last)
        first = ahead.groupBy(*SHARD_KEYS, "how", "bound").agg(
            F.min_by("file", "start").alias("file"), F.min("start").alias("start")
        )
        first = written(first, "opening")
        found, _ = self._rows(first)
        arrived = F.unix_micros("arrival_ts")
        at = found.where(_meets(F.col("how"), F.col("bound"), arrived, F.col("seq_key")))
        at = at.groupBy(*SHARD_KEYS).agg(F.min("idx").alias("at"))
        moved = seeking.join(at, SHARD_KEYS, "left")
        met = F.col("at").isNotNull()
        none = F.lit(None).cast("string")
        return moved.select(
            *SHARD_KEYS, F.coalesce("at", "end").alias("next"),
            F.when(met, none).otherwise(F.col("how")).alias("how"),
            F.when(met, none).otherwise(F.col("bound")).alias("bound"), "end",
        )

    def _waiting(self, source: LogStream, read: DataFrame) -> DataFrame | None:
        """Shards with a listed parent that is open, or not read to its end."""
        if not source.shards:
            return None
        listed = self.spark.read.parquet(source.shards).where(F.col("stream") == source.stream)
        behind = read.where(F.col("next") < F.col("end")).select(*SHARD_KEYS, F.lit(True).alias("behind"))
        parents = listed.select(*SHARD_KEYS, is_closed().alias("closed")).join(behind, SHARD_KEYS, "left")
        unread = parents.where(~F.col("closed") | F.col("behind")).select(
            "stream", F.col("shard_id").alias("parent_id")
        )
        return parent_edges(listed).join(unread, ["stream", "parent_id"], "left_semi").select(*SHARD_KEYS).distinct()

    def _plan(self, source: LogStream, files: DataFrame, late: bool) -> DataFrame:
        """How far each shard is read in this poll: positions with ``stop``."""
        files = files.where(F.col("stream") == source.stream)
        # Trimmed records keep their numbers; a shard opens behind them.
        trimmed = F.coalesce(F.sum(F.when(F.col("file").isNull(), F.col("rows"))), F.lit(0))
        ends = files.groupBy(*SHARD_KEYS).agg(F.sum("rows").alias("end"), trimmed.alias("trimmed"))
        known = ends.join(self.positions(), SHARD_KEYS, "left")
        old = known.where(F.col("next").isNotNull()).select(*SHARD_KEYS, "next", "how", "bound", "end")
        fresh = self._opened(source, known.where(F.col("next").isNull()).select(*SHARD_KEYS, "end", "trimmed"), late)
        every = written(old.unionByName(fresh), "shards")
        seeking = every.where(F.col("how").isNotNull())
        placed = written(
            every.where(F.col("how").isNull()).unionByName(self._looked_up(seeking, files)), "placed"
        )
        stop = F.col("end")
        if source.max_records is not None:
            stop = F.least(stop, F.col("next") + source.max_records)
        waiting = self._waiting(source, placed)
        if waiting is not None:
            placed = placed.join(waiting.withColumn("_held", F.lit(True)), SHARD_KEYS, "left")
            stop = F.when(F.col("_held"), F.col("next")).otherwise(stop)
        # A shard whose opening record has not come yet reads nothing.
        stop = F.when(F.col("how").isNull(), stop).otherwise(F.col("next"))
        planned = placed.withColumn("stop", stop).select(*_PLAN.fieldNames())
        before = self.positions().select(*SHARD_KEYS, F.col("next").alias("_next"), F.col("how").alias("_how"))
        moved = planned.join(before, SHARD_KEYS, "left")
        return moved.where(
            F.col("_next").isNull() | (F.col("stop") != F.col("_next")) | ~F.col("how").eqNullSafe(F.col("_how"))
        ).drop("_next", "_how")

    # Reading -----------------------------------------------------------------------------

    def _rows(self, selected: DataFrame) -> tuple[DataFrame, list[str]]:
        """The records of the files in ``selected`` (a stored table with ``file`` and
        ``start``) with its columns and ``idx``, and the files that are gone."""
        context = self.spark.sparkContext
        jvm, conf = context._jvm, context._jsc.hadoopConfiguration()
        there, gone = [], []
        for row in selected.select("file").where("file is not null").distinct().toLocalIterator():
            file = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.file))
            (there if file.getFileSystem(conf).exists(file) else gone).append((row.file, file.toString()))
        stored = [f for f in LOG_SCHEMA.fields if f.name not in ("segment", *SHARD_KEYS)]
        read = self.spark.read.schema(T.StructType(stored))
        if there:
            files = read.option("ignoreMissingFiles", "true").parquet(*[path for _, path in there])
        else:
            none = F.lit(None).cast("struct<file_path:string,row_index:bigint>")
            files = self.spark.createDataFrame([], T.StructType(stored)).withColumn("_metadata", none)
        placed = files.select(
            *[f.name for f in stored], F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("_row")
        )
        joined = placed.join(selected, "file").withColumn("idx", F.col("start") + F.col("_row"))
        return joined.drop("file", "_row"), [name for name, _ in gone]

    def _records(self, plan: DataFrame, files: DataFrame) -> DataFrame:
        """The records between the positions and the stops of a plan; a file that was trimmed
        past retention arrives as an error item."""
        spans = plan.where(F.col("next") < F.col("stop")).select(*SHARD_KEYS, "next", "stop")
        touched = files.join(spans, SHARD_KEYS).where(
            (F.col("start") < F.col("stop")) & (F.col("start") + F.col("rows") > F.col("next"))
        )
        selected = written(touched.select(*SHARD_KEYS, "file", "start", "next", "stop"), "selected")
        rows, gone = self._rows(selected)
        kept = rows.where((F.col("idx") >= F.col("next")) & (F.col("idx") < F.col("stop")))
        names = [part.split()[0] for part in RECORD_DDL.split(", ")]
        records = kept.withColumn("error", F.lit(None).cast("string")).select(*names)
        missing = self.spark.createDataFrame([(f,) for f in gone], "file string")
        lost = selected.where("file is null").unionByName(selected.join(missing, "file", "left_semi"), allowMissingColumns=True)
        item = {"idx": F.greatest("start", "next"), "error": F.lit(errors.READ)}
        kinds = dict(part.split() for part in RECORD_DDL.split(", "))
        rest = {n: F.lit(None).cast(kinds[n]) for n in names if n not in (*SHARD_KEYS, *item)}
        return records.unionByName(lost.withColumns(item).withColumns(rest).select(*names))

    # Polls -------------------------------------------------------------------------------

    def poll(self, handle: Callable[[DataFrame, int], None]) -> bool:
        """Hands what is new to ``handle`` (records, number of the poll); false if nothing is.

        The positions move on once ``handle`` returns. If it fails, the next poll hands over
        the same records under the same number.
        """
        done = self._kept.last_batch()
        number = 0 if done is None else done + 1
        place = f"{self.state}/plan/poll={number}"
        context = self.spark.sparkContext
        marker = context._jvm.org.apache.hadoop.fs.Path(f"{place}/_SUCCESS")
        if newest_segment(self.spark, self.path) is None:
            return False
        files = log_files(self.spark, self.path)
        if not marker.getFileSystem(context._jsc.hadoopConfiguration()).exists(marker):
            plans = [self._plan(source, files, done is not None) for source in self.sources]
            reduce(DataFrame.unionByName, plans).write.mode("overwrite").parquet(place)
        plan = self.spark.read.schema(_PLAN).parquet(place)
        if plan.isEmpty():
            marker.getFileSystem(context._jsc.hadoopConfiguration()).delete(marker.getParent(), True)
            return False
        handle(self._records(plan, files), number)
        moved = plan.withColumn("next", F.col("stop")).select(*POSITIONS.fieldNames())
        self._kept.apply(moved, "reader", number)
        return True

    def run(self, handle: Callable[[DataFrame, int], None], polls: int | None = None) -> int:
        """Polls until nothing is new, or ``polls`` times; returns how often something was.

        A reader with a cap, or one that holds children back, needs several polls to come to
        the end; a poll may move on without delivering a row.
        """
        count = 0
        while (polls is None or count < polls) and self.poll(handle):
            count += 1
        return count

    def to_parquet(self, path: str, make: Callable[[DataFrame], DataFrame] = lambda rows: rows) -> Callable:
        """A handler that stores what ``make`` makes of each poll, one folder per poll; a poll
        that is repeated replaces its own."""

        def store(rows: DataFrame, number: int) -> None:
            make(rows).write.mode("overwrite").parquet(f"{path}/poll={number}")

        return store



def subscribe(spark: SparkSession, path: str, source: LogStream | str, state: str) -> Reader:
    """A reader of one stream of the log at ``path``, by descriptor or bare name."""
    return subscribe_all(spark, path, [source], state)


def subscribe_all(spark: SparkSession, path: str, sources: Sequence[LogStream | str], state: str) -> Reader:
    """One reader of several streams, told apart by the ``stream`` column."""
    return Reader(spark, path, [LogStream(s) if isinstance(s, str) else s for s in sources], state)
