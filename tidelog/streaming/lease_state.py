"""Leases of a running subscription: fenced checkpoint writes, and alerts from timers.

The lease of a shard is state, so a checkpoint write is judged by the lease in force when it
arrives, and a refused write is a row rather than an error. A watch keeps one timer per heartbeat
that is due and one per lease that runs out, so both are told when they happen and not when the
next command shows them.

The commands a shard sends in one micro-batch are put in order in its task; the source's cap on
records per shard and micro-batch bounds them.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.leases import ACQUIRE, CHECKPOINT, RELEASE, RENEW
from tidelog.operators.settlement import last_writes
from tidelog.schema import LEASE_TTL_MS, RENEW_EVERY_MS, SHARD_KEYS
from tidelog.streaming.snapshot import run_of
from tidelog.streaming.tracker import _SHARD, checkpoint_table


@dataclass
class Lease:
    owner: str | None = None
    expires_ms: int | None = None

    def allows(self, op: str, who: str | None, now: int, strict: bool) -> bool:
        """Whether a command by ``who`` takes effect under this lease."""
        if op == ACQUIRE and self.owner != who:
            running = self.expires_ms is not None and self.expires_ms >= now + (not strict)
            return self.owner is None or not running
        return op == ACQUIRE or (self.owner is not None and self.owner == who)

    def take(self, op: str, who: str | None, now: int, ttl: int) -> None:
        if op == RELEASE:
            self.owner, self.expires_ms = None, None
        elif op in (ACQUIRE, RENEW):
            self.owner, self.expires_ms = who, now + ttl


_LEASE = T.StructType(
    [
        T.StructField("owner", T.StringType()),
        T.StructField("expires_ms", T.LongType()),
        T.StructField("checkpoint", T.StringType()),
    ]
)
_WRITE = T.StructType(
    [
        *_SHARD,
        T.StructField("n", T.LongType()),
        T.StructField("owner", T.StringType()),
        T.StructField("sequence", T.StringType()),
        T.StructField("accepted", T.BooleanType()),
        T.StructField("checkpoint_after", T.StringType()),
    ]
)


class FencedWrites(StatefulProcessor):
    """Per shard: the lease and the checkpoint it guards."""

    def __init__(self, strict: bool) -> None:
        self._strict = strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._state = handle.getValueState("lease", _LEASE)

    def handleInputRows(self, key, rows, timerValues):
        lease, checkpoint = Lease(), None
        if self._state.exists():
            lease.owner, lease.expires_ms, checkpoint = self._state.get()
        for row in sorted(rows, key=lambda r: r.n):
            accepted = lease.allows(row.op, row.owner, row.t_ms, self._strict)
            if row.op != CHECKPOINT:
                if accepted:
                    lease.take(row.op, row.owner, row.t_ms, row.ttl_ms)
                continue
            if accepted:
                checkpoint = row.sequence
            yield Row(
                stream=key[0], shard_id=key[1], n=row.n, owner=row.owner, sequence=row.sequence,
                accepted=accepted, checkpoint_after=checkpoint,
            )
        self._state.update((lease.owner, lease.expires_ms, checkpoint))

    def close(self) -> None:
        pass


def _commands(commands: DataFrame, *ops: str) -> DataFrame:
    ttl = F.coalesce("ttl_ms", F.lit(0)).cast("long").alias("ttl_ms")
    return commands.where(F.col("op").isin(*ops)).select(
        *SHARD_KEYS, "n", "t_ms", "owner", "op", ttl, "sequence"
    )


def fenced_writes(commands: DataFrame, *, strict_expiry: bool = False) -> DataFrame:
    """Every checkpoint write of a stream of lease commands with its verdict.

    Rows (stream, shard_id, n, owner, sequence, accepted, checkpoint_after), as
    ``leases.checkpoint_writes`` gives them for a table. Micro-batches follow ``n``; inside
    one, commands come in any order.
    """
    rows = _commands(commands, ACQUIRE, RENEW, RELEASE, CHECKPOINT)
    return rows.groupBy(*SHARD_KEYS).transformWithState(FencedWrites(strict_expiry), _WRITE, "Append", "None")


def keep_fenced(commands: DataFrame, path: str, writes_path: str, **how) -> DataStreamWriter:
    """Maintains the checkpoint table from accepted writes only, and stores every verdict.

    Verdicts land in ``writes_path``, one folder per run of the query and micro-batch; a
    repeated batch replaces its own.
    """

    def upkeep(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_of(spark)
        folder = f"{writes_path}/run={run}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(folder)
        accepted = spark.read.schema(_WRITE).parquet(folder).where("accepted")
        writes = accepted.select(*SHARD_KEYS, F.col("sequence").alias("checkpoint"), F.col("n").alias("write_ord"))
        checkpoint_table(spark, path).apply(last_writes(writes), run, batch_id)

    return fenced_writes(commands, **how).writeStream.foreachBatch(upkeep)


# What a watch tells.
BEGUN, ENDED, LATE, OVERDUE, LAPSED = "begun", "ended", "late", "overdue", "lapsed"
_HELD = T.StructType(
    [
        T.StructField("owner", T.StringType()),
        T.StructField("expires_ms", T.LongType()),
        T.StructField("from_n", T.LongType()),
        T.StructField("from_ms", T.LongType()),
        T.StructField("beat_n", T.LongType()),
        T.StructField("beat_ms", T.LongType()),
        T.StructField("overdue_told", T.BooleanType()),
        T.StructField("lapsed_told", T.BooleanType()),
    ]
)
_NOTICE = T.StructType(
    [
        *_SHARD,
        T.StructField("kind", T.StringType()),
        T.StructField("owner", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("since_ms", T.LongType()),
        T.StructField("at_ms", T.LongType()),
        T.StructField("lapsed_ms", T.LongType()),
    ]
)


class LeaseWatch(StatefulProcessor):
    """Per shard: the tenure in force, its last heartbeat, and what was told of it."""

    def __init__(self, cadence_ms: int, strict: bool) -> None:
        self._cadence = cadence_ms
        self._strict = strict

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._state = handle.getValueState("held", _HELD)

    def _read(self, key) -> None:
        self._key = key
        self._lease, self._begun, self._beat, self._told = Lease(), (None, None), (None, None), [False, False]
        if self._state.exists():
            owner, expires, *rest = self._state.get()
            self._lease = Lease(owner, expires)
            self._begun, self._beat, self._told = tuple(rest[:2]), tuple(rest[2:4]), list(rest[4:])

    def _keep(self) -> None:
        if self._lease.owner is None:
            self._state.clear()
        else:
            self._state.update((self._lease.owner, self._lease.expires_ms, *self._begun, *self._beat, *self._told))

    def _notice(self, kind: str, n: int, since: int, at: int | None, lapsed: int | None = None) -> Row:
        return Row(
            stream=self._key[0], shard_id=self._key[1], kind=kind, owner=self._lease.owner, n=n,
            since_ms=since, at_ms=at, lapsed_ms=lapsed,
        )

    def _due(self) -> list[int]:
        """When the next heartbeat is overdue, and when the lease runs out."""
        return [self._beat[1] + self._cadence, self._lease.expires_ms]

    def _alerts(self, now: int):
        """Tells what fell due before ``now`` and was not told yet."""
        if self._lease.owner is None:
            return
        for i, (kind, due) in enumerate(zip((OVERDUE, LAPSED), self._due(), strict=True)):
            if due < now and not self._told[i]:
                self._told[i] = True
                yield self._notice(kind, *self._beat, due)

    def _set_timers(self, wanted: set[int]) -> None:
        held = set(self._handle.listTimers())
        for due in held - wanted:
            self._handle.deleteTimer(due)
        for due in wanted - held:
            self._handle.registerTimer(due)

    def handleInputRows(self, key, rows, timerValues):
        self._read(key)
        for row in sorted(rows, key=lambda r: r.n):
            yield from self._alerts(row.t_ms)
            lease, who, now = self._lease, row.owner, row.t_ms
            if not lease.allows(row.op, who, now, self._strict):
                continue
            stays = row.op != RELEASE and lease.owner == who
            if stays and now - self._beat[1] > self._cadence:
                yield self._notice(LATE, row.n, self._beat[1], now)
            if lease.owner is not None and not stays:
                lapsed = lease.expires_ms if lease.expires_ms < now else None
                yield self._notice(ENDED, *self._begun, now, lapsed)
            lease.take(row.op, who, now, row.ttl_ms)
            if row.op != RELEASE:
                self._beat, self._told = (row.n, now), [False, False]
                if not stays:
                    self._begun = (row.n, now)
                    yield self._notice(BEGUN, row.n, now, None)
        open_ = [] if self._lease.owner is None else zip(self._due(), self._told, strict=True)
        self._set_timers({due for due, told in open_ if not told})
        self._keep()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self._read(key)
        yield from self._alerts(expiredTimerInfo.getExpiryTimeInMs() + 1)
        self._keep()

    def close(self) -> None:
        pass


def watch_leases(
    commands: DataFrame,
    *,
    cadence_ms: int = RENEW_EVERY_MS,
    strict_expiry: bool = False,
    lateness: str = "0 seconds",
) -> DataFrame:
    """Notices from a stream of lease commands: (stream, shard_id, kind, owner, n, since_ms,
    at_ms, lapsed_ms).

    ``begun`` and ``ended`` tell tenures: ``n`` and ``since_ms`` are the command that began
    it, ``at_ms`` its end and ``lapsed_ms`` when the lease had run out by then. ``late`` is a
    heartbeat ``n`` at ``at_ms``, more than the cadence after the one at ``since_ms``.
    ``overdue`` (no heartbeat came) and ``lapsed`` (the lease ran out) are alerts about the
    heartbeat ``n`` at ``since_ms``, once each, told by a timer at ``at_ms`` even if no further
    command comes. Time is that of the commands: it stands ``lateness`` behind the newest, and
    commands further behind are dropped.
    """
    clock = _commands(commands, ACQUIRE, RENEW, RELEASE).withColumn("at", F.timestamp_millis("t_ms"))
    rows = clock.withWatermark("at", lateness)
    return rows.groupBy(*SHARD_KEYS).transformWithState(
        LeaseWatch(cadence_ms, strict_expiry), _NOTICE, "Append", "EventTime"
    )


def notices_past_ttl(notices: DataFrame, ttl_ms: int = LEASE_TTL_MS) -> DataFrame:
    """Late heartbeats as ``leases.renewal_gaps`` reports them."""
    gap = F.col("at_ms") - F.col("since_ms")
    return notices.where(F.col("kind") == LATE).select(
        *SHARD_KEYS, "owner", "n", F.col("since_ms").alias("previous_ms"), F.col("at_ms").alias("t_ms"),
        gap.alias("gap_ms"), (gap > ttl_ms).alias("past_ttl"),
    )


def tenures(notices: DataFrame) -> DataFrame:
    """Tenures as ``leases.ownership`` reports them: what began, with its end where told."""
    keys = [*SHARD_KEYS, "owner", "n", "since_ms"]
    told = notices.where(F.col("kind").isin(BEGUN, ENDED))
    return told.groupBy(*keys).agg(F.max("at_ms").alias("to_ms"), F.max("lapsed_ms").alias("lapsed_ms")).select(
        *SHARD_KEYS, "owner", F.col("n").alias("from_n"), F.col("since_ms").alias("from_ms"), "to_ms", "lapsed_ms"
    )
