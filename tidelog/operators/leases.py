"""Replay and audit of lease ledgers: who held which shard, and whose writes were refused.

A ledger is a table of commands (see ``schema.LEASE_COMMAND``) ordered by ``n`` per shard. It is
cut into blocks that are replayed side by side. Replaying is sequential by nature, since each
verdict depends on the lease before it, and a shard that spans blocks needs the lease that its
next block starts from. A lease is fully known again as soon as one command takes effect, so a
block can say, without knowing the lease it starts from, which lease it ends with for every lease
it might start from: once per owner seen in it, and once per instant at which an expired lease
would be taken over, as far as an earlier lease can run. These summaries are made and chained for
the shards that span blocks only, two of a block at most.

Only commands that can change a lease are folded one by one. Reads and checkpoint writes are
answered from the lease that the command before them left.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelog.plans.prefix import Scan, edges, in_blocks, match, prefix
from tidelog.plans.scratch import written
from tidelog.schema import LEASE_TTL_MS, RENEW_EVERY_MS, SHARD_KEYS

# Fixed command names.
ACQUIRE = "acquire"
RENEW = "renew"
CHECKPOINT = "checkpoint"
READ = "read"
RELEASE = "release"
# The row that carries a shard's lease into a ledger.
STATE = "state"

_MUTATING = (ACQUIRE, RENEW, RELEASE)
_BLOCK_KEYS = [*SHARD_KEYS, "_block"]
_COMMAND = [*SHARD_KEYS, "n", "t_ms", "owner", "op", "ttl_ms", "sequence"]
_LEASE = ["_owner", "_expires", "_checkpoint", "_counter"]
_COMMAND_DDL = (
    "stream string, shard_id string, n long, t_ms long, owner string, op string, "
    "ttl_ms long, sequence string"
)
_VERDICT_DDL = (
    ", ok boolean, owner_before string, expires_before long, owner_after string, "
    "expires_after long, checkpoint_after string, counter_after long"
)
_SUMMARY_DDL = (
    "stream string, shard_id string, _block int, kind string, owner string, at long, "
    "t_ms long, exit_owner string, exit_expires long"
)
_START_DDL = "stream string, shard_id string, _block int, owner string, expires_ms long"


def _in_order(
    table: DataFrame, keys: list[str], order: list[Column], fold: Callable, ddl: str
) -> DataFrame:
    """Streams each partition through ``fold``, its keys together and each key in order.

    Nothing but the running state of one key is held, whatever the size of the key.
    """
    return table.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(fold, ddl)


def _rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _batches(rows: Iterator[tuple], names: list[str], size: int = 10_000) -> Iterator[pa.RecordBatch]:
    """Rows to record batches; every column is text or a whole number."""
    whole = {"_block": pa.int32(), "at": pa.int64(), "t_ms": pa.int64()}
    whole |= dict.fromkeys(("exit_expires", "expires_ms"), pa.int64())
    pending: list[tuple] = []

    def batch() -> pa.RecordBatch:
        columns = zip(*pending, strict=True)
        arrays = [pa.array(c, whole.get(n, pa.string())) for n, c in zip(names, columns, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    for row in rows:
        pending.append(row)
        if len(pending) == size:
            yield batch()
            pending = []
    if pending:
        yield batch()


def _replay(batches: Iterator[pa.RecordBatch], strict: bool) -> Iterator[pa.RecordBatch]:
    """Verdict of each command; rows come by shard, in order.

    A shard starts from the lease its first row carries. What is folded row by row are the
    rows that can change a lease and the first row of each shard; the rest follows from the
    last of these.
    """
    last: tuple = ()  # shard, and owner, expiry, checkpoint and counter after its last row
    for batch in batches:
        data = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in _COMMAND}
        starts = [batch.column(c).to_pylist() for c in _LEASE]
        op, who, now, ttl = (data[c] for c in ("op", "owner", "t_ms", "ttl_ms"))
        rows = np.arange(batch.num_rows)
        shard = [data[c] for c in SHARD_KEYS]
        begins = np.ones(len(rows), bool)
        begins[1:] = np.any([c[1:] != c[:-1] for c in shard], axis=0)
        begins[0] = tuple(c[0] for c in shard) != (last and last[0])
        changes = np.isin(op, [*_MUTATING, STATE])

        # Rows with a state of their own: (owner, expiry) before and after.
        stops = np.flatnonzero(begins | changes | (rows == 0))
        before, after = np.empty((2, len(stops)), object), np.empty((2, len(stops)), object)
        ok = np.ones(len(rows), bool)
        owner, expires = last[1:3] if last else (None, None)
        for at, row in enumerate(stops):
            if begins[row]:
                owner, expires = starts[0][row], starts[1][row]
            before[:, at] = owner, expires
            kind, caller, t = op[row], who[row], int(now[row])
            if kind == STATE:
                owner, expires = caller, starts[1][row]
            elif kind in _MUTATING:
                if kind == ACQUIRE:
                    alive = expires is not None and (expires >= t if strict else expires > t)
                    ok[row] = owner is None or owner == caller or not alive
                else:
                    ok[row] = owner is not None and owner == caller
                if ok[row]:
                    owner, expires = (None, None) if kind == RELEASE else (caller, t + int(ttl[row]))
            after[:, at] = owner, expires

        stop = np.searchsorted(stops, rows, side="right") - 1
        own = stops[stop] == rows
        owner_after, expires_after = after[0][stop], after[1][stop]
        owner_before = np.where(own, before[0][stop], owner_after)
        expires_before = np.where(own, before[1][stop], expires_after)
        writes = op == CHECKPOINT
        ok[writes] = (owner_after[writes] == who[writes]) & np.array([o is not None for o in owner_after[writes]], bool)

        # Counter and checkpoint run on from the first row of the shard.
        first = np.maximum.accumulate(np.where(begins, rows, -1))
        counted = np.cumsum(ok & ~np.isin(op, [READ, STATE]))
        base = np.array([c or 0 for c in starts[3]], np.int64) - np.append(0, counted[:-1])
        onward = last[4] if last else 0
        counter = counted + np.where(first >= 0, base[first], onward)
        source = np.where((ok & writes) | (op == STATE), rows, -1)
        source = np.maximum.accumulate(source)
        given = np.where(source >= first, data["sequence"][source], None)
        begun = np.array(starts[2], object)[first]
        begun = np.where(first >= 0, begun, last[3] if last else None)
        checkpoint = np.where((source >= 0) & (source >= first), given, begun)
        last = (tuple(c[-1] for c in shard), owner_after[-1], expires_after[-1], checkpoint[-1], counter[-1])

        columns = [ok, owner_before, expires_before, owner_after, expires_after, checkpoint, counter]
        kinds = [pa.bool_(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        passed = [*_COMMAND, "_block"]
        arrays = [batch.column(n) for n in passed]
        arrays += [pa.array(c, k, from_pandas=True) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names=[*passed, *_VERDICT_COLUMNS])


_VERDICT_COLUMNS = [part.split()[0] for part in _VERDICT_DDL[2:].split(", ")]


class _Block:
    """What a block does to every lease it could start from (see the module text).

    Fed backwards. Each command is paired with the lease at the end of the block if it takes
    effect; what takes effect next is the earlier of the owner's next command and the first
    acquire late enough to find the lease expired. ``latest`` is the last instant a lease
    from before the block can run to.
    """

    def __init__(self, strict: bool, latest: int | None) -> None:
        self.strict = strict
        self.latest = latest
        self.own: dict[str, tuple] = {}  # owner: (at, end) of its nearest command
        # Acquires that a later expiry could meet, nearest last: (at, end), and their times
        # negated, which ascend towards the nearest.
        self.taken: list[tuple] = []
        self.reach: list[int] = []

    def _take_over(self, expires: int) -> tuple | None:
        at = bisect_left(self.reach, -expires + (0 if self.strict else 1)) - 1
        return self.taken[at] if at >= 0 else None

    def feed(self, at: int, op: str, who: str, now: int, ttl: int) -> None:
        if op == RELEASE:
            lease, next_ = (None, None), self.taken[-1] if self.taken else None
        else:
            lease = (who, now + ttl)
            found = [c for c in (self.own.get(who), self._take_over(now + ttl)) if c]
            next_ = min(found, key=lambda c: c[0], default=None)
        told = (at, lease if next_ is None else next_[1])
        self.own[who] = told
        if op == ACQUIRE:
            while self.reach and -self.reach[-1] <= now:
                self.taken.pop()
                self.reach.pop()
            self.taken.append(told)
            self.reach.append(-now)

    def rows(self) -> Iterator[tuple]:
        """(kind, owner, at, t_ms, exit_owner, exit_expires)"""
        free = self.taken[-1][1] if self.taken else (None, None)
        yield ("free", None, None, None, *free)
        for who, (at, end) in self.own.items():
            yield ("own", who, at, None, *end)
        stops = sorted(at for at, _ in self.own.values())
        run: list | None = None  # acquires with the same end and no owner's command between
        for (at, end), minus in zip(reversed(self.taken), reversed(self.reach), strict=True):
            if self.latest is None or (run and run[1] > self.latest):
                break
            if run and run[2] == end and bisect_left(stops, run[0]) == bisect_left(stops, at):
                run[1] = -minus
                continue
            if run:
                yield ("expired", None, run[0], run[1], *run[2])
            run = [at, -minus, end]
        if run:
            yield ("expired", None, run[0], run[1], *run[2])


def _summarise(batches: Iterator[pa.RecordBatch], strict: bool) -> Iterator[pa.RecordBatch]:
    """Summaries of blocks whose commands come last first."""
    columns = [*_BLOCK_KEYS, "_latest", "n", "op", "owner", "t_ms", "ttl_ms"]

    def rows():
        current, block = None, None
        for *key, latest, n, op, who, now, ttl in _rows(batches, columns):
            if key != current:
                if block is not None:
                    yield from ((*current, *row) for row in block.rows())
                current, block = key, _Block(strict, latest)
            if op in _MUTATING:
                block.feed(n, op, who, now, ttl)
        if block is not None:
            yield from ((*current, *row) for row in block.rows())

    names = [*_BLOCK_KEYS, "kind", "owner", "at", "t_ms", "exit_owner", "exit_expires"]
    return _batches(rows(), names)


def _chain(batches: Iterator[pa.RecordBatch], strict: bool) -> Iterator[pa.RecordBatch]:
    """The lease each block starts from; summaries come by block, then position."""
    columns = [*_BLOCK_KEYS, "kind", "owner", "t_ms", "exit_owner", "exit_expires", "_owner", "_expires"]

    def rows():
        shard, block, hit = None, None, None
        owner = expires = None
        for stream, shard_id, number, kind, who, late, *rest in _rows(batches, columns):
            exit_, start = tuple(rest[:2]), rest[2:]
            if (stream, shard_id) != shard:
                shard, block, hit = (stream, shard_id), None, None
                owner, expires = start
            if number != block:
                if hit is not None:
                    owner, expires = hit
                block, hit = number, None
                yield (*shard, block, owner, expires)
            if hit is None:
                if owner is None:
                    met = kind == "free"
                elif kind == "own":
                    met = who == owner
                else:
                    met = kind == "expired" and (late > expires if strict else late >= expires)
                hit = exit_ if met else None

    return _batches(rows(), [*_BLOCK_KEYS, "owner", "expires_ms"])


def replay_ledger(
    commands: DataFrame,
    state: DataFrame | None = None,
    *,
    strict_expiry: bool = False,
    blocks: int | None = None,
) -> DataFrame:
    """Every command with its verdict ``ok`` and the lease before and after it.

    ``acquire`` is granted unless another owner's lease is still running; ``renew``,
    ``checkpoint`` and ``release`` need the caller to be the holder, expired or not; ``read``
    always succeeds. ``strict_expiry`` is the dialect in which a lease can be taken over only
    after its expiry instant, not at it. ``state`` (``schema.LEASE_STATE``) is the lease of
    each shard before the first command; it goes into the ledger as a row before the others.
    """
    ttl = F.coalesce("ttl_ms", F.lit(0)).cast("long").alias("ttl_ms")
    ledger = commands.select(*[ttl if c == "ttl_ms" else c for c in _COMMAND])
    ledger = ledger.withColumns({"_expires": F.lit(None).cast("long"), "_counter": F.lit(None).cast("long")})
    if state is not None:
        none = F.lit(None).cast("long")
        ledger = ledger.unionByName(
            state.select(
                *SHARD_KEYS, none.alias("n"), F.lit(0).cast("long").alias("t_ms"), "owner",
                F.lit(STATE).alias("op"), F.lit(0).cast("long").alias("ttl_ms"),
                F.col("checkpoint").alias("sequence"), F.col("expires_ms").alias("_expires"),
                F.col("counter").alias("_counter"),
            )
        )
    stored = in_blocks(ledger, SHARD_KEYS, ["n"], blocks)
    starts = written(_starts(stored, strict_expiry), "starts")
    return _verdicts(stored, starts, strict_expiry).where(F.col("op") != STATE).drop("_block")


def _verdicts(stored: DataFrame, starts: DataFrame, strict: bool) -> DataFrame:
    """Replays blocks where they lie. ``starts`` has one row per block and shard that began in
    an earlier block, at most one of a block, and so may be broadcast."""
    renamed = starts.select(*_BLOCK_KEYS, F.struct("owner", "expires_ms", "checkpoint", "counter").alias("_start"))
    renamed, condition = match(renamed, _BLOCK_KEYS)
    entered = stored.join(F.broadcast(renamed), condition, "left")
    is_state = F.col("op") == STATE
    lease = {
        "_owner": F.col("_start.owner"),
        "_expires": F.when(is_state, F.col("_expires")).otherwise(F.col("_start.expires_ms")),
        "_checkpoint": F.col("_start.checkpoint"),
        "_counter": F.when(is_state, F.col("_counter")).otherwise(F.col("_start.counter")),
    }
    rows = entered.select("_slot", "_block", *_COMMAND, *[v.alias(k) for k, v in lease.items()])

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _replay(batches, strict)

    ordered = rows.sortWithinPartitions("_slot", *SHARD_KEYS, "n")
    return ordered.groupBy("_slot").applyInArrow(replay, _COMMAND_DDL + ", _block int" + _VERDICT_DDL)


def _before_block():
    return Window.partitionBy(*SHARD_KEYS).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)


def _spanning(stored: DataFrame) -> DataFrame:
    """Blocks of the shards that lie in several: (stream, shard_id, _block, _latest).

    ``_latest`` is the last instant that a lease from before the block's commands can run to.
    """
    runs_to = F.coalesce("_expires", F.col("t_ms") + F.col("ttl_ms"))
    own = stored.groupBy(*SHARD_KEYS, "_slot", "_block").agg(
        F.max(runs_to).alias("_own"), F.max("_expires").alias("_given")
    )
    parts = F.count(F.lit(1)).over(Window.partitionBy(*SHARD_KEYS))
    latest = F.greatest(F.max("_own").over(_before_block()), F.col("_given")).alias("_latest")
    return edges(own, SHARD_KEYS).select(*_BLOCK_KEYS, latest, parts.alias("_parts")).where("_parts > 1").drop("_parts")


def _starts(stored: DataFrame, strict: bool) -> DataFrame:
    """The lease that a block starts from, for every shard that began in an earlier block."""
    spanning = written(_spanning(stored), "spanning")
    renamed, condition = match(spanning, _BLOCK_KEYS)
    rows = stored.join(F.broadcast(renamed), condition).select(*stored.columns, "_latest")
    summaries = _in_order(
        rows, _BLOCK_KEYS, [F.col("n").desc_nulls_last()], partial(_summarise, strict=strict), _SUMMARY_DDL
    )
    given = rows.where(F.col("op") == STATE).select(*SHARD_KEYS, F.col("owner").alias("_owner"), "_expires")
    chained = written(
        _in_order(
            summaries.join(given, SHARD_KEYS, "left"), SHARD_KEYS, [F.col("_block"), F.col("at")],
            partial(_chain, strict=strict), _START_DDL,
        ),
        "chained",
    )
    bare = chained.withColumns({"checkpoint": F.lit(None).cast("string"), "counter": F.lit(None).cast("long")})
    totals = _verdicts(rows.drop("_latest"), bare, strict).groupBy(*_BLOCK_KEYS).agg(
        F.max("counter_after").alias("_count"),
        F.max_by("checkpoint_after", F.struct("n")).alias("_point"),
    )
    before = _before_block()
    carried = totals.select(
        *_BLOCK_KEYS,
        F.sum("_count").over(before).alias("counter"),
        F.last("_point", ignorenulls=True).over(before).alias("checkpoint"),
        F.count(F.lit(1)).over(before).alias("_others"),
    )
    return carried.where("_others > 0").drop("_others").join(chained, _BLOCK_KEYS)


def lease_snapshot(verdicts: DataFrame) -> DataFrame:
    """The lease of each shard after its last command: what ``read`` would return."""
    last = F.max_by(
        F.struct("owner_after", "expires_after", "checkpoint_after", "counter_after"), "n"
    )
    return verdicts.groupBy(*SHARD_KEYS).agg(last.alias("s")).select(
        *SHARD_KEYS,
        F.col("s.owner_after").alias("owner"),
        F.col("s.expires_after").alias("expires_ms"),
        F.col("s.checkpoint_after").alias("checkpoint"),
        F.col("s.counter_after").alias("counter"),
    )


def fenced(verdicts: DataFrame) -> DataFrame:
    """Heartbeats and checkpoints refused because someone else, or no one, held the shard."""
    return verdicts.filter(F.col("op").isin(RENEW, CHECKPOINT) & ~F.col("ok"))


def checkpoint_writes(verdicts: DataFrame) -> DataFrame:
    """Every checkpoint write with ``accepted``; a refused write is a row, not an error."""
    return verdicts.filter(F.col("op") == CHECKPOINT).select(
        *SHARD_KEYS, "n", "owner", "sequence", F.col("ok").alias("accepted"), "checkpoint_after"
    )


def ownership(verdicts: DataFrame, **scan) -> DataFrame:
    """Tenures per shard: owner, start, and end when the shard changed hands.

    ``lapsed_ms`` is when the holder's lease ran out, if that was before the end.
    """
    changes = verdicts.filter(~F.col("owner_before").eqNullSafe(F.col("owner_after")))
    changes = written(
        changes.select(*SHARD_KEYS, "n", "t_ms", "owner_after", "expires_before"), "changes"
    )
    ended = F.struct("t_ms", "expires_before")
    tenures = prefix(
        changes, SHARD_KEYS, ["n"], {"_end": Scan("last", ended, inclusive=False)},
        reverse=True, **scan,
    )
    return tenures.filter(F.col("owner_after").isNotNull()).select(
        *SHARD_KEYS,
        F.col("owner_after").alias("owner"),
        F.col("n").alias("from_n"),
        F.col("t_ms").alias("from_ms"),
        F.col("_end.t_ms").alias("to_ms"),
        F.when(F.col("_end.expires_before") < F.col("_end.t_ms"), F.col("_end.expires_before")).alias(
            "lapsed_ms"
        ),
    )


def renewal_gaps(
    verdicts: DataFrame,
    cadence_ms: int = RENEW_EVERY_MS,
    ttl_ms: int = LEASE_TTL_MS,
    **scan,
) -> DataFrame:
    """Heartbeats of a sitting holder that came later than the cadence after the one before."""
    beats = verdicts.filter(F.col("op").isin(ACQUIRE, RENEW) & F.col("ok"))
    beats = written(beats.select(*SHARD_KEYS, "owner", "n", "t_ms", "owner_before"), "beats")
    lagged = prefix(
        beats, [*SHARD_KEYS, "owner"], ["n"],
        {"previous_ms": Scan("last", F.col("t_ms"), inclusive=False)}, **scan,
    )
    gap: Column = F.col("t_ms") - F.col("previous_ms")
    held = F.col("owner_before") == F.col("owner")
    return lagged.filter(held & (gap > cadence_ms)).select(
        *SHARD_KEYS, "owner", "n", "previous_ms", "t_ms",
        gap.alias("gap_ms"), (gap > ttl_ms).alias("past_ttl"),
    )
