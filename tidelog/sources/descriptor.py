"""What to read: the description of one subscription, checked before any input is touched."""

from __future__ import annotations

from dataclasses import dataclass, replace

from tidelog.functions import positions as P
from tidelog.functions.errors import LogError
from tidelog.schema import DEFAULT_BATCH, MAX_BATCH

RESUME = "resume"


@dataclass(frozen=True)
class LogStream:
    """A named stream of a log, and how it is read.

    ``batch`` is the number of records per read call; Spark sizes its reads itself, and the
    number is checked only. ``max_records`` bounds what one poll takes from a shard. ``checkpoints`` and ``shards`` are paths of parquet
    tables: stored checkpoints to resume from, and shard lineage that holds children back
    until their parents are read. Without a position every shard resumes from its checkpoint,
    and a shard without one starts at the tip.
    """

    stream: str
    batch: int = DEFAULT_BATCH
    max_records: int | None = None
    checkpoints: str | None = None
    shards: str | None = None
    kind: str = RESUME
    ts_ms: int | None = None
    shard_id: str | None = None
    sequence: str | None = None

    def start_at(self, kind: str, **where) -> LogStream:
        """The same stream from a position: see ``functions.positions`` for the kinds."""
        return replace(self, kind=kind, **where)

    def validate(self) -> LogStream:
        if not self.stream:
            raise LogError("a stream needs a name")
        if not 1 <= self.batch <= MAX_BATCH:
            raise LogError(f"a read call takes from 1 to {MAX_BATCH} records")
        if self.max_records is not None and self.max_records < 1:
            raise LogError("max_records must be at least 1")
        if self.kind not in (RESUME, *P.STREAM_WIDE, P.SEQUENCE):
            raise LogError(f"unknown position {self.kind!r}")
        if self.kind == P.TIMESTAMP and (self.ts_ms is None or self.ts_ms < 0):
            raise LogError("a timestamp position needs ts_ms")
        if self.kind == P.SEQUENCE and not (self.shard_id and self.sequence):
            raise LogError("a sequence position needs a shard and a sequence number")
        return self
