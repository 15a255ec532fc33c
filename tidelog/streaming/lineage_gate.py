"""Children released by finished parents, as shards are listed and checkpoints come in.

State is kept per parent: what is known of it and which children wait for it. When it is done it
wakes them, and each child counts its parents until none is left. Shards share slots of the state
(``streaming.paged``). Nothing reads the lineage as a whole, and a micro-batch touches the pages of
the shards it names and of the children they wake.
"""

from __future__ import annotations

from collections import namedtuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidelog.operators.lineage import is_closed
from tidelog.schema import SHARD_END, SHARD_KEYS
from tidelog.streaming import paged
from tidelog.streaming.tracker import _SHARD

_WAKE = T.StructType(
    [*_SHARD, T.StructField("parent_id", T.StringType()), T.StructField("parents", T.IntegerType())]
)
_SHARD_ARROW = pa.schema([("stream", pa.string()), ("shard_id", pa.string())])
_WAKE_ARROW = pa.schema([*_SHARD_ARROW, ("parent_id", pa.string()), ("parents", pa.int32())])
_NEW = (False, False, None, False, False)

HELD = 1_000  # children of a parent kept in memory until it is known whether it is done

Wake = namedtuple("Wake", _WAKE.names)
Shard = namedtuple("Shard", _SHARD_ARROW.names)


class ParentGate:
    """A parent: whether it is done, and the children that wait for it.

    ``state`` holds (listed, closed, checkpoint, done, waiting), ``children`` a map of children to
    the number of their parents.
    """

    def __init__(self, from_tip: bool, state=None, children=None) -> None:
        self._from_tip = from_tip
        self._state, self._children = state, children

    def begin(self) -> None:
        self._known = self._state.get() or _NEW
        self._listed, self._closed, self._checkpoint, self._done, self._waiting = self._known
        self._held: list[tuple] = []

    def told(self, child, parents, closed, checkpoint) -> bool:
        """Takes a row; whether it names a child that need not wait."""
        if child is None:
            if checkpoint is not None:
                self._checkpoint = checkpoint
            else:
                self._listed, self._closed = True, self._closed or closed
        elif self._done:  # a parent that is done stays so: its children need no place in the state
            return True
        elif len(self._held) < HELD:
            self._held.append((child, parents))
        else:
            self._waiting = True
            self._children.updateValue((child,), (parents,))
        return False

    def end(self):
        """Children (child, parents) that wake at the end of a micro-batch."""
        listed, closed, checkpoint = self._listed, self._closed, self._checkpoint
        skipped = checkpoint is None and closed and self._from_tip
        done = self._done or checkpoint == SHARD_END or skipped or not listed
        if done:
            yield from self._held
            if self._waiting:
                for (child,), (count,) in self._children.iterator():
                    yield child, count
                self._children.clear()
        else:
            for child, count in self._held:
                self._children.updateValue((child,), (count,))
        now = (listed, closed, checkpoint, done and listed, not done and (self._waiting or bool(self._held)))
        if now != self._known:
            self._state.update(now)

    def handleInputRows(self, key, rows, timerValues):
        self.begin()
        for row in rows:
            if self.told(row.child, row.parents, row.closed, row.checkpoint):
                yield Wake(key[0], row.child, key[1], row.parents)
        for child, count in self.end():
            yield Wake(key[0], child, key[1], count)


class ChildGate:
    """A child: the parents that are done, until it is released."""

    def __init__(self, done=None, released=None) -> None:
        self._done, self._released = done, released

    def handleInputRows(self, key, rows, timerValues):
        if self._released.exists():
            return
        needed, parents = 0, set()
        for row in rows:
            needed = row.parents
            parents.add(row.parent_id)
        # two parents at most; only one that came alone is kept until the other is done
        if len(parents) < needed:
            for parent in parents:
                self._done.updateValue((parent,), (1,))
            if sum(1 for _ in self._done.keys()) < needed:
                return
            self._done.clear()
        self._released.update((True,))
        yield Shard(*key)


class _Value:
    """A value that a slot keeps."""

    def __init__(self, value) -> None:
        self.value, self.changed = value, False

    def get(self):
        return self.value

    def exists(self) -> bool:
        return self.value is not None

    def update(self, value) -> None:
        self.value, self.changed = value, True


class _Map:
    """A map that a slot keeps: the first entries beside the value, further ones in pages."""

    def __init__(self, first: dict | None, pages: paged.Pages | None = None) -> None:
        self.first, self.pages, self.changed = first, pages, False

    def updateValue(self, key, value) -> None:
        self.changed = True
        if self.first is None:
            self.first = {}
        if self.pages is None or len(self.first) < HELD or key[0] in self.first:
            self.first[key[0]] = value[0]
        else:
            self.pages.put(key[0], value[0])

    def iterator(self):
        for key, value in [*(self.first or {}).items()]:
            yield (key,), (value,)
        if self.pages is not None and self.pages.count:
            for key, value in self.pages.items():
                yield (key,), (value,)

    def keys(self):
        return (key for key, _ in self.iterator())

    def clear(self) -> None:
        self.first, self.changed = None, True
        if self.pages is not None:
            self.pages.clear()


class ParentSlot(StatefulProcessor):
    """The parents of a slot."""

    def __init__(self, from_tip: bool) -> None:
        self._from_tip = from_tip

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._slot = paged.Slot(handle)

    def handleInputRows(self, key, rows, timerValues):
        entries, gates, out = self._slot.entries(), {}, paged.Packer(_WAKE_ARROW)
        for row in rows:
            for stream, parent, child, parents, closed, checkpoint in paged.rows(row.packed):
                gate = gates.get((stream, parent))
                if gate is None:
                    state, first, size = entries.get((stream, parent)) or (None, None, (0, 0))
                    further = paged.Pages(self._slot.pages, repr((stream, parent)), *size)
                    gate = gates[stream, parent] = ParentGate(self._from_tip, _Value(state), _Map(first, further))
                    gate.begin()
                if gate.told(child, parents, closed, checkpoint):
                    yield from out.add((stream, child, parent, parents))
        for (stream, parent), gate in gates.items():
            for child, parents in gate.end():
                yield from out.add((stream, child, parent, parents))
            state, children = gate._state, gate._children
            if state.changed or children.changed:
                children.pages.flush()
                entries.put((stream, parent), (state.value, children.first, children.pages.size))
        self._slot.keep(entries)
        yield from out.rest()

    def close(self) -> None:
        pass


class ChildSlot(StatefulProcessor):
    """The children of a slot."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._slot = paged.Slot(handle)

    def handleInputRows(self, key, rows, timerValues):
        entries, woken, out = self._slot.entries(), {}, paged.Packer(_SHARD_ARROW)
        for row in rows:
            for wake in paged.rows(row.packed):
                woken.setdefault(wake[:2], []).append(Wake(*wake))
        for shard, wakes in woken.items():
            released, done = entries.get(shard) or (None, None)
            gate = ChildGate(_Map(done), _Value(released))
            for found in gate.handleInputRows(shard, wakes, timerValues):
                yield from out.add(found)
            if gate._released.changed or gate._done.changed:
                entries.put(shard, (gate._released.value, gate._done.first))
        self._slot.keep(entries)
        yield from out.rest()

    def close(self) -> None:
        pass


def events(shards: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """One stream keyed by parent, from a stream of listed shards (``schema.SHARD``) and one of
    checkpoints (``schema.CHECKPOINT``)."""
    text, flag, whole = (F.lit(None).cast(kind) for kind in ("string", "boolean", "int"))
    parents = F.array_distinct(F.array_compact(F.array("parent_id", "adjacent_parent_id")))
    known = shards.withColumn("_parents", parents)
    # A shard without parents waits for none: its row says so.
    named = F.when(F.size("_parents") > 0, F.col("_parents")).otherwise(F.array("shard_id"))
    edges = known.select(
        "stream", F.explode(named).alias("parent_id"), F.col("shard_id").alias("child"),
        F.size("_parents").alias("parents"), flag.alias("closed"), text.alias("checkpoint"),
    )
    listed = known.select(
        "stream", F.col("shard_id").alias("parent_id"), text.alias("child"), whole.alias("parents"),
        is_closed().alias("closed"), text.alias("checkpoint"),
    )
    points = checkpoints.where(F.col("checkpoint").isNotNull()).select(
        "stream", F.col("shard_id").alias("parent_id"), text.alias("child"), whole.alias("parents"),
        flag.alias("closed"), "checkpoint",
    )
    return edges.unionByName(listed).unionByName(points)


def release(happened: DataFrame, *, from_tip: bool = True) -> DataFrame:
    """Shards (stream, shard_id) as their last parent is done, each once, from :func:`events`.

    A parent is done at ``SHARD_END``, and also when it is closed without a checkpoint while
    its stream is read ``from_tip``. A parent that is not listed by the time its child is was
    trimmed, and holds nothing back. What was released stays released.
    """
    roots = F.coalesce(F.col("parents") == 0, F.lit(False))
    waiting = happened.where(~roots).select("stream", "parent_id", "child", "parents", "closed", "checkpoint")
    parents = paged.in_slots(waiting, "stream", "parent_id").groupBy("slot")
    waking = paged.unpacked(parents.transformWithState(ParentSlot(from_tip), paged.PACKED, "Append", "None"), _WAKE)
    free = happened.where(roots).select("stream", F.col("child").alias("shard_id"))
    children = paged.in_slots(waking, *SHARD_KEYS).groupBy("slot")
    woken = children.transformWithState(ChildSlot(), paged.PACKED, "Append", "None")
    return paged.unpacked(woken, T.StructType(_SHARD)).unionByName(free)
