"""Stateful forms: the tracker against its batch form, and tables kept by streams."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from tidelog.operators import leases
from tidelog.schema import SHARD_KEYS
from tidelog.streaming import lease_state, lineage_gate, paged, run, seek_gate, tracker
from tidelog.streaming.marker import follow_tip
from tidelog.streaming.snapshot import FOLD, Snapshot

ROW = "stream string, shard_id string, idx long, sequence_number string, outcome string"


def test_tracker_over_many_small_batches(spark, tmp_path):
    """Shuffled rows, repeated deliveries and late outcomes, with chunks of four records."""
    rng = random.Random(5)
    source, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    tracker.use_state_store(spark)
    outcome, told = {}, {}
    for step in range(4):
        rows = []
        for shard, count in (("hot", 30), ("cold", 2)):
            for i in range(count):
                idx = step * count + i
                done = rng.random() < 0.7
                outcome[shard, idx] = done
                rows.append(("s", shard, idx, str(idx * 3), "ack" if done else None))
        for shard, idx in list(outcome):
            if not outcome[shard, idx] and rng.random() < 0.6 and not (shard == "hot" and idx == 70):
                outcome[shard, idx] = True
                rows.append(("s", shard, idx, str(idx * 3), "nack_skip"))
            elif rng.random() < 0.1:
                rows.append(("s", shard, idx, str(idx * 3), None))
        rng.shuffle(rows)
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ROW).parquet(source)
        run.run_once(run.to_parquet(tracker.track_checkpoints(stream, chunk=4), out), state, 120)
        for shard in ("hot", "cold"):
            open_ = [i for (s, i), done in outcome.items() if s == shard and not done]
            last = min(open_) - 1 if open_ else max(i for s, i in outcome if s == shard)
            told[shard] = last
        reached = spark.read.parquet(out).groupBy("shard_id").agg(
            F.max_by("checkpoint", "checkpoint_idx").alias("checkpoint")
        )
        got = {r.shard_id: int(r.checkpoint) for r in reached.collect()}
        assert got == {s: i * 3 for s, i in told.items() if i >= 0}


def increments(spark, folder, batches, schema, make, timeout=120):
    """Every batch as one increment of a stream that is started anew each time."""
    source, state = f"{folder}/in", f"{folder}/state"
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        run.run_once(make(spark.readStream.schema(schema).parquet(source)), state, timeout)


def test_tracker_passes_nothing_it_has_not_seen(spark, tmp_path):
    """0 and 2 are acknowledged before 1 is seen: the checkpoint waits for 1."""
    out = str(tmp_path / "out")
    tracker.use_state_store(spark)
    reached = []

    def make(stream):
        return run.to_parquet(tracker.track_checkpoints(stream), out)

    for rows in ([("s", "a", 0, "10", "ack"), ("s", "a", 2, "12", "ack")], [("s", "a", 1, "11", None)], [("s", "a", 1, "11", "ack")]):
        increments(spark, str(tmp_path), [rows], ROW, make)
        reached.append(spark.read.parquet(out).agg(F.max("checkpoint_idx")).first()[0])
    assert reached == [0, 0, 2]


def test_tracker_keeps_gaps_only(spark, tmp_path):
    """A record that is never settled holds a thousand others back as one range; what was
    passed leaves nothing behind."""
    out = str(tmp_path / "out")
    tracker.use_state_store(spark)
    batches = []
    for lo in range(0, 1500, 500):
        rows = [("s", "a", i, str(i), "ack") for i in range(lo, lo + 500) if i not in (400, 900)]
        batches.append(rows + [("s", "b", i, str(i), "ack") for i in range(lo, lo + 500)])
    batches.append([("s", "b", 7, "7", "ack")])
    increments(spark, str(tmp_path), batches, ROW, lambda s: run.to_parquet(tracker.track_checkpoints(s, chunk=64), out))
    state = spark.read.format("statestore").option("stateVarName", "settled").load(str(tmp_path / "state"))
    kept = {r.shard: r for r in state.select(F.col("key.shard_id").alias("shard"), "value.reached", F.size("value.ahead").alias("n")).collect()}
    assert (kept["a"].reached, kept["a"].n) == (400, 2)
    assert (kept["b"].reached, kept["b"].n) == (1500, 0)


def table_of(spark, path):
    return Snapshot(spark, path, tracker.CHECKPOINT_TABLE, SHARD_KEYS)


def write(spark, table, run_id, batch, shard, checkpoint):
    row = spark.createDataFrame([("s", shard, checkpoint, batch)], tracker.CHECKPOINT_TABLE)
    table.apply(row, run_id, batch)


def held(table):
    return {r.shard_id: r.checkpoint for r in table.current().collect()}


def test_snapshot_is_the_same_after_a_repeated_batch(spark, tmp_path):
    table = table_of(spark, str(tmp_path / "t"))
    assert held(table) == {}
    for batch in (0, 1, 1, 2, 2):
        write(spark, table, "r", batch, f"shard-{batch}", "1")
    assert held(table) == {f"shard-{i}": "1" for i in range(3)}
    write(spark, table, "r", 2, "shard-0", "9")
    assert held(table) == {"shard-0": "9", "shard-1": "1"}


def test_snapshot_outlives_a_reset(spark, tmp_path):
    """A query with a new state location numbers its batches from 0 again."""
    table = table_of(spark, str(tmp_path / "t"))
    for batch in range(5):
        write(spark, table, "first", batch, f"shard-{batch}", str(batch))
    write(spark, table, "second", 0, "shard-0", "new")
    assert held(table) == {"shard-0": "new", **{f"shard-{i}": str(i) for i in range(1, 5)}}


def test_snapshot_reads_a_bounded_number_of_versions(spark, tmp_path):
    table = table_of(spark, str(tmp_path / "t"))
    for batch in range(2 * FOLD + 3):
        write(spark, table, "r", batch, f"shard-{batch % 3}", str(batch))
    assert len(table._versions()) <= FOLD + 3
    last = 2 * FOLD + 2
    assert held(table) == {f"shard-{b % 3}": str(b) for b in range(last - 2, last + 1)}


def test_checkpoint_table_of_two_runs(spark, tmp_path):
    """The run is that of the streaming query, which a new state location changes."""
    path, schema = str(tmp_path / "table"), "stream string, shard_id string, checkpoint string, at long"

    def make(stream):
        return tracker.keep_checkpoints(stream, path, "at")

    for name, point in (("one", "5"), ("two", "3")):
        (tmp_path / name).mkdir()
        increments(spark, str(tmp_path / name), [[("s", "a", point, 1), ("s", name, point, 1)]], schema, make)
    assert held(tracker.checkpoint_table(spark, path)) == {"a": "3", "one": "5", "two": "3"}


def test_seek_gate_over_small_batches(spark, tmp_path):
    """Random deliveries, outcomes and seeks against a plain replay of the same events."""
    rng = random.Random(11)
    tracker.use_state_store(spark)
    happened, pending, model, told, stale = [], [], {}, {}, {}
    for at in range(240):
        shard = rng.choice(["a", "a", "b"])
        state = model.setdefault(shard, {"epoch": 0, "base": 0, "next": 0, "done": set()})
        draw = rng.random()
        if draw < 0.06:
            happened.append(("s", shard, at, seek_gate.SEEK, None, None))
            state.update(epoch=state["epoch"] + 1, base=state["next"], done=set())
        elif draw < 0.6 or not pending:
            happened.append(("s", shard, at, seek_gate.DELIVER, state["next"], None))
            pending.append((shard, state["next"]))
            state["next"] += 1
        else:
            shard, idx = pending.pop(rng.randrange(min(2, len(pending))))
            state = model[shard]
            happened.append(("s", shard, at, seek_gate.SETTLE, idx, f"n{idx}"))
            if idx < state["base"]:
                stale[shard] = stale.get(shard, 0) + 1
                continue
            state["done"].add(idx)
            reached = state["base"]
            while reached in state["done"]:
                reached += 1
            if reached > state["base"]:
                told[shard, state["epoch"]] = f"n{reached - 1}"
    batches = [happened[i : i + 60] for i in range(0, len(happened), 60)]
    for batch in batches:
        rng.shuffle(batch)
    out = str(tmp_path / "out")
    increments(spark, str(tmp_path), batches, seek_gate.EVENT, lambda s: run.to_parquet(seek_gate.gate(s, 17), out))
    rows = spark.read.parquet(out)
    reached = rows.groupBy("shard_id", "epoch").agg(F.max_by("checkpoint", "checkpoint_idx").alias("c")).where("c is not null")
    assert {(r.shard_id, r.epoch): r.c for r in reached.collect()} == told and len(told) > 2
    dropped = rows.groupBy("shard_id").agg(F.sum("stale_acks").alias("n")).where("n > 0")
    assert {r.shard_id: r.n for r in dropped.collect()} == stale and stale


def test_wide_seeks_reach_every_listed_shard(spark):
    seeks = spark.createDataFrame([("s", None, 5), ("s", "b", 6), ("t", None, 7)], "stream string, shard_id string, at long")
    shards = spark.createDataFrame([("s", "a"), ("s", "b"), ("u", "c")], "stream string, shard_id string")
    moved = seek_gate.on_every_shard(seeks, shards).collect()
    assert sorted(map(tuple, moved)) == [("s", "a", 5), ("s", "b", 5), ("s", "b", 6)]


def commands_of(rng, count):
    rows = []
    for n in range(count):
        op = rng.choice(["acquire", "renew", "renew", "checkpoint", "checkpoint", "release", "read"])
        rows.append(("s", rng.choice("ab"), n, 10 * n + rng.randrange(3), rng.choice(["x", "y"]), op, 60, str(n)))
    return rows


COMMAND = "stream string, shard_id string, n long, t_ms long, owner string, op string, ttl_ms long, sequence string"


@pytest.mark.parametrize("strict", [False, True])
def test_fenced_writes_equal_the_replayed_ledger(spark, tmp_path, strict):
    rng = random.Random(4)
    tracker.use_state_store(spark)
    rows = commands_of(rng, 120)
    batches = [rows[i : i + 30] for i in range(0, 120, 30)]
    for batch in batches:
        rng.shuffle(batch)
    table, writes = str(tmp_path / "table"), str(tmp_path / "writes")
    increments(
        spark, str(tmp_path), batches, COMMAND,
        lambda s: lease_state.keep_fenced(s, table, writes, strict_expiry=strict),
    )
    verdicts = leases.replay_ledger(spark.createDataFrame(rows, COMMAND), strict_expiry=strict)
    wanted = leases.checkpoint_writes(verdicts)
    got = spark.read.parquet(writes).select(*wanted.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, wanted.collect()))
    assert got.where("not accepted").count() and got.where("accepted").count()
    last = wanted.where("accepted").groupBy("shard_id").agg(F.max_by("sequence", "n").alias("c"))
    assert held(tracker.checkpoint_table(spark, table)) == {r.shard_id: r.c for r in last.collect()}


def test_watch_tells_tenures_and_alerts(spark, tmp_path):
    """Tenures and late heartbeats equal the reports over the ledger; timers tell the rest."""
    rng = random.Random(9)
    tracker.use_state_store(spark)
    rows = commands_of(rng, 120)
    out = str(tmp_path / "out")
    # A shard that falls silent after one heartbeat: only timers can tell.
    rows[5] = ("s", "quiet", 5, 50, "z", "acquire", 60, "5")
    batches = [rows[i : i + 40] for i in range(0, 120, 40)]
    increments(
        spark, str(tmp_path), batches, COMMAND,
        lambda s: run.to_parquet(lease_state.watch_leases(s, cadence_ms=25), out),
    )
    notices = spark.read.parquet(out)
    verdicts = leases.replay_ledger(spark.createDataFrame(rows, COMMAND))
    owned = leases.ownership(verdicts)
    assert sorted(map(repr, lease_state.tenures(notices).select(*owned.columns).collect())) == sorted(map(repr, owned.collect()))
    gaps = leases.renewal_gaps(verdicts, cadence_ms=25, ttl_ms=60)
    told = lease_state.notices_past_ttl(notices, 60).select(*gaps.columns)
    assert sorted(map(repr, told.collect())) == sorted(map(repr, gaps.collect())) and gaps.count()
    quiet = notices.where("shard_id = 'quiet'").select("kind", "at_ms").collect()
    assert sorted(map(tuple, quiet), key=repr) == [("begun", None), ("lapsed", 110), ("overdue", 75)]


HAPPENED = "stream string, parent_id string, child string, parents int, closed boolean, checkpoint string"


def lineage_of(spark, shards, points):
    listed = spark.createDataFrame(
        [("s", *row) for row in shards],
        "stream string, shard_id string, parent_id string, adjacent_parent_id string, ending_sequence string",
    )
    reached = spark.createDataFrame([("s", *row) for row in points], "stream string, shard_id string, checkpoint string")
    return [tuple(r) for r in lineage_gate.events(listed, reached).collect()]


@pytest.mark.parametrize("from_tip", [False, True])
def test_children_are_woken_by_their_last_parent(spark, tmp_path, from_tip):
    tracker.use_state_store(spark)
    steps = [
        # c waits for a and b, d for one that is not listed; b is closed and was never read.
        ([("a", None, None, "9"), ("b", None, None, "9"), ("c", "a", "b", None), ("d", "gone", None, None)], [("a", "4")]),
        ([("e", "c", None, None), ("f", "a", "a", None)], [("a", "SHARD_END")]),
        ([("g", "a", None, None)], [("b", "5")]),
        ([], [("b", "SHARD_END"), ("c", "1")]),
        ([], [("c", "SHARD_END"), ("c", "SHARD_END")]),
    ]
    out, released = str(tmp_path / "out"), []
    for shards, points in steps:
        batch = lineage_of(spark, shards, points)
        increments(
            spark, str(tmp_path), [batch], HAPPENED,
            lambda s: run.to_parquet(lineage_gate.release(s, from_tip=from_tip), out),
        )
        now = sorted(r.shard_id for r in spark.read.parquet(out).collect())
        released.append([x for x in now if x not in sum(released, [])])
    wanted = [["a", "b", "d"], ["c", "f"], ["g"], [], ["e"]] if from_tip else [["a", "b", "d"], ["f"], ["g"], ["c"], ["e"]]
    assert released == wanted
    assert len(now) == len(set(now))


def test_a_marker_skips_the_backlog_of_later_batches(spark, tmp_path):
    schema = "stream string, at long, mark boolean, tip_at long"
    state, out = str(tmp_path / "markers"), str(tmp_path / "out")
    batches = [
        [("s", 1, False, 1), ("s", 4, True, 1), ("s", 3, False, 1), ("s", 5, False, 1), ("t", 2, False, 1)],
        [("s", 7, False, 1), ("s", 9, True, 1), ("s", 10, False, 1), ("t", 8, True, 1), ("t", 11, False, 1)],
        [("s", 12, False, 1), ("t", 13, True, 1)],
    ]
    tips = spark.createDataFrame([("s", 9)], "stream string, tip_at long")

    def make(stream):
        return follow_tip(stream.drop("tip_at"), F.col("mark"), "at", lambda: tips, state, out)

    increments(spark, str(tmp_path), batches, schema, make)
    rows = spark.read.parquet(out).collect()
    # s: marker at 4, tip 9; t: marker at 8 and no tip, so nothing lies behind it.
    assert sorted((r.stream, r.at) for r in rows) == [
        ("s", 1), ("s", 3), ("s", 4), ("s", 10), ("s", 12), ("t", 2), ("t", 8), ("t", 11), ("t", 13),
    ]


class CountedState:
    """The calls of one key's state; every call of a running stream goes to the JVM and back."""

    def __init__(self):
        self.value, self.map, self.writes = None, {}, 0

    def get(self):
        return self.value

    def exists(self):
        return self.value is not None

    def update(self, value):
        self.value, self.writes = value, self.writes + 1

    def updateValue(self, key, value):
        self.map[key], self.writes = value, self.writes + 1

    def iterator(self):
        return iter(list(self.map.items()))

    def keys(self):
        return iter(list(self.map))

    def clear(self):
        self.map = {}


def test_children_of_a_finished_parent_are_not_stored():
    listed = Row(child=None, parents=None, closed=True, checkpoint=None)
    ended = Row(child=None, parents=None, closed=None, checkpoint="SHARD_END")
    children = [Row(child=f"c{n}", parents=1, closed=None, checkpoint=None) for n in range(20)]
    gate = lineage_gate.ParentGate(False)
    gate._state, gate._children = CountedState(), CountedState()
    woken = [r.shard_id for r in gate.handleInputRows(("s", "p"), iter([*children[:10], listed, ended]), None)]
    woken += [r.shard_id for r in gate.handleInputRows(("s", "p"), iter(children[10:]), None)]
    assert woken == [f"c{n}" for n in range(20)]
    assert gate._children.writes == 0 and gate._state.writes == 1
    child = lineage_gate.ChildGate()
    child._released, child._done = CountedState(), CountedState()
    both = [Row(parent_id=p, parents=2) for p in "pq"]
    assert [len(list(child.handleInputRows(("s", "c"), iter(both), None))) for _ in range(2)] == [1, 0]
    assert child._done.writes == 0


class PagedState(CountedState):
    def getValue(self, key):
        self.writes += 1
        return self.map.get(key)

    def removeKey(self, key):
        self.writes += 1
        del self.map[key]


class SlotHandle:
    def __init__(self):
        self.size, self.pages = CountedState(), PagedState()

    def getValueState(self, name, schema):
        return self.size

    def getMapState(self, name, key, value):
        return self.pages


def packed(rows, schema):
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)]
    return Row(packed=paged.pack(pa.RecordBatch.from_arrays(columns, schema=schema)))


TOLD = pa.schema(
    [("stream", pa.string()), ("parent_id", pa.string()), ("child", pa.string()), ("parents", pa.int32()),
     ("closed", pa.bool_()), ("checkpoint", pa.string())]
)
WOKEN = pa.schema([("stream", pa.string()), ("shard_id", pa.string()), ("parent_id", pa.string()), ("parents", pa.int32())])


def of_slot(processor, handle, rows, schema, cut=7):
    """What a slot brings when it is opened anew for the rows of a micro-batch."""
    processor.init(handle)
    given = [packed(rows[i : i + cut], schema) for i in range(0, len(rows), cut)]
    return [row for out in processor.handleInputRows((0,), iter(given), None) for row in paged.rows(out.packed)]


@pytest.mark.parametrize("from_tip", [False, True])
def test_slots_tell_what_gates_of_single_shards_tell(monkeypatch, from_tip):
    """Random lineages in many micro-batches, with pages and lists so small that they overflow."""
    monkeypatch.setattr(paged, "PAGE", 4)
    monkeypatch.setattr(paged, "HELD", 2)
    monkeypatch.setattr(paged, "PORTION", 5)
    monkeypatch.setattr(lineage_gate, "HELD", 3)
    rng = random.Random(3)
    parents, children, slots = {}, {}, (SlotHandle(), SlotHandle())
    spilt = awake = 0
    for _ in range(30):
        rows = []
        for _ in range(rng.randrange(60)):
            stream, parent = rng.choice(["s", "s", "t", None]), rng.choice(["p", "hot", "hot", *map(str, range(20))])
            kind = rng.random()
            if kind < 0.8:
                rows.append((stream, parent, f"c{rng.randrange(400)}", rng.choice([1, 2]), None, None))
            elif kind < 0.95:
                rows.append((stream, parent, None, None, rng.random() < 0.5, None))
            else:
                rows.append((stream, parent, None, None, None, rng.choice(["5", "5", "SHARD_END"])))
        wakes = []
        for key in dict.fromkeys(r[:2] for r in rows):
            gate = parents.setdefault(key, lineage_gate.ParentGate(from_tip, CountedState(), CountedState()))
            own = [Row(child=r[2], parents=r[3], closed=r[4], checkpoint=r[5]) for r in rows if r[:2] == key]
            wakes += gate.handleInputRows(key, iter(own), None)
        found = of_slot(lineage_gate.ParentSlot(from_tip), slots[0], rows, TOLD)
        assert sorted(map(repr, found)) == sorted(repr(tuple(w)) for w in wakes)
        released = []
        for key in dict.fromkeys(w[:2] for w in found):
            gate = children.setdefault(key, lineage_gate.ChildGate(CountedState(), CountedState()))
            released += gate.handleInputRows(key, [lineage_gate.Wake(*w) for w in found if w[:2] == key], None)
        freed = of_slot(lineage_gate.ChildSlot(), slots[1], found, WOKEN)
        assert sorted(map(repr, freed)) == sorted(repr(tuple(r)) for r in released)
        spilt, awake = spilt + any(name for name, _ in slots[0].pages.map), awake + len(freed)
    assert spilt and awake and len([1 for name, _ in slots[1].pages.map if name == ""]) > 8


def test_shards_share_calls_of_the_state():
    """Before, every shard of a micro-batch made calls of its own; here 9,000 shards make few."""
    listed = [("s", f"p{n}", None, None, True, None) for n in range(3_000)]
    named = [("s", f"p{n}", f"c{n}", 1, None, None) for n in range(3_000)]
    one = [("s", "p0", f"d{n}", 1, None, None) for n in range(3_000)]
    handle = SlotHandle()
    assert not of_slot(lineage_gate.ParentSlot(False), handle, [*listed, *named, *one], TOLD, 10_000)
    ended = [("s", f"p{n}", None, None, None, "SHARD_END") for n in range(3_000)]
    woken = of_slot(lineage_gate.ParentSlot(False), handle, ended, TOLD, 10_000)
    assert sorted(w[1] for w in woken) == sorted(r[2] for r in [*named, *one])
    assert handle.size.writes + handle.pages.writes < 30
