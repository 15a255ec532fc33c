"""The log on storage: positions, restarts, limits, gating and failures of the source."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidelog.functions import positions as P
from tidelog.functions.errors import LogError
from tidelog.operators.records import with_items
from tidelog.schema import SEQUENCE_HEADER
from tidelog.sources import log
from tidelog.sources.descriptor import LogStream
from tidelog.sources.reader import subscribe, subscribe_all
from tidelog.streaming import consume, run


def records(spark, *rows):
    """Rows are (shard, sequence, seconds)."""
    table = spark.createDataFrame(
        [("s", shard, str(seq), "k", sec, bytearray(f"p{seq}".encode())) for shard, seq, sec in rows],
        "stream string, shard_id string, sequence_number string, partition_key string, sec long, data binary",
    )
    return table.withColumn("arrival_ts", F.timestamp_seconds("sec")).drop("sec")


class Polls:
    """A reader opened anew for every poll; each call reads what is new."""

    def __init__(self, spark, path, described, folder):
        self.spark, self.path, self.described, self.state = spark, path, described, str(folder / "state")

    def __call__(self):
        found = []

        def keep(rows, number):
            found.extend((r.shard_id, int(r.sequence_number)) for r in rows.collect())

        subscribe(self.spark, self.path, self.described, self.state).run(keep, polls=1)
        return sorted(found)


def collected(reader):
    """Every row of every poll, and how many polls there were."""
    rows = []
    polls = reader.run(lambda batch, number: rows.extend(batch.collect()))
    return rows, polls


@pytest.fixture
def path(spark, tmp_path):
    """Two shards over two segments; arrival times run backwards once."""
    folder = str(tmp_path / "log")
    log.append_log(records(spark, ("a", 9, 10), ("a", 10, 20), ("b", 5, 11)), folder, 0)
    log.append_log(records(spark, ("a", 11, 40), ("a", 12, 30), ("a", 100, 31), ("b", 7, 35)), folder, 1)
    return folder


def test_batch_read_and_catalogue(spark, path):
    rows = log.read_shard(spark, path, "s", "a").collect()
    assert [r.sequence_number for r in rows] == ["9", "10", "11", "12", "100"]
    catalogue = {r.shard_id: (r.records, r.segments) for r in log.shard_catalogue(spark, path).collect()}
    assert catalogue == {"a": (5, 2), "b": (2, 2)}
    assert log.read_log(spark, path, "other").count() == 0


ALL_A = [("a", 9), ("a", 10), ("a", 11), ("a", 12), ("a", 100)]
ALL_B = [("b", 5), ("b", 7)]


@pytest.mark.parametrize(
    ("where", "wanted"),
    [
        ({"kind": P.HORIZON}, ALL_A + ALL_B),
        ({"kind": P.LATEST}, []),
        ({"kind": P.TIMESTAMP, "ts_ms": 31_000}, [("a", 11), ("a", 12), ("a", 100), ("b", 7)]),
        ({"kind": P.TIMESTAMP, "ts_ms": 36_000}, [("a", 11), ("a", 12), ("a", 100)]),
        ({"kind": P.TIMESTAMP, "ts_ms": 2**63 - 1}, []),
        ({"kind": P.SEQUENCE, "shard_id": "a", "sequence": "12"}, [("a", 12), ("a", 100)]),
        ({"kind": P.SEQUENCE, "shard_id": "a", "sequence": "13"}, [("a", 100)]),
    ],
)
def test_positions_then_restart(spark, path, tmp_path, where, wanted):
    reader = Polls(spark, path, LogStream("s", batch=2).start_at(**where), tmp_path)
    assert reader() == sorted(wanted)
    log.append_log(records(spark, ("a", 101, 50), ("c", 1, 50)), path, 2)
    late = [("a", 101), ("c", 1)] if where.get("ts_ms", 0) < 50_000 else []
    assert reader() == late
    assert reader() == []


def test_resume_from_stored_checkpoints(spark, path, tmp_path):
    points = str(tmp_path / "points")
    spark.createDataFrame(
        [("s", "a", "10"), ("s", "b", "SHARD_END"), ("t", "a", "1")],
        "stream string, shard_id string, checkpoint string",
    ).write.parquet(points)
    reader = Polls(spark, path, LogStream("s", checkpoints=points), tmp_path)
    assert reader() == [("a", 11), ("a", 12), ("a", 100)]


def test_index_counts_every_record(spark, path, tmp_path):
    rows, _ = collected(subscribe(spark, path, LogStream("s").start_at(P.HORIZON), str(tmp_path / "state")))
    assert sorted((r.shard_id, r.idx, r.sequence_number) for r in rows if r.shard_id == "a") == [
        ("a", 0, "9"), ("a", 1, "10"), ("a", 2, "11"), ("a", 3, "12"), ("a", 4, "100"),
    ]


def test_a_failed_poll_is_handled_again(spark, path, tmp_path):
    """With the same records and number, whatever was appended meanwhile."""
    state = str(tmp_path / "state")

    def fail(rows, number):
        raise RuntimeError(f"poll {number}")

    with pytest.raises(RuntimeError, match="poll 0"):
        subscribe(spark, path, LogStream("s").start_at(P.HORIZON), state).run(fail)
    log.append_log(records(spark, ("a", 101, 50)), path, 2)
    told = []
    reader = subscribe(spark, path, LogStream("s").start_at(P.HORIZON), state)
    reader.run(lambda rows, number: told.append((number, sorted(int(r.sequence_number) for r in rows.collect()))))
    assert told == [(0, [5, 7, 9, 10, 11, 12, 100]), (1, [101])]


def test_a_lookup_opens_one_file_of_a_shard(spark, tmp_path):
    path = str(tmp_path / "log")
    for segment in range(6):
        rows = [(shard, 10 * segment + n, 10 * segment + n) for shard in "ab" for n in range(1, 10)]
        log.append_log(records(spark, *rows), path, segment)
    reader = subscribe(spark, path, LogStream("s").start_at(P.TIMESTAMP, ts_ms=35_000), str(tmp_path / "state"))
    opened, rows_of = [], reader._rows

    def watched(selected):
        opened.append(selected.count())
        return rows_of(selected)

    reader._rows = watched
    rows, polls = collected(reader)
    assert sorted(int(r.sequence_number) for r in rows) == sorted(2 * [n for n in range(35, 60) if n % 10])
    # One file per shard for the lookup, then the files from there on.
    assert opened[:2] == [2, 6] and polls == 1


def test_a_bounded_reader_reaches_the_end_across_restarts(spark, path, tmp_path):
    reader = Polls(spark, path, LogStream("s", max_records=2).start_at(P.HORIZON), tmp_path)
    assert reader() == [("a", 9), ("a", 10), ("b", 5), ("b", 7)]
    assert reader() == [("a", 11), ("a", 12)]
    assert reader() == [("a", 100)]
    assert reader() == []


def test_children_wait_for_their_parents(spark, tmp_path):
    path, shards = str(tmp_path / "log"), str(tmp_path / "shards")
    log.append_log(records(spark, ("p", 1, 1), ("p", 2, 1), ("p", 3, 1), ("c", 1, 1), ("d", 1, 1)), path, 0)
    columns = "stream string, shard_id string, parent_id string, adjacent_parent_id string, ending_sequence string"
    spark.createDataFrame(
        [("s", "p", None, None, "3"), ("s", "c", "p", None, None), ("s", "d", "gone", None, None)], columns
    ).write.parquet(shards)
    described = LogStream("s", shards=shards, max_records=2).start_at(P.HORIZON)
    reader = Polls(spark, path, described, tmp_path)
    assert reader() == [("d", 1), ("p", 1), ("p", 2)]
    assert reader() == [("p", 3)]
    assert reader() == [("c", 1)]


def test_a_trimmed_file_is_an_error_item(spark, path, tmp_path):
    gone = glob.glob(f"{path}/data/segment=0/attempt=*/stream=s/shard_id=b/*.parquet")
    for file in gone:
        os.remove(file)
    reader = subscribe(spark, path, LogStream("s").start_at(P.HORIZON), str(tmp_path / "state"))
    rows = []
    reader.run(lambda batch, number: rows.extend(consume.items(batch).where("shard_id = 'b'").collect()))
    assert sorted((r.sequence_number or "", r.error) for r in rows) == [("", "Read"), ("7", None)]


def test_an_unindexed_segment_is_not_read(spark, path):
    keyed = records(spark, ("a", 500, 1)).withColumn("seq_key", F.lit("003500"))
    keyed.write.partitionBy("stream", "shard_id").parquet(f"{path}/data/segment=9/attempt=x")
    assert log.read_log(spark, path).count() == 7
    log.append_log(records(spark, ("a", 501, 1)), path, 9)
    assert log.read_log(spark, path).count() == 8


def test_a_repeated_append_changes_nothing(spark, path, tmp_path):
    log.append_log(records(spark, ("a", 500, 1)), path, 3)
    before = sorted(glob.glob(f"{path}/data/**/*.parquet", recursive=True))
    log.append_log(records(spark, ("a", 500, 1)), path, 3)
    log.append_log(records(spark, ("a", 600, 1)), path, 1)
    assert sorted(glob.glob(f"{path}/data/**/*.parquet", recursive=True)) == before
    assert log.read_log(spark, path).count() == 8
    with pytest.raises(LogError):
        log.append_log(records(spark, ("a", 1, 1)), path, 2)
    read = Polls(spark, path, LogStream("s").start_at(P.HORIZON), tmp_path)
    assert len(read()) == 8


@pytest.mark.parametrize(
    "where",
    [{"kind": P.TIMESTAMP, "ts_ms": 30_000}, {"kind": P.SEQUENCE, "shard_id": "a", "sequence": "30"}],
)
def test_a_position_past_the_end_stays_open(spark, tmp_path, where):
    path = str(tmp_path / "log")
    log.append_log(records(spark, ("a", 1, 1)), path, 0)
    read = Polls(spark, path, LogStream("s").start_at(where.pop("kind"), **where), tmp_path)
    assert read() == []
    for segment, first in enumerate((20, 22, 29, 40), start=1):
        log.append_log(records(spark, ("a", first, first), ("a", first + 1, first + 1)), path, segment)
        found = read()
        assert found == {20: [], 22: [], 29: [("a", 30)], 40: [("a", 40), ("a", 41)]}[first]


def test_capped_polls_go_on_until_nothing_is_new(spark, tmp_path):
    path = str(tmp_path / "log")
    log.append_log(records(spark, *[("a", n, n) for n in range(1, 11)]), path, 0)
    described = LogStream("s", max_records=2).start_at(P.SEQUENCE, shard_id="a", sequence="7")
    rows, polls = collected(subscribe(spark, path, described, str(tmp_path / "state")))
    assert sorted(int(r.sequence_number) for r in rows) == [7, 8, 9, 10] and polls == 2


def test_several_streams_in_one_reader(spark, tmp_path):
    path = str(tmp_path / "log")
    for segment, stream in enumerate(["s", "t"]):
        rows = records(spark, *[("a", n, n) for n in range(1, 4)]).withColumn("stream", F.lit(stream))
        log.append_log(rows, path, segment)
    both = [LogStream("s").start_at(P.HORIZON), LogStream("t").start_at(P.SEQUENCE, shard_id="a", sequence="2")]
    rows, _ = collected(subscribe_all(spark, path, both, str(tmp_path / "state")))
    assert sorted((r.stream, r.idx) for r in rows) == [("s", 0), ("s", 1), ("s", 2), ("t", 1), ("t", 2)]


def files_of(path):
    return glob.glob(f"{path}/data/**/*.parquet", recursive=True)


def test_compaction_bounds_the_files_and_changes_no_reader(spark, tmp_path):
    """Many small appends become few files; positions, order and numbers stay."""
    path = str(tmp_path / "log")
    for segment in range(8):
        # Sequence numbers fall from one segment to the next: the order of arrival counts.
        rows = [(shard, 100 * (9 - segment) + n, segment) for shard in "ab" for n in range(5)]
        log.append_log(records(spark, *rows), path, segment)
    half = subscribe(spark, path, LogStream("s", max_records=17).start_at(P.HORIZON), str(tmp_path / "half"))
    begun = []
    half.run(lambda rows, number: begun.extend(rows.collect()), polls=1)
    before, _ = collected(subscribe(spark, path, LogStream("s").start_at(P.HORIZON), str(tmp_path / "one")))
    small = len(files_of(path))
    log.compact(spark, path, file_records=15)
    assert sorted(map(repr, log.read_log(spark, path).collect())) and log.read_log(spark, path).count() == 80
    after, _ = collected(subscribe(spark, path, LogStream("s").start_at(P.HORIZON), str(tmp_path / "two")))
    assert sorted(map(repr, after)) == sorted(map(repr, before))
    rest, _ = collected(half)
    assert sorted(map(repr, begun + rest)) == sorted(map(repr, before))
    assert log.drop_replaced(spark, path) > 0
    # 80 records in files of 15, and what the ranges of the write cut.
    assert len(files_of(path)) < small / 2
    again, _ = collected(subscribe(spark, path, LogStream("s").start_at(P.HORIZON), str(tmp_path / "three")))
    assert sorted(map(repr, again)) == sorted(map(repr, before))
    log.append_log(records(spark, ("a", 1, 99)), path, 8)
    more, _ = collected(half)
    assert [(r.idx, r.sequence_number) for r in more] == [(40, "1")]
    log.append_log(records(spark, ("a", 2, 99)), path, 3)
    assert log.read_log(spark, path).count() == 81


def test_a_failed_compaction_is_not_seen(spark, path):
    log.compact(spark, path)
    os.remove(f"{path}/compacted/upto=1/_SUCCESS")
    assert log.read_log(spark, path).count() == 7
    log.compact(spark, path)
    assert log.read_log(spark, path).count() == 7


def test_trimmed_shards_open_at_the_bound(spark, tmp_path):
    path = str(tmp_path / "log")
    for segment in range(4):
        log.append_log(records(spark, ("a", segment, 10 * segment), ("b", segment, segment)), path, segment)
    behind = subscribe(spark, path, LogStream("s", max_records=1).start_at(P.HORIZON), str(tmp_path / "behind"))
    behind.run(lambda rows, number: rows.collect(), polls=1)
    log.compact(spark, path, before_ms=15_000)
    log.drop_replaced(spark, path)
    log.append_log(records(spark, ("a", 9, 90), ("b", 9, 90)), path, 4)
    rows, _ = collected(subscribe(spark, path, LogStream("s").start_at(P.HORIZON), str(tmp_path / "new")))
    assert sorted((r.shard_id, r.idx, r.error) for r in rows) == [("a", 2, None), ("a", 3, None), ("a", 4, None), ("b", 4, None)]
    catalogue = {r.shard_id: r.records for r in log.shard_catalogue(spark, path).collect()}
    assert catalogue == {"a": 3, "b": 1}
    # A reader that was behind is told where it lost records.
    rows, _ = collected(behind)
    told = sorted({(r.shard_id, r.idx, r.error) for r in rows if r.shard_id == "a"})
    assert told == [("a", 1, "Read"), ("a", 2, None), ("a", 3, None), ("a", 4, None)]
    found, _ = collected(subscribe(spark, path, LogStream("s").start_at(P.TIMESTAMP, ts_ms=0), str(tmp_path / "time")))
    assert sorted((r.shard_id, r.idx) for r in found) == [("a", 2), ("a", 3), ("a", 4), ("b", 4)]


def test_a_log_that_is_not_there_yet(spark, tmp_path):
    reader = subscribe(spark, str(tmp_path / "log"), LogStream("s").start_at(P.HORIZON), str(tmp_path / "state"))
    assert collected(reader) == ([], 0)
    log.append_log(records(spark, ("a", 1, 1)), str(tmp_path / "log"), 0)
    rows, polls = collected(reader)
    assert (len(rows), polls) == (1, 1)


@pytest.mark.parametrize(
    "described",
    [
        LogStream(""),
        LogStream("s", batch=0),
        LogStream("s", batch=10_001),
        LogStream("s", max_records=0),
        LogStream("s").start_at("nowhere"),
        LogStream("s").start_at(P.TIMESTAMP),
        LogStream("s").start_at(P.SEQUENCE, shard_id="a"),
    ],
)
def test_bad_descriptors_are_rejected_before_any_input(spark, described):
    with pytest.raises(LogError):
        subscribe(spark, "/nowhere", described, "/nowhere")


def test_publish_needs_a_shard(spark):
    with pytest.raises(LogError):
        log.publish(spark.range(1), "/nowhere", 0, order=["id"], writer="w", row_id=F.col("id"), shards=0)


def test_round_trip_of_a_published_message(spark, tmp_path):
    path = str(tmp_path / "log")
    messages = spark.range(40).select(
        F.lit("s").alias("stream"),
        "id",
        F.create_map(F.lit("content-type"), F.lit("json"), F.lit("partition-key"), F.concat(F.lit("user-"), F.col("id") % 5)).alias("headers"),
        F.concat(F.lit('{"id":'), F.col("id"), F.lit("}")).cast("binary").alias("payload"),
    )
    log.publish(messages, path, 0, order=["id"], writer="w", row_id=F.col("id"), shards=3)
    items = with_items(log.read_log(spark, path)).collect()
    assert len(items) == 40
    shards = {}
    for item in sorted(items, key=lambda i: int(i.sequence_number)):
        assert item.headers["content-type"] == "json"
        assert item.headers[SEQUENCE_HEADER] == item.sequence_number
        shards.setdefault(item.headers["partition-key"], set()).add(item.shard_id)
        shards.setdefault(("order", item.shard_id), []).append(int(bytes(item.payload)[6:-1]))
    assert all(len(v) == 1 for k, v in shards.items() if isinstance(k, str))
    assert all(v == sorted(v) for k, v in shards.items() if not isinstance(k, str))


def test_names_that_need_escaping_in_paths(spark, tmp_path):
    path, name = str(tmp_path / "my log"), "a b:c/d%é"
    rows = records(spark, ("0001", 1, 1), ("shard=x", 2, 1)).withColumn("stream", F.lit(name))
    log.append_log(rows, path, 0)
    assert sorted(r.shard_id for r in log.read_log(spark, path, name).collect()) == ["0001", "shard=x"]
    reader = Polls(spark, path, LogStream(name).start_at(P.HORIZON), tmp_path)
    assert reader() == [("0001", 1), ("shard=x", 2)]


def test_filters_reach_the_scan(spark, path):
    from tidelog.operators import replay

    rows = log.read_log(spark, path, "s")
    plans = [
        replay.from_sequence(rows, "a", "11")._jdf.queryExecution().executedPlan().toString(),
        replay.from_timestamp(rows, 31_000)._jdf.queryExecution().toString(),
    ]
    assert "GreaterThanOrEqual(seq_key," in plans[0]
    assert "shard_id" in plans[0].split("PartitionFilters")[1].split("]")[0]
