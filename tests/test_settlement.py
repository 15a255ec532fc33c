"""Contiguous acknowledgement against a literal tracker."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import replay, seek, settlement

DELIVERY = "stream string, shard_id string, sequence_number string, outcome string, settle_ord long, arrival_ts timestamp"


def table(spark, *rows):
    """Rows are (sequence, outcome, settle_ord)."""
    return spark.createDataFrame([("s", "s1", *r, None) for r in rows], DELIVERY)


def literal_advances(rows):
    """Marks records done in settle order; returns what each settle released."""
    pending = dict.fromkeys(sorted((r[0] for r in rows), key=int), False)
    told = []
    for sequence, _, order in sorted((r for r in rows if r[2] is not None), key=lambda r: r[2]):
        pending[sequence] = True
        reached = None
        for front in list(pending):
            if not pending[front]:
                break
            reached = front
            del pending[front]
        told.append((order, reached))
    return told


def test_the_checkpoint_advances_only_contiguously(spark):
    rows = table(spark, ("100", "ack", 3), ("101", "ack", 1), ("102", "ack", 2))
    results = settlement.settle_results(rows).orderBy("settle_ord").collect()
    assert [r.checkpoint for r in results] == [None, None, "102"]
    assert settlement.drained(rows).first().drained
    assert settlement.final_checkpoints(rows).first().checkpoint == "102"


def test_an_unsettled_record_wedges(spark):
    rows = table(spark, ("100", None, None), ("101", "ack", 1))
    assert settlement.final_checkpoints(rows).first().checkpoint is None
    assert settlement.drained(rows).first().outstanding == 1
    assert settlement.replay_set(rows).count() == 2


def test_requeue_replays_it_and_all_after(spark):
    rows = table(spark, ("9", "ack", 1), ("10", "nack_requeue", None), ("11", "ack", 2), ("12", "nack_skip", 3))
    assert settlement.final_checkpoints(rows).first().checkpoint == "9"
    assert sorted(r.sequence_number for r in settlement.replay_set(rows).collect()) == ["10", "11", "12"]


@pytest.mark.parametrize("seed", range(3))
def test_advances_equal_a_literal_tracker(spark, seed):
    rng = random.Random(seed)
    orders = rng.sample(range(1000), 300)
    rows = [(str(i * 7), "ack", orders[i]) if rng.random() < 0.99 else (str(i * 7), "nack_requeue", None) for i in range(300)]
    wanted = literal_advances(rows)
    for how in ({"blocks": 1}, {"blocks": 9}):
        results = settlement.settle_results(table(spark, *rows), **how).orderBy("settle_ord")
        assert [(r.settle_ord, r.checkpoint) for r in results.collect()] == wanted


def test_index_skips_refused_records(spark):
    magic = bytearray(b"\xf3\x89\x9a\xc2x")
    rows = spark.createDataFrame(
        [("s", "s1", "5", bytearray(b"a")), ("s", "s1", "10", magic), ("s", "s1", "20", bytearray(b"b"))],
        "stream string, shard_id string, sequence_number string, data binary",
    )
    indexed = settlement.with_delivery_index(rows).collect()
    assert {r.sequence_number: r.idx for r in indexed} == {"5": 0, "20": 1}


def test_last_write_stands_even_if_lower(spark):
    writes = spark.createDataFrame(
        [("s", "a", "90", 1), ("s", "a", "5", 2)],
        "stream string, shard_id string, checkpoint string, write_ord long",
    )
    assert settlement.last_writes(writes).first().checkpoint == "5"


def test_finished_shards(spark):
    shards = spark.createDataFrame(
        [("s", "s1", "9", "0012", None), ("s", "half", "9", "0019", "1"), ("s", "empty", "9", None, None), ("s", "open", None, "0019", "4")],
        "stream string, shard_id string, ending_sequence string, last_key string, checkpoint string",
    )
    rows = table(spark, ("1", "ack", 1), ("2", "ack", 2))
    rows = rows.unionByName(rows.withColumn("shard_id", F.lit("half")))
    told = {r.shard_id: r.checkpoint for r in settlement.shard_checkpoints(shards, rows).collect()}
    assert told == {"s1": "SHARD_END", "half": "2", "empty": "SHARD_END", "open": "4"}


def test_start_matrix(spark):
    shards = spark.createDataFrame([("s", x) for x in ("end", "half", "none")], "stream string, shard_id string")
    points = spark.createDataFrame(
        [("s", "end", "SHARD_END"), ("s", "half", "7")], "stream string, shard_id string, checkpoint string"
    )
    at_horizon = spark.createDataFrame([("s", "horizon", None)], "stream string, kind string, ts_ms long")

    def kinds(installed, why):
        starts = replay.resolve_starts(shards, points, installed, why).collect()
        return {r.shard_id: (r.start_kind, r.start_sequence) for r in starts}

    assert kinds(None, "start") == {"end": (None, None), "half": ("after", "7"), "none": ("latest", None)}
    assert kinds(at_horizon, "start") == {"end": (None, None), "half": ("horizon", None), "none": ("horizon", None)}
    assert kinds(at_horizon, "recover") == {"end": (None, None), "half": ("after", "7"), "none": ("horizon", None)}


def test_timestamps_out_of_range(spark):
    rows = spark.createDataFrame(
        [("s", "s1", "1"), ("s", "s1", "2")], "stream string, shard_id string, sequence_number string"
    ).withColumn("arrival_ts", F.timestamp_millis(F.col("sequence_number").cast("long")))
    count = {ms: replay.from_timestamp(rows, ms).count() for ms in (0, 1, 2, 3, 2**63 - 1, 2**64 - 1)}
    assert count == {0: 2, 1: 2, 2: 1, 3: 0, 2**63 - 1: 0, 2**64 - 1: 0}


def test_each_shard_opens_at_its_first_record_from_the_instant(spark):
    times = {"1": 10, "2": 30, "3": 20, "4": 5}
    rows = spark.createDataFrame(
        [("s", "s1", k, v) for k, v in times.items()], "stream string, shard_id string, sequence_number string, ms long"
    ).withColumn("arrival_ts", F.timestamp_millis("ms"))
    kept = replay.from_timestamp(rows, 25).collect()
    assert sorted(r.sequence_number for r in kept) == ["2", "3", "4"]


def test_stale_acks_do_not_move_the_new_generation(spark):
    rows = spark.createDataFrame(
        [("s", "s1", "1", "ack", 0, 15), ("s", "s1", "2", "ack", 1, 30), ("s", "s1", "3", "ack", 20, 25)],
        "stream string, shard_id string, sequence_number string, outcome string, at long, settle_ord long",
    )
    seeks = spark.createDataFrame(
        [("s", "s1", 18, "sequence"), ("s", None, 26, "horizon"), ("s", "other", 2, "sequence")],
        "stream string, shard_id string, at long, kind string",
    )
    told = seek.live_settlements(rows, seeks, "at").collect()
    assert {r.sequence_number: (r.epoch, r.stale_ack) for r in told} == {
        "1": (0, False), "2": (0, True), "3": (1, False),
    }
    stored = seek.stored_checkpoints(seek.live_settlements(rows, seeks, "at")).first()
    assert (stored.checkpoint, stored.epoch) == ("3", 1)
    current = seek.current_deliveries(rows, seeks.filter("at = 18"), "at").collect()
    assert [r.sequence_number for r in current] == ["3"]
