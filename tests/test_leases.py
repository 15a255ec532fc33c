"""Lease ledgers: the rules one by one, and blocks against a ledger replayed in one piece."""

import random

import pytest
from pyspark.sql import functions as F

from tidelog.operators import leases
from tidelog.schema import LEASE_COMMAND, LEASE_STATE


def ledger(spark, *commands):
    """Commands are (t_ms, owner, op, ttl_ms, sequence) on one shard."""
    rows = [("s", "s1", n, t, owner, op, ttl, seq) for n, (t, owner, op, ttl, seq) in enumerate(commands)]
    return spark.createDataFrame(rows, LEASE_COMMAND)


def verdicts(spark, *commands, **how):
    return leases.replay_ledger(ledger(spark, *commands), **how).orderBy("n").collect()


def test_a_live_lease_is_exclusive(spark):
    rows = verdicts(spark, (0, "a", "acquire", 60, None), (1, "b", "acquire", 60, None))
    assert [r.ok for r in rows] == [True, False]


def test_an_expired_lease_is_taken_and_its_owner_fenced(spark):
    rows = verdicts(
        spark,
        (0, "a", "acquire", 0, None),
        (0, "b", "acquire", 60, None),
        (1, "a", "renew", 60, None),
        (1, "a", "checkpoint", 0, "42"),
    )
    assert [r.ok for r in rows] == [True, True, False, False]
    assert rows[-1].checkpoint_after is None


def test_a_checkpoint_survives_release(spark):
    rows = verdicts(
        spark,
        (0, "a", "acquire", 60, None),
        (1, "a", "checkpoint", 0, "41"),
        (2, "a", "release", 0, None),
        (3, "b", "read", 0, None),
        (4, "a", "release", 0, None),
    )
    assert rows[3].checkpoint_after == "41"
    assert [r.ok for r in rows] == [True, True, True, True, False]
    assert rows[-1].counter_after == 3


def test_an_expired_lease_nobody_took_still_works(spark):
    rows = verdicts(
        spark,
        (0, "a", "acquire", 5, None),
        (100, "a", "checkpoint", 0, "9"),
        (101, "a", "renew", 5, None),
        (102, "a", "checkpoint", 0, "3"),
    )
    assert all(r.ok for r in rows)
    assert rows[-1].checkpoint_after == "3"


@pytest.mark.parametrize(("strict", "granted"), [(False, True), (True, False)])
def test_the_dialects_differ_at_the_expiry_instant(spark, strict, granted):
    rows = verdicts(
        spark, (0, "a", "acquire", 10, None), (10, "b", "acquire", 10, None), strict_expiry=strict
    )
    assert rows[1].ok is granted


def random_ledger(spark, seed, sorted_times):
    rng = random.Random(seed)
    rows, now = [], 0
    for n in range(900):
        now = now + rng.choice([0, 1, 2, 9]) if sorted_times else rng.randrange(800)
        shard = "hot" if rng.random() < 0.7 else f"s{rng.randrange(4)}"
        op = rng.choices(["acquire", "renew", "checkpoint", "read", "release"], [4, 5, 5, 1, 0.7])[0]
        owner = f"o{rng.randrange(rng.choice([2, 3, 12]))}"
        rows.append(("s", shard, n, now, owner, op, rng.choice([0, 3, 10, 40]), str(n)))
    return spark.createDataFrame(rows, LEASE_COMMAND)


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("sorted_times", [True, False])
@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_equal_one_piece(spark, seed, sorted_times, strict):
    commands = random_ledger(spark, seed, sorted_times)
    state = spark.createDataFrame([("s", "hot", "o1", 25, "77", 5), ("s", "idle", "o2", 9, "1", 2)], LEASE_STATE)
    # Held by someone who sends no command: only its expiry lets others in.
    gone = spark.createDataFrame([("s", "hot", "gone", 300, "7", 5), ("s", "s1", "gone", 90, None, 1)], LEASE_STATE)
    for before in (None, state, gone):
        whole = leases.replay_ledger(commands, before, strict_expiry=strict, blocks=1)
        cut = leases.replay_ledger(
            commands, before, strict_expiry=strict, blocks=24
        )
        assert whole.columns == cut.columns
        assert sorted(map(repr, whole.collect())) == sorted(map(repr, cut.collect()))


def test_summaries_stay_small_when_leases_settle():
    """A block of many heartbeats is summed up in a few rows."""
    block = leases._Block(strict=False, latest=900)
    for i in reversed(range(20_000)):
        block.feed(i, "acquire" if i % 2 else "renew", f"o{i % 3}", i * 5, 1000)
    assert len(list(block.rows())) < 120


def test_tenures_and_gaps(spark):
    told = leases.replay_ledger(
        ledger(
            spark,
            (0, "a", "acquire", 10, None),
            (4, "a", "renew", 10, None),
            (12, "a", "renew", 10, None),
            (30, "b", "acquire", 10, None),
            (35, "b", "release", 0, None),
            (50, "a", "acquire", 10, None),
        )
    )
    tenures = [tuple(r)[2:] for r in leases.ownership(told).orderBy("from_n").collect()]
    assert tenures == [("a", 0, 0, 30, 22), ("b", 3, 30, 35, None), ("a", 5, 50, None, None)]
    gaps = leases.renewal_gaps(told, cadence_ms=3, ttl_ms=7).orderBy("n").collect()
    assert [(g.n, g.gap_ms, g.past_ttl) for g in gaps] == [(1, 4, False), (2, 8, True)]


def test_blocked_tenures_equal_plain_ones(spark):
    told = leases.replay_ledger(random_ledger(spark, 3, True)).persist()
    for report in (leases.ownership, leases.renewal_gaps):
        plain, cut = report(told, blocks=1), report(told, blocks=12)
        assert sorted(map(repr, plain.collect())) == sorted(map(repr, cut.collect()))
    told.unpersist()


def test_snapshot_and_fencing(spark):
    told = leases.replay_ledger(
        ledger(
            spark,
            (0, "a", "acquire", 5, None),
            (9, "b", "acquire", 5, None),
            (9, "a", "checkpoint", 0, "1"),
            (10, "b", "checkpoint", 0, "2"),
        )
    )
    assert tuple(leases.lease_snapshot(told).first()) == ("s", "s1", "b", 14, "2", 3)
    assert [r.n for r in leases.fenced(told).collect()] == [2]
    accepted = leases.checkpoint_writes(told).filter(F.col("accepted")).collect()
    assert [r.sequence for r in accepted] == ["2"]
