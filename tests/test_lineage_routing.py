"""Lineage and routing on cases worked out by hand."""

import pytest

from tidelog.operators import lineage, routing

SHARD = "stream string, shard_id string, parent_id string, adjacent_parent_id string, ending_sequence string"
POINT = "stream string, shard_id string, checkpoint string"


def lineage_of(spark, *rows):
    return spark.createDataFrame([("s", *r) for r in rows], SHARD)


def ids(table):
    return sorted(r.shard_id for r in table.collect())


def test_parents_done(spark):
    shards = lineage_of(
        spark,
        ("read", None, None, "1"),
        ("half", None, None, "1"),
        ("unread", None, None, "1"),
        ("open", None, None, None),
        ("a", "read", None, None),
        ("b", "read", "half", None),
        ("c", "unread", None, None),
        ("d", "open", None, None),
        ("e", "trimmed", "read", None),
        ("f", "trimmed", None, None),
    )
    points = spark.createDataFrame([("s", "read", "SHARD_END"), ("s", "half", "5")], POINT)
    roots = ["half", "open", "read", "unread"]
    assert ids(lineage.parents_done(shards, points)) == sorted([*roots, "a", "c", "e", "f"])
    for kind, more in (("horizon", []), ("timestamp", []), ("latest", ["c"])):
        installed = spark.createDataFrame([("s", kind, None)], "stream string, kind string, ts_ms long")
        assert ids(lineage.parents_done(shards, points, installed)) == sorted([*roots, "a", "e", "f", *more])
    assert ids(lineage.trimmed_parents(shards)) == ["e", "f"]
    held = spark.createDataFrame(
        [("s", "a", "other", 11), ("s", "c", "me", 99), ("s", "e", "other", 10), ("s", "f", None, None)],
        "stream string, shard_id string, owner string, expires_ms long",
    )
    reading = spark.createDataFrame([("s", "open")], "stream string, shard_id string")
    found = lineage.startable(shards, points, held, reading, "me", 10)
    assert ids(found) == ["c", "e", "f", "half", "unread"]
    strict = lineage.startable(shards, points, held, reading, "me", 10, strict_expiry=True)
    assert ids(strict) == ["c", "f", "half", "unread"]


def test_depth_of_repeated_merges_and_splits(spark):
    """Every generation doubles the paths, not the rows."""
    rows = [("g0-a", None, None, None), ("g0-b", None, None, None)]
    for g in range(1, 25):
        rows += [(f"g{g}-{x}", f"g{g - 1}-a", f"g{g - 1}-b", None) for x in "ab"]
    rows.append(("skip", "g0-a", "g7-b", None))
    told = {r.shard_id: r.depth for r in lineage.depths(lineage_of(spark, *rows)).collect()}
    assert told["skip"] == 8
    assert all(told[f"g{g}-a"] == g for g in range(25))


def test_a_cycle_is_reported(spark):
    with pytest.raises(ValueError, match="does not end"):
        lineage.depths(lineage_of(spark, ("a", "b", None, None), ("b", "a", None, None)))


def test_key_order_across_a_split_and_blocked(spark):
    shards = lineage_of(spark, ("p", None, None, "9"), ("c", "p", None, None))
    rows = spark.createDataFrame(
        [("s", "c", "1", "k"), ("s", "p", "20", "k"), ("s", "p", "3", "k"), ("s", "c", "2", "k")],
        "stream string, shard_id string, sequence_number string, partition_key string",
    )
    for how in ({"blocks": 1}, {"blocks": 3}):
        placed = lineage.key_order(rows, shards, **how).orderBy("key_position").collect()
        assert [(r.shard_id, r.sequence_number) for r in placed] == [("p", "3"), ("p", "20"), ("c", "1"), ("c", "2")]


def test_fan_out_and_intervals(spark):
    log = spark.createDataFrame(
        [
            (1, "click", 100, "subscribe"), (1, "click", 600, "unsubscribe"), (1, "click", 700, "unsubscribe"),
            (2, "click", 300, "subscribe"), (3, "nosuch", 0, "subscribe"), (9, "click", 5, "unsubscribe"),
        ],
        "sub_id long, name string, at long, action string",
    )
    spans = routing.live_intervals(log)
    assert sorted(tuple(r) for r in spans.collect()) == [
        (1, "click", 100, 600), (2, "click", 300, None), (3, "nosuch", 0, None),
    ]
    messages = spark.createDataFrame(
        [("click", t) for t in (99, 100, 300, 599, 600)] + [("view", 300)], "name string, at long"
    )
    sent = sorted((r.sub_id, r.at) for r in routing.fan_out(messages, spans).collect())
    assert sent == [(1, 100), (1, 300), (1, 599), (2, 300), (2, 599), (2, 600)]
    assert [r.at for r in routing.published(messages, "click").collect()] == [99, 100, 300, 599, 600]
    expected = spark.createDataFrame([("click", 5), ("view", 2), ("nosuch", 1)], "name string, n long")
    unmet = sorted(tuple(r) for r in routing.unmet_expectations(messages, expected).collect())
    assert unmet == [("nosuch", 1, 0), ("view", 2, 1)]


def test_requeue_and_in_flight(spark):
    sent = spark.createDataFrame([(1, 10), (2, 10)], "sub_id long, at long")
    outcomes = spark.createDataFrame(
        [(1, 10, 0, "nack_requeue"), (1, 10, 1, "ack"), (2, 10, 0, "nack_skip")],
        "sub_id long, at long, attempt long, outcome string",
    )
    attempts = sorted(tuple(r) for r in routing.with_requeues(sent, outcomes).collect())
    assert attempts == [(1, 10, 0), (1, 10, 1), (2, 10, 0)]
    enqueued = spark.createDataFrame([(1, 10, 0), (1, 12, 1), (2, 10, 0)], "sub_id long, at long, attempt long")
    consumed = spark.createDataFrame([(1, 12, 0), (1, 15, 1)], "sub_id long, at long, attempt long")
    for how in ({"blocks": 1}, {"blocks": 3}):
        counts = routing.in_flight(enqueued, consumed, **how).orderBy("sub_id", "at", "attempt").collect()
        assert sorted((r.sub_id, r.at, r.step, r.in_flight) for r in counts) == [
            (1, 10, 1, 1), (1, 12, -1, 1), (1, 12, 1, 2), (1, 15, -1, 0), (2, 10, 1, 1),
        ]
    assert sorted(tuple(r) for r in routing.quiescent(enqueued, consumed).collect()) == [(1, 0), (2, 1)]
