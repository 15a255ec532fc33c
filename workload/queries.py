"""One query per operator, over tables derived from the test data."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import envelope, errors, sequence
from tidelog.functions import positions as P
from tidelog.operators import leases, lineage, records, replay, routing, seek, settlement
from tidelog.plans.scratch import new_folder, written
from tidelog.schema import SHARD_END, SHARD_KEYS
from tidelog.sources import log
from tidelog.sources.descriptor import LogStream
from tidelog.sources.reader import Reader, subscribe, subscribe_all
from tidelog.streaming import consume, lease_state, ledger, lineage_gate, run, seek_gate, tracker
from tidelog.streaming.marker import follow_tip
from workload import tables as W

Query = Callable[[SparkSession, str], DataFrame]

# Moments the replay queries refer to, in the middle of the events.
CUT = "2024-01-20 00:00:00"
OPENING_MS = 1_705_276_800_000  # 2024-01-15
CHECKPOINT_BEFORE = "2024-01-10 00:00:00"
PINNED = "500" + "0" * 50
READ_CAP = 20
OWNER, NOW_MS = "o1", 1_000
HOUR_MS = 3_600_000

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def hex_of(column: str, name: str):
    return F.hex(column).alias(name)


# Sources and sinks ---------------------------------------------------------------------------


def halves(rows: DataFrame) -> list[DataFrame]:
    """A table in two appends, split in the middle of its events."""
    middle = rows.agg((F.max("event_id") / 2).cast("long")).first()[0]
    return [rows.filter(F.col("event_id") <= middle), rows.filter(F.col("event_id") > middle)]


def build_log(rows: DataFrame, parts: int = 2) -> str:
    path = new_folder(rows.sparkSession, "log")
    for segment, part in enumerate(halves(rows) if parts == 2 else [rows]):
        log.append_log(part, path, segment)
    return path


def read_all(reader: Reader, make=lambda rows: rows) -> DataFrame:
    """Polls a reader to the end of what there is and returns the table it wrote."""
    out = new_folder(reader.spark, "out")
    reader.run(reader.to_parquet(out, make))
    return reader.spark.read.parquet(out).drop("poll")


@query
def a1_open_stream(spark, sf):
    """A described stream from the horizon; the second append is read after a restart."""
    rows = W.raw_records(spark, sf)
    path, out, state = (new_folder(spark, x) for x in ("log", "out", "state"))
    described = LogStream("events", batch=500).start_at(P.HORIZON)
    for segment, part in enumerate(halves(rows)):
        log.append_log(part, path, segment)
        reader = subscribe(spark, path, described, state)
        reader.run(reader.to_parquet(out))
    read = spark.read.parquet(out)
    return read.select(*SHARD_KEYS, "idx", "sequence_number", "partition_key", hex_of("data", "data_hex"))


@query
def a2_open_by_name(spark, sf):
    """A bare name starts at the tip: only what is appended afterwards arrives."""
    path, out, state = (new_folder(spark, x) for x in ("log", "out", "state"))
    for segment, part in enumerate(halves(W.raw_records(spark, sf))):
        log.append_log(part, path, segment)
        reader = subscribe(spark, path, "events", state)
        reader.run(reader.to_parquet(out))
    return spark.read.parquet(out).select(*SHARD_KEYS, "sequence_number")


@query
def a3_read_shard(spark, sf):
    path = build_log(W.raw_records(spark, sf))
    one = log.read_shard(spark, path, "events", "shard-0")
    return one.select("shard_id", "sequence_number", "partition_key", hex_of("data", "data_hex"))


@query
def a4_read_limit(spark, sf):
    """A bounded read per shard and poll still reaches the end."""
    path, out, state = (new_folder(spark, x) for x in ("log", "out", "state"))
    rows = W.raw_records(spark, sf)
    log.append_log(rows, path, 0)
    cap = max(1, rows.count() // READ_CAP)
    described = LogStream("events", batch=100, max_records=cap).start_at(P.HORIZON)
    reader = subscribe(spark, path, described, state)
    reader.run(reader.to_parquet(out, lambda rows: rows.select(*SHARD_KEYS, "sequence_number")))
    per_poll = spark.read.parquet(out).groupBy(*SHARD_KEYS, "poll").count()
    return per_poll.groupBy(*SHARD_KEYS).agg(
        F.sum("count").alias("records"),
        F.count(F.lit(1)).alias("batches"),
        F.max("count").alias("largest_batch"),
    )


@query
def a7_shard_catalogue(spark, sf):
    return log.shard_catalogue(spark, build_log(W.raw_records(spark, sf)), "events")


@query
def a7_shard_listing(spark, sf):
    """Shards with data, closed or open, and a lineage none of whose shards has any."""
    number = F.regexp_extract("shard_id", "[0-9]+", 0).cast("int")
    none = F.lit(None).cast("string")
    own = _listed(spark, sf).select(
        *SHARD_KEYS, none.alias("parent_id"), none.alias("adjacent_parent_id"),
        F.when(number % 4 != 3, "999").alias("ending_sequence"),
    )
    listing = log.shard_listing(spark, build_log(W.raw_records(spark, sf)), own.union(W.shards(spark, sf)))
    return listing.select(*SHARD_KEYS, "records", "parent_id", "adjacent_parent_id", "closed")


def _messages_on_shards(spark, sf):
    return W.messages(spark, sf).withColumn("shard_id", W.hot_shard())


@query
def a8_publish(spark, sf):
    """Published messages read back in order: bytes, key and position on the shard."""
    path = new_folder(spark, "log")
    for segment, part in enumerate(halves(_messages_on_shards(spark, sf))):
        log.publish(part, path, segment, order=["event_id"], writer="w1", row_id=F.col("event_id"))
    stored = settlement.with_delivery_index(log.read_log(spark, path, "events"))
    return stored.select("shard_id", "idx", "partition_key", hex_of("data", "data_hex"))


def quarters(rows: DataFrame) -> list[DataFrame]:
    last = rows.agg(F.max("event_id")).first()[0]
    part = F.floor(F.col("event_id") * 4 / (last + 1))
    return [rows.filter(part == i) for i in range(4)]


@query
def a8_compacted(spark, sf):
    """A log of several appends, packed into larger files and rid of the old ones: what its
    reader gets, with the numbers the records had before."""
    path = new_folder(spark, "log")
    for segment, part in enumerate(quarters(_messages_on_shards(spark, sf))):
        log.publish(part, path, segment, order=["event_id"], writer="w1", row_id=F.col("event_id"))
    log.compact(spark, path, file_records=20_000)
    log.drop_replaced(spark, path)
    reader = subscribe(spark, path, LogStream("events").start_at(P.HORIZON), new_folder(spark, "state"))
    return read_all(
        reader, lambda rows: rows.select("shard_id", "idx", "partition_key", hex_of("data", "data_hex"))
    )


@query
def a9_reply(spark, sf):
    """A handler's output goes to another stream, under the key of the message it answers."""
    path, answers, state = (new_folder(spark, x) for x in ("log", "log", "state"))
    log.append_log(W.raw_records(spark, sf), path, 0)

    def handler(deliveries: DataFrame) -> DataFrame:
        reply_headers = F.create_map(
            F.lit("partition-key"), envelope.partition_key_of(F.col("headers")),
            F.lit("answers"), F.col("sequence_number"),
        )
        return deliveries.select("idx", reply_headers.alias("headers"), "payload")

    reader = subscribe(spark, path, LogStream("events").start_at(P.HORIZON), state)
    reader.run(
        consume.reply(
            handler, "replies", answers, order=["idx"], writer="w2", row_id=F.col("idx"), shards=4
        )
    )
    return log.read_log(spark, answers, "replies").select(
        "stream", "partition_key", hex_of("data", "data_hex")
    )


@query
def a10_error_items(spark, sf):
    """Refused records arrive as error items between the deliveries."""
    path = build_log(W.raw_records(spark, sf), parts=1)
    reader = subscribe(spark, path, LogStream("events").start_at(P.HORIZON), new_folder(spark, "state"))
    return read_all(
        reader,
        lambda rows: consume.items(rows).select(
            *SHARD_KEYS, "sequence_number", "error", hex_of("payload", "payload_hex")
        ),
    )


@query
def a11_multi_stream(spark, sf):
    name = F.concat(F.lit("events-"), F.element_at(F.array(*map(F.lit, "ab")), (F.col("event_id") % 2 + 1).cast("int")))
    path = build_log(W.raw_records(spark, sf).withColumn("stream", name), parts=1)
    both = [LogStream(s).start_at(P.HORIZON) for s in ("events-a", "events-b")]
    reader = subscribe_all(spark, path, both, new_folder(spark, "state"))
    return read_all(reader, lambda rows: rows.select(*SHARD_KEYS, "idx", "sequence_number"))


# Records -------------------------------------------------------------------------------------


@query
def b1_pack(spark, sf):
    packed = W.messages(spark, sf).withColumn("data", envelope.pack(F.col("headers"), F.col("payload")))
    return packed.select("event_id", hex_of("data", "data_hex"))


@query
def b2_unpack(spark, sf):
    """Headers and payload of well formed and malformed records alike."""
    raw = W.raw_records(spark, sf).withColumn("n", envelope.block_length(F.col("data")))
    return raw.select(
        "event_id",
        envelope.headers_text(envelope.unpack_headers(F.col("data"), F.col("n"))).alias("headers"),
        F.hex(envelope.unpack_payload(F.col("data"), F.col("n"))).alias("payload_hex"),
    )


@query
def b2_unpack_documents(spark, sf):
    """Whole documents through the envelope and back."""
    documents = W.source(spark, sf, "documents")
    headers = F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source"))
    packed = documents.withColumn("data", envelope.pack(headers, F.col("text").cast("binary")))
    n = packed.withColumn("n", envelope.block_length(F.col("data")))
    opened = n.withColumn("headers", envelope.unpack_headers(F.col("data"), F.col("n")))
    payload = envelope.unpack_payload(F.col("data"), F.col("n"))
    return opened.select(
        "doc_id",
        F.col("headers")["lang"].alias("lang"),
        F.col("headers")["source"].alias("source"),
        F.md5(payload).alias("text_md5"),
        F.length("data").cast("long").alias("bytes"),
    )


@query
def b3_deliver(spark, sf):
    delivered, _ = records.unpack_records(W.raw_records(spark, sf))
    return delivered.select("event_id", envelope.headers_text(F.col("headers")).alias("headers"))


@query
def b4_refuse_aggregated(spark, sf):
    _, dead = records.unpack_records(W.raw_records(spark, sf))
    return dead.select(*SHARD_KEYS, "sequence_number", "error", hex_of("data", "data_hex"))


@query
def b5_routing_key(spark, sf):
    key = envelope.routing_key(F.col("headers"), F.lit("w1"), F.col("event_id"))
    return W.messages(spark, sf).select("event_id", key.alias("partition_key"))


@query
def b6_partition_key(spark, sf):
    delivered, _ = records.unpack_records(W.raw_records(spark, sf))
    return delivered.select(
        "event_id", envelope.partition_key_of(F.col("headers")).alias("partition_key")
    )


@query
def b7_position(spark, sf):
    delivered, _ = records.unpack_records(W.raw_records(spark, sf))
    return delivered.select("event_id", "position.*")


@query
def b8_message(spark, sf):
    delivered, _ = records.unpack_records(W.raw_records(spark, sf))
    return delivered.select(
        "event_id", hex_of("payload", "payload_hex"), F.size("headers").cast("long").alias("n_headers")
    )


BODY = T.StructType([T.StructField("k", T.LongType(), False)])


def _bodies(spark, sf):
    event = F.col("event_id")
    payload = (
        F.when(event % 13 == 0, F.expr("left(props, length(props) - 1)"))
        .when(event % 17 == 0, F.lit('{"j": 1}'))
        .when(event % 19 == 0, F.lit('{"k": "x"}'))
        .when(event % 23 == 0, F.lit("plain"))
        .otherwise(F.col("props"))
    )
    return W.records(spark, sf).withColumn("payload", payload.cast("binary"))


@query
def b9_decode_json(spark, sf):
    told = records.with_body(_bodies(spark, sf), BODY)
    return told.select("event_id", F.col("body.k").alias("k"), "error")


@query
def b10_order_key(spark, sf):
    """Order keys of short, zero padded and very long numbers."""
    event = F.col("event_id")
    number = (
        F.when(event % 4 == 0, event.cast("string"))
        .when(event % 4 == 1, F.concat(F.lit("000"), event.cast("string")))
        .when(event % 4 == 2, F.concat(F.lit("4"), F.lpad(event.cast("string"), 55, "0")))
        .otherwise(F.concat(F.lpad((event + 1).cast("string"), 20, "1"), F.lit("9" * 109)))
    )
    return W.events(spark, sf).select(
        "event_id",
        sequence.order_key(number).alias("order_key"),
        sequence.padded_key(number).alias("padded_key"),
    )


@query
def b11_classify(spark, sf):
    """Every kind of error row the operators produce, counted."""
    _, aggregated = records.unpack_records(W.raw_records(spark, sf))
    _, invalid = records.decode_json(_bodies(spark, sf), BODY)
    _, unread = seek.dispatch(W.seeks(spark, sf), _live(spark, sf))
    refused = leases.fenced(_verdicts(spark, sf)).withColumn("error", F.lit(errors.LEASE))
    parts = [t.select(*SHARD_KEYS, "error") for t in (aggregated, invalid, unread, refused)]
    every = reduce(DataFrame.unionByName, parts)
    described = every.withColumns(records.classify(F.col("error")))
    return described.groupBy("error", "error_scope").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("error_detail").alias("n_details")
    )


# Positions and replay ------------------------------------------------------------------------


def _selected(rows: DataFrame) -> DataFrame:
    return rows.select(*SHARD_KEYS, "sequence_number")


def _tips(spark, sf):
    return replay.shard_tips(W.records(spark, sf), F.col("arrival_ts") < F.lit(CUT).cast("timestamp"))


def _points(spark, sf):
    """Checkpoints of the event shards: most half read, one finished, one never read."""
    early = W.records(spark, sf).filter(
        (F.col("event_type") == "signup") & (F.col("arrival_ts") < F.lit(CHECKPOINT_BEFORE).cast("timestamp"))
    )
    reached = early.groupBy(*SHARD_KEYS).agg(F.max("event_id").alias("at"))
    point = F.when(F.col("shard_id") == "shard-2", "SHARD_END").otherwise(W.long_sequence(F.col("at")))
    return reached.filter(F.col("shard_id") != "shard-1").select(*SHARD_KEYS, point.alias("checkpoint"))


def _listed(spark, sf):
    return W.records(spark, sf).select(*SHARD_KEYS).distinct()


def _installed(spark, sf, stream, kind, ts_ms=None):
    """The stream-wide position in force, as a table of one row per stream."""
    known = W.shards(spark, sf) if stream == "tree" else W.records(spark, sf)
    return known.select("stream").distinct().select(
        "stream", F.lit(kind).alias("kind"), F.lit(ts_ms).cast("long").alias("ts_ms")
    )


@query
def c1_from_horizon(spark, sf):
    return _selected(replay.from_horizon(W.records(spark, sf)))


@query
def c2_from_tip(spark, sf):
    return _selected(replay.from_tip(W.records(spark, sf), _tips(spark, sf)))


@query
def c3_from_timestamp(spark, sf):
    return _selected(replay.from_timestamp(W.records(spark, sf), OPENING_MS))


@query
def c3_open_by_time(spark, sf):
    """The same position taken by a reader: the index names the one file of a shard to search."""
    path = new_folder(spark, "log")
    for segment, part in enumerate(quarters(W.raw_records(spark, sf))):
        log.append_log(part.withColumn("arrival_ts", W.late_arrival("arrival_ts")), path, segment)
    described = LogStream("events").start_at(P.TIMESTAMP, ts_ms=OPENING_MS)
    return read_all(subscribe(spark, path, described, new_folder(spark, "state")), _selected)


@query
def c4_from_sequence(spark, sf):
    return _selected(replay.from_sequence(W.records(spark, sf), "shard-0", PINNED))


@query
def c5_after_checkpoint(spark, sf):
    return _selected(replay.after_checkpoints(W.records(spark, sf), _points(spark, sf)))


START_CASES = [
    ("default", None, None, "start"),
    ("horizon", P.HORIZON, None, "start"),
    ("timestamp", P.TIMESTAMP, OPENING_MS, "recover"),
    ("latest", P.LATEST, None, "recover"),
]


@query
def c6_resolve_starts(spark, sf):
    """The whole matrix over a lineage with finished, half read and unread shards."""
    shards, points = W.shards(spark, sf), W.checkpoints(spark, sf)
    cases = []
    for label, kind, ts_ms, why in START_CASES:
        installed = None if kind is None else _installed(spark, sf, "tree", kind, ts_ms)
        starts = replay.resolve_starts(shards, points, installed, why)
        cases.append(starts.withColumn("case", F.lit(label)))
    return reduce(DataFrame.unionByName, cases)


def _replayed(spark, sf, installed, why):
    starts = replay.resolve_starts(_listed(spark, sf), _points(spark, sf), installed, why)
    return _selected(replay.replay_from(W.records(spark, sf), starts, _tips(spark, sf)))


@query
def c7_stream_wide(spark, sf):
    """One position per stream reaches every shard, also those without a checkpoint row."""
    installed = _installed(spark, sf, "events", P.TIMESTAMP, OPENING_MS)
    return _replayed(spark, sf, installed, "recover")


@query
def c8_resume(spark, sf):
    return _replayed(spark, sf, None, "start")


# Settlement ----------------------------------------------------------------------------------


@query
def d1_delivery_index(spark, sf):
    delivered = W.records(spark, sf).filter(~F.col("aggregated")).select(*SHARD_KEYS, "sequence_number")
    return settlement.with_delivery_index(delivered).select(*SHARD_KEYS, "sequence_number", "idx")


@query
def d2_outcomes(spark, sf):
    return settlement.with_done(W.deliveries(spark, sf)).select("event_id", "outcome", "done")


@query
def d3_checkpoint(spark, sf):
    return settlement.final_checkpoints(W.deliveries(spark, sf))


@query
def d4_advance_log(spark, sf):
    return settlement.advance_log(W.deliveries(spark, sf))


@query
def d4_settle_results(spark, sf):
    results = settlement.settle_results(W.deliveries(spark, sf))
    return results.select(*SHARD_KEYS, "settle_ord", "sequence_number", "checkpoint")


def thirds(rows: DataFrame) -> list[DataFrame]:
    last = rows.agg(F.max("event_id")).first()[0]
    part = F.least(F.floor(F.col("event_id") * 3 / (last + 1)), F.lit(2))
    return [rows.filter(part == i) for i in range(3)]


def in_increments(spark, parts, make) -> None:
    """Appends each part to a folder and runs the stream over it again, from its state."""
    folder, state = new_folder(spark, "in"), new_folder(spark, "state")
    for part in parts:
        part.write.mode("append").parquet(folder)
        stream = spark.readStream.schema(part.schema).parquet(folder)
        run.run_once(make(stream), state)


@query
def d5_running_tracker(spark, sf):
    """Deliveries in three increments, a third of every stretch in each, so that records come
    after later ones; outcomes an increment after their record, over three restarts."""
    indexed = written(settlement.with_delivery_index(W.deliveries(spark, sf)), "indexed")
    turn = F.col("event_id") * 7919 % 3
    settled = indexed.select(*SHARD_KEYS, "idx", "sequence_number", "outcome", turn.alias("turn"))
    waiting = settled.withColumn("outcome", F.lit(None).cast("string"))
    parts = [
        waiting.where("turn = 0"),
        settled.where("turn = 0").union(waiting.where("turn = 1")),
        settled.where("turn > 0"),
    ]
    out = new_folder(spark, "out")
    tracker.use_state_store(spark)
    in_increments(
        spark, [part.drop("turn") for part in parts],
        lambda s: run.to_parquet(tracker.track_checkpoints(s), out),
    )
    return spark.read.parquet(out).groupBy(*SHARD_KEYS).agg(
        F.max_by("checkpoint", "checkpoint_idx").alias("checkpoint")
    )


@query
def d6_drained(spark, sf):
    return settlement.drained(W.deliveries(spark, sf))


@query
def d7_wedges(spark, sf):
    return settlement.wedge_report(W.deliveries(spark, sf))


@query
def d8_replay_set(spark, sf):
    return _selected(settlement.replay_set(W.deliveries(spark, sf)))


@query
def d9_shard_end(spark, sf):
    """Closed shards are finished once read to their last record; every seventh is half read."""
    number = F.regexp_extract("shard_id", "[0-9]+", 0).cast("int")
    listed = _listed(spark, sf).withColumn("ending_sequence", F.when(number % 4 != 3, "999"))
    held = sequence.with_order_key(W.records(spark, sf).where("not aggregated"))
    known = held.groupBy(*SHARD_KEYS).agg(F.max("seq_key").alias("last_key"))
    given = W.deliveries(spark, sf).where((number % 7 != 2) | (F.col("event_id") < 500))
    return settlement.shard_checkpoints(listed.join(known, SHARD_KEYS, "left"), given)


@query
def d10_conditional_persist(spark, sf):
    return leases.checkpoint_writes(_verdicts(spark, sf))


@query
def d11_checkpoint_table(spark, sf):
    """The table after a stream of writes that move shards forth and back."""
    writes = W.events(spark, sf).select(
        W.stream_name("events", "event_id"),
        W.hot_shard().alias("shard_id"),
        "event_id",
        W.long_sequence(F.col("event_id") * 7919 % 1000).alias("checkpoint"),
    )
    path = new_folder(spark, "checkpoints")
    in_increments(spark, thirds(writes), lambda s: tracker.keep_checkpoints(s, path, "event_id"))
    return tracker.checkpoint_table(spark, path).current().select(*SHARD_KEYS, "checkpoint")


# Leases --------------------------------------------------------------------------------------


def _verdicts(spark, sf, **how):
    return leases.replay_ledger(W.lease_commands(spark, sf), **how)


def _verdict_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "shard_id", "n", "ok", "owner_after", "expires_after", "checkpoint_after", "counter_after"
    )


def _of(op: str) -> Query:
    return lambda spark, sf: _verdict_rows(_verdicts(spark, sf).filter(F.col("op") == op))


QUERIES["e1_acquire"] = _of(leases.ACQUIRE)
QUERIES["e2_renew"] = _of(leases.RENEW)
QUERIES["e3_checkpoint"] = _of(leases.CHECKPOINT)
QUERIES["e4_read"] = _of(leases.READ)
QUERIES["e5_release"] = _of(leases.RELEASE)


@query
def e4_snapshot(spark, sf):
    return leases.lease_snapshot(_verdicts(spark, sf))


@query
def e6_ledger(spark, sf):
    return _verdict_rows(_verdicts(spark, sf))


@query
def e6_running_audit(spark, sf):
    """The same ledger as a stream in three increments, leases carried between them."""
    commands = W.lease_commands(spark, sf).withColumn("event_id", F.col("n"))
    verdicts, state = new_folder(spark, "verdicts"), new_folder(spark, "leases")
    in_increments(spark, thirds(commands), lambda s: ledger.audit_leases(s, verdicts, state))
    return _verdict_rows(spark.read.parquet(verdicts))


def _hourly(spark, sf):
    """Commands on full hours, so that some meet an expiry to the millisecond."""
    hour = F.floor(F.col("t_ms") / HOUR_MS).cast("long") * HOUR_MS
    return W.lease_commands(spark, sf).withColumn("t_ms", hour)


@query
def e7_expiry_dialects(spark, sf):
    """Verdicts that differ between taking over at expiry and only after it."""
    lax, strict = (
        leases.replay_ledger(_hourly(spark, sf), strict_expiry=s).select(
            "shard_id", "n", F.col("ok").alias(name), F.col("owner_after").alias(f"{name}_owner")
        )
        for s, name in ((False, "lax"), (True, "strict"))
    )
    both = lax.join(strict, ["shard_id", "n"])
    return both.filter(
        (F.col("lax") != F.col("strict")) | ~F.col("lax_owner").eqNullSafe(F.col("strict_owner"))
    )


@query
def e8_write_counter(spark, sf):
    return _verdicts(spark, sf).select("shard_id", "n", "counter_after")


@query
def e9_fenced(spark, sf):
    return leases.fenced(_verdicts(spark, sf)).select("shard_id", "n", "owner", "op", "owner_before")


@query
def e10_ownership(spark, sf):
    return leases.ownership(_verdicts(spark, sf)).drop("stream")


def _lease_stream(spark, sf, make) -> None:
    commands = W.lease_commands(spark, sf).withColumn("event_id", F.col("n"))
    tracker.use_state_store(spark)
    in_increments(spark, thirds(commands), make)


@query
def d10_running_fence(spark, sf):
    """The verdicts of a running reader's checkpoint writes, and whether the table it keeps
    holds the write."""
    table, writes = new_folder(spark, "checkpoints"), new_folder(spark, "writes")
    _lease_stream(spark, sf, lambda s: lease_state.keep_fenced(s, table, writes))
    kept = tracker.checkpoint_table(spark, table).current().select(
        *SHARD_KEYS, F.col("write_ord").alias("n"), F.lit(True).alias("stands")
    )
    told = spark.read.parquet(writes).drop("run", "batch").join(kept, [*SHARD_KEYS, "n"], "left")
    return told.withColumn("stands", F.coalesce("stands", F.lit(False)))


@query
def e10_running_watch(spark, sf):
    """Tenures, late heartbeats and alerts of a running reader, over three restarts."""
    out = new_folder(spark, "out")
    _lease_stream(
        spark, sf,
        lambda s: run.to_parquet(
            lease_state.watch_leases(s, cadence_ms=6 * HOUR_MS, lateness="1 minute"), out
        ),
    )
    notices = spark.read.parquet(out)
    alerts = notices.where(F.col("kind").isin(lease_state.OVERDUE, lease_state.LAPSED))
    columns = ["kind", "shard_id", "owner", "n", "since_ms", "at_ms", "lapsed_ms"]
    held = lease_state.tenures(notices).selectExpr(
        "'tenure' AS kind", "shard_id", "owner", "from_n AS n", "from_ms AS since_ms", "to_ms AS at_ms", "lapsed_ms"
    )
    late = lease_state.notices_past_ttl(notices, W.LEASE_TTL).selectExpr(
        "if(past_ttl, 'late past ttl', 'late') AS kind", "shard_id", "owner", "n",
        "previous_ms AS since_ms", "t_ms AS at_ms", "CAST(NULL AS BIGINT) AS lapsed_ms",
    )
    return held.union(late).union(alerts.select(*columns))


@query
def e11_renewal_gaps(spark, sf):
    gaps = leases.renewal_gaps(_verdicts(spark, sf), cadence_ms=6 * HOUR_MS, ttl_ms=W.LEASE_TTL)
    return gaps.drop("stream")


# Lineage -------------------------------------------------------------------------------------


@query
def f1_closed(spark, sf):
    return W.shards(spark, sf).select(*SHARD_KEYS, lineage.is_closed().alias("closed"))


@query
def f2_parents_done(spark, sf):
    """From the tip, and from the horizon, where unread closed parents hold children back."""
    shards, points = W.shards(spark, sf), W.checkpoints(spark, sf)
    tip = lineage.parents_done(shards, points)
    horizon = lineage.parents_done(shards, points, _installed(spark, sf, "tree", P.HORIZON))
    return tip.select("shard_id", F.lit("tip").alias("from")).union(
        horizon.select("shard_id", F.lit("horizon"))
    )


def _number():
    return F.regexp_extract("shard_id", "[0-9]+", 0).cast("long")


@query
def f3_startable(spark, sf):
    shards = W.shards(spark, sf)
    held = shards.filter(_number() % 4 == 0).select(
        *SHARD_KEYS,
        F.concat(F.lit("o"), (_number() % 3).cast("string")).alias("owner"),
        (F.lit(NOW_MS) - 5 + _number() % 10).alias("expires_ms"),
    )
    reading = shards.filter(_number() % 11 == 0).select(*SHARD_KEYS)
    found = lineage.startable(shards, W.checkpoints(spark, sf), held, reading, OWNER, NOW_MS)
    return found.select(*SHARD_KEYS)


@query
def f3_running_release(spark, sf):
    """Shards that a reader from the horizon may start in the end: they are listed generation
    by generation, and parents are read to their end an increment after they were listed."""
    shards, points = W.shards(spark, sf), W.checkpoints(spark, sf)
    generation = F.col("shard_id").substr(1, 1)
    turn = F.when(generation.isin("r", "n"), 0).when(generation == "c", 1).otherwise(2)
    late = F.least(turn + F.when(F.col("checkpoint") == SHARD_END, 1).otherwise(0), F.lit(2))
    parts = []
    for i in range(3):
        told = lineage_gate.events(shards.where(turn == i), points.where(late == i))
        parts.append(written(told, "events"))
    out = new_folder(spark, "out")
    tracker.use_state_store(spark)
    in_increments(
        spark, parts, lambda s: run.to_parquet(lineage_gate.release(s, from_tip=False), out),
    )
    finished = points.where(F.col("checkpoint") == SHARD_END)
    return spark.read.parquet(out).join(finished, SHARD_KEYS, "left_anti")


@query
def f4_depth(spark, sf):
    return lineage.depths(W.shards(spark, sf))


def _resharded(spark, sf):
    """Records whose key moves through the generations while sequence numbers fall."""
    event, user = F.col("event_id"), F.col("user_id")
    turn = event * 13 % 4
    shard = (
        F.when(turn == 0, F.concat(F.lit("r"), (user % 4).cast("string")))
        .when(turn == 1, F.concat(F.lit("n"), (user % 25).cast("string")))
        .when(turn == 2, F.concat(F.lit("c"), user.cast("string")))
        .otherwise(F.concat(F.lit("o"), user.cast("string")))
    )
    return W.events(spark, sf).select(
        W.stream_name("tree", "event_id"),
        shard.alias("shard_id"),
        "event_id",
        W.long_sequence(10_000_000 - event).alias("sequence_number"),
        F.concat(F.lit("u"), user.cast("string")).alias("partition_key"),
    )


@query
def f5_key_order(spark, sf):
    ordered = lineage.key_order(_resharded(spark, sf), W.shards(spark, sf))
    return ordered.select("partition_key", "event_id", "depth", "key_position")


@query
def f6_trimmed_parents(spark, sf):
    return lineage.trimmed_parents(W.shards(spark, sf)).select(*SHARD_KEYS, "parent_id")


# Seeks ---------------------------------------------------------------------------------------


def _live(spark, sf):
    return W.records(spark, sf).select(*SHARD_KEYS).distinct()


@query
def g1_epoch(spark, sf):
    read = W.deliveries(spark, sf).select(*SHARD_KEYS, "event_id", "delivered_at")
    return seek.with_epoch(read, W.seeks(spark, sf), "delivered_at").select("event_id", "epoch")


@query
def g2_current(spark, sf):
    kept = seek.current_deliveries(W.deliveries(spark, sf), W.seeks(spark, sf), "delivered_at")
    return kept.select("event_id")


def _settled(spark, sf):
    return seek.live_settlements(W.deliveries(spark, sf), W.seeks(spark, sf), "delivered_at")


@query
def g3_stale_acks(spark, sf):
    return _settled(spark, sf).select("event_id", "epoch", "stale_ack")


@query
def g4_epoch_checkpoints(spark, sf):
    return seek.epoch_checkpoints(_settled(spark, sf))


@query
def g4_stored_checkpoints(spark, sf):
    return seek.stored_checkpoints(written(_settled(spark, sf), "settled"))


def _clock_thirds(spark, sf, happened: DataFrame) -> list[DataFrame]:
    last = W.events(spark, sf).agg(F.max("event_id")).first()[0] * W.TICK
    part = F.least(F.floor(F.col("at") * 3 / last), F.lit(2))
    return [happened.where(part == i) for i in range(3)]


@query
def g4_running_gate(spark, sf):
    """Deliveries, outcomes and seeks as one stream, over three restarts: what is stored per
    shard in the end, and how many stale acknowledgements were dropped."""
    read = written(settlement.with_delivery_index(W.deliveries(spark, sf)), "indexed")
    placed = read.withColumn("at", F.col("delivered_at"))
    settled = read.withColumn("at", F.col("settle_ord"))
    seeks = seek_gate.on_every_shard(W.seeks(spark, sf), _live(spark, sf))
    happened = written(seek_gate.events(placed, settled, seeks), "events")
    out = new_folder(spark, "out")
    tracker.use_state_store(spark)
    stretch = 4096 * W.TICK
    in_increments(
        spark, _clock_thirds(spark, sf, happened),
        lambda s: run.to_parquet(seek_gate.gate(s, stretch), out),
    )
    order = F.when(F.col("checkpoint").isNotNull(), F.struct("epoch", "checkpoint_idx"))
    return spark.read.parquet(out).groupBy(*SHARD_KEYS).agg(
        F.max_by("checkpoint", order).alias("checkpoint"),
        F.max(order)["epoch"].alias("epoch"),
        F.sum("stale_acks").alias("stale_acks"),
    )


@query
def g4_epoch_index(spark, sf):
    stamped = seek.with_epoch(W.deliveries(spark, sf), W.seeks(spark, sf), "delivered_at")
    return seek.epoch_index(stamped).select("event_id", "epoch", "epoch_idx")


@query
def g5_dispatch(spark, sf):
    applied, failed = seek.dispatch(W.seeks(spark, sf), _live(spark, sf))
    none = F.lit(None).cast("string")
    return applied.select("at", "kind", "shard_id", none.alias("error")).union(
        failed.select("at", "kind", "shard_id", "error")
    )


@query
def g6_marker(spark, sf):
    rows = W.records(spark, sf)
    tips = rows.filter(F.col("arrival_ts") < F.lit(CUT).cast("timestamp")).groupBy("stream").agg(
        F.max("event_id").alias("tip_at")
    )
    marker = (F.col("props") == '{"k": 42}') & (F.col("event_type") == "signup")
    return seek.skip_backlog(rows, marker, "event_id", tips).select("event_id")


@query
def g6_running_marker(spark, sf):
    """The marker met by a running reader: the backlog is skipped in later micro-batches too."""
    rows = W.records(spark, sf).select("stream", "event_id", "event_type", "props", "arrival_ts")
    tips = rows.filter(F.col("arrival_ts") < F.lit(CUT).cast("timestamp")).groupBy("stream").agg(
        F.max("event_id").alias("tip_at")
    )
    marker = (F.col("props") == '{"k": 42}') & (F.col("event_type") == "signup")
    state, out = new_folder(spark, "markers"), new_folder(spark, "out")
    in_increments(
        spark, thirds(rows), lambda s: follow_tip(s, marker, "event_id", lambda: tips, state, out)
    )
    return spark.read.parquet(out).select("event_id")


# Routing -------------------------------------------------------------------------------------


def _intervals(spark, sf):
    return routing.live_intervals(W.subscription_log(spark, sf))


def _fan_out(spark, sf):
    return routing.fan_out(W.topic_messages(spark, sf), _intervals(spark, sf))


@query
def h1_fan_out(spark, sf):
    return _fan_out(spark, sf).select("sub_id", "name", "at")


@query
def h2_published_log(spark, sf):
    return routing.published_log(W.topic_messages(spark, sf))


@query
def h3_live_intervals(spark, sf):
    return _intervals(spark, sf)


def _outcomes(delivered: DataFrame) -> DataFrame:
    """A few deliveries are requeued once or twice before they are acknowledged."""
    draw = (F.col("at") * 7 + F.col("sub_id")) % 13
    tries = F.when(draw < 2, draw + 1).otherwise(0)
    attempts = delivered.select("sub_id", "at", tries.alias("tries"), F.explode(F.sequence(F.lit(0).cast("long"), tries)).alias("attempt"))
    outcome = F.when(F.col("attempt") < F.col("tries"), "nack_requeue").otherwise("ack")
    return attempts.select("sub_id", "at", "attempt", outcome.alias("outcome"))


def _attempts(spark, sf):
    delivered = _fan_out(spark, sf).select("sub_id", "name", "at")
    return routing.with_requeues(delivered, _outcomes(delivered))


@query
def h4_requeue(spark, sf):
    return _attempts(spark, sf).select("sub_id", "name", "at", "attempt")


def _steps(spark, sf):
    """Each attempt is handled three ticks after it was enqueued; the last two may not be."""
    attempts = written(_attempts(spark, sf), "attempts")
    started = F.col("at") * 1000 + F.col("attempt") * 3000
    enqueued = attempts.select("sub_id", started.alias("at"), "attempt")
    handled = attempts.filter(F.col("at") % 101 != 0)
    return enqueued, handled.select("sub_id", (started + 3000).alias("at"), "attempt")


@query
def h5_in_flight(spark, sf):
    return routing.in_flight(*_steps(spark, sf))


@query
def h5_quiescent(spark, sf):
    return routing.quiescent(*_steps(spark, sf))


@query
def h6_expectations(spark, sf):
    expected = W.source(spark, sf, "customer").select(
        F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("name"),
        (F.col("c_custkey") % 80).alias("n"),
    )
    return routing.unmet_expectations(W.topic_messages(spark, sf), expected)
