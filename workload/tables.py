"""Log tables derived from the test data. Every table grows with the data it is made of."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions.sequence import with_order_key
from tidelog.schema import AGGREGATED_MAGIC, PARTITION_KEY_HEADER, SHARD_HEADER

# Stream clocks: an event is delivered at event_id * TICK, settled later than that.
TICK = 1_000_000
LEASE_TTL = 129_600_000
# Shards on which some records are never settled.
WEDGED = ["shard-0", "shard-1", "shard-3", "shard-5"]


_SCHEMAS: dict[str, T.StructType] = {}


def source(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table of the test data; its schema is read from the file once."""
    path = f"{sf}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def events(spark: SparkSession, sf: str) -> DataFrame:
    rows = source(spark, sf, "events")
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def stream_name(name: str, key: str) -> Column:
    """The stream a row belongs to, as a column: a bare literal would be folded out of joins."""
    return F.when(F.col(key).isNotNull(), F.lit(name)).alias("stream")


def hot_shard() -> Column:
    """A third of the users, and so a third of the records, share one shard."""
    user = F.col("user_id")
    return F.when(user % 3 == 0, F.lit("shard-0")).otherwise(
        F.concat(F.lit("shard-"), (1 + user % 7).cast("string"))
    )


def long_sequence(number: Column) -> Column:
    """A sequence number too long for any numeric type, and not padded."""
    return F.concat(number.cast("string"), F.lit("0" * 50))


def late_arrival(ts: str = "ts") -> Column:
    """Arrival times that are not in sequence order, by up to ten hours."""
    return F.timestamp_add("HOUR", -(F.col("event_id") * 7 % 11).cast("int"), F.col(ts))


def records(spark: SparkSession, sf: str) -> DataFrame:
    """One record per event, without its bytes."""
    event = F.col("event_id")
    return events(spark, sf).select(
        stream_name("events", "event_id"),
        hot_shard().alias("shard_id"),
        "event_id",
        long_sequence(event).alias("sequence_number"),
        F.concat(F.lit("u"), _text("user_id")).alias("partition_key"),
        late_arrival().alias("arrival_ts"),
        "event_type",
        "props",
        (event % 211 == 0).alias("aggregated"),
    )


def messages(spark: SparkSession, sf: str) -> DataFrame:
    """One message per event, with headers of every kind the envelope has rules for."""
    event, user = F.col("event_id"), _text("user_id")

    def header(when: Column, name: str, value: Column) -> Column:
        return F.when(when, F.struct(F.lit(name).alias("key"), value.alias("value")))

    entries = F.array(
        header(event % 2 == 0, "partition-key", F.concat(F.lit("u"), user)),
        header(event % 3 != 0, "x-tenant", F.concat(F.lit("t"), user)),
        header(event % 3 != 0, "x-ev", F.col("event_type")),
        header(event % 7 == 0, "note", F.concat(F.lit(" at: "), _text("event_id"), F.lit("\t"))),
        header(event % 11 == 0, "multi", F.concat(F.lit("x\ninj: "), user)),
    )
    return events(spark, sf).select(
        stream_name("events", "event_id"),
        "event_id",
        "user_id",
        F.map_from_entries(F.array_compact(entries)).alias("headers"),
        F.col("props").cast("binary").alias("payload"),
        F.col("ts").alias("arrival_ts"),
    )


def raw_records(spark: SparkSession, sf: str) -> DataFrame:
    """One record per event whose bytes are well formed, malformed or aggregated in turn."""
    case, event = F.col("event_id") % 12, F.col("event_id")
    props = F.col("props").cast("binary")

    def enveloped(block: Column) -> Column:
        return F.concat(
            F.lit(b"RSK1"), F.unhex(F.lpad(F.hex(F.length(block)), 8, "0")), block, props
        )

    def line(*parts) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]).cast("binary")

    user = _text("user_id")
    data = (
        F.when(case == 0, F.concat(F.lit(AGGREGATED_MAGIC), props))
        .when(case == 1, enveloped(line("x-tenant: t", user, "\n")))
        .when(case == 2, enveloped(line("A:1\r\nB: ", user, "\r\n")))
        .when(case == 3, enveloped(line("no colon\nA: b: c", user, "\n")))
        .when(case == 4, enveloped(line("A: first\nB: x\nA: ", user, "\n")))
        .when(case == 5, enveloped(F.concat(line("A: "), F.lit(b"\xff"), line(user, "\n"))))
        .when(case == 6, F.concat(F.lit(b"RSK1\x00\x00\xff\xff"), props))
        .when(case == 7, F.lit(b"RSK1\x00\x00"))
        .when(case == 8, enveloped(line("\t A\u00a0:\u2003 ", user, " \t")))
        .when(case == 9, F.lit(AGGREGATED_MAGIC))
        .when(case == 10, enveloped(line(f"{PARTITION_KEY_HEADER}: other\n{SHARD_HEADER}: x\nA: ", user)))
        .otherwise(props)
    )
    return events(spark, sf).select(
        stream_name("events", "event_id"),
        hot_shard().alias("shard_id"),
        "event_id",
        long_sequence(event).alias("sequence_number"),
        F.concat(F.lit("u"), user).alias("partition_key"),
        F.col("ts").alias("arrival_ts"),
        data.alias("data"),
    )


def deliveries(spark: SparkSession, sf: str) -> DataFrame:
    """What became of every delivered record; settling runs out of order by up to 12 events."""
    event, error = F.col("event_id"), F.col("event_type") == "error"
    requeued = error & (event % 97 == 0) & F.col("shard_id").isin(*WEDGED)
    outcome = (
        F.when(requeued, "nack_requeue").when(error, "nack_skip").otherwise("ack")
    )
    settled = (event + (event * 7919) % 13) * TICK + event
    return with_order_key(
        records(spark, sf)
        .filter(~F.col("aggregated"))
        .select(
            "stream",
            "shard_id",
            "event_id",
            "sequence_number",
            "arrival_ts",
            outcome.alias("outcome"),
            (event * TICK).alias("delivered_at"),
            F.when(~requeued, settled).alias("settle_ord"),
        )
    )


def seeks(spark: SparkSession, sf: str) -> DataFrame:
    """Repositions made by some of the sign-ups, stream-wide, pinned, and to a dead shard."""
    event, user = F.col("event_id"), F.col("user_id")
    wide = event % 5 == 0
    shard = F.when(user % 10 == 9, F.lit("shard-gone")).otherwise(hot_shard())
    kinds = F.array(F.lit("horizon"), F.lit("latest"), F.lit("timestamp"))
    return (
        events(spark, sf)
        .filter((F.col("event_type") == "signup") & ((event * 31 + user) % 23 == 0))
        .select(
            stream_name("events", "event_id"),
            F.when(~wide, shard).alias("shard_id"),
            (event * TICK + TICK // 2).alias("at"),
            F.when(wide, F.get(kinds, (event % 3).cast("int"))).otherwise("sequence").alias("kind"),
            long_sequence(event - 1).alias("sequence"),
        )
    )


def shards(spark: SparkSession, sf: str) -> DataFrame:
    """Lineage of four generations: regions split into nations, customers and orders.

    Some shards have a second parent; one region is trimmed past retention.
    """

    def shard(letter: str, key: Column) -> Column:
        return F.concat(F.lit(letter), key.cast("string"))

    def rows(table, key, parent, adjacent, closed) -> DataFrame:
        return table.select(
            stream_name("tree", table.columns[0]),
            key.alias("shard_id"),
            parent.cast("string").alias("parent_id"),
            adjacent.cast("string").alias("adjacent_parent_id"),
            F.when(closed, F.lit("999")).alias("ending_sequence"),
        )

    region, nation = source(spark, sf, "region"), source(spark, sf, "nation")
    customer, order = source(spark, sf, "customer"), source(spark, sf, "orders")
    r, n, of = F.col("r_regionkey"), F.col("n_nationkey"), F.col("n_regionkey")
    c, cn, o, oc = (F.col(x) for x in ("c_custkey", "c_nationkey", "o_orderkey", "o_custkey"))
    none = F.lit(None)
    return (
        rows(region.filter(r != 4), shard("r", r), none, none, r != 3)
        .union(
            rows(
                nation, shard("n", n), shard("r", of),
                F.when(n % 3 == 0, shard("r", (of + 1) % 5)), n % 4 != 1,
            )
        )
        .union(
            rows(
                customer, shard("c", c), shard("n", cn),
                F.when(c % 5 == 0, shard("n", (cn + 1) % 25)), c % 2 == 0,
            )
        )
        .union(
            rows(
                order, shard("o", o), shard("c", oc),
                F.when(o % 6 == 0, shard("r", o % 5)), o % 10 == 0,
            )
        )
    )


def checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    """Checkpoints of some shards of the lineage: finished, half read, never read."""
    number = F.regexp_extract("shard_id", "[0-9]+", 0).cast("long")
    point = F.when(F.col("ending_sequence").isNotNull() & (number % 2 == 0), "SHARD_END").otherwise(
        F.concat(number.cast("string"), F.lit("5"))
    )
    return (
        shards(spark, sf)
        .filter(number % 3 != 1)
        .select("stream", "shard_id", point.alias("checkpoint"))
    )


def lease_commands(spark: SparkSession, sf: str) -> DataFrame:
    """A lease ledger per user: five commands by three owners."""
    kind, event = F.col("event_type"), F.col("event_id")
    op = (
        F.when(kind.isin("signup", "purchase"), "acquire")
        .when(kind == "view", "renew")
        .when(kind == "click", "checkpoint")
        .otherwise(F.when(event % 2 == 0, "release").otherwise("read"))
    )
    return events(spark, sf).select(
        stream_name("events", "event_id"),
        F.concat(F.lit("s"), _text("user_id")).alias("shard_id"),
        event.alias("n"),
        F.unix_millis("ts").alias("t_ms"),
        F.concat(F.lit("o"), (event % 3).cast("string")).alias("owner"),
        op.alias("op"),
        F.lit(LEASE_TTL).cast("long").alias("ttl_ms"),
        event.cast("string").alias("sequence"),
    )


def topic_messages(spark: SparkSession, sf: str) -> DataFrame:
    """Every event published under the name of its user."""
    return events(spark, sf).select(
        F.concat(F.lit("u"), _text("user_id")).alias("name"),
        F.col("event_id").alias("at"),
        "event_type",
    )


def subscription_log(spark: SparkSession, sf: str) -> DataFrame:
    """Sign-ups subscribe to the user's topic; most end, twice, some hundred events later."""
    event = F.col("event_id")
    begun = events(spark, sf).filter(F.col("event_type") == "signup")
    name = F.concat(F.lit("u"), _text("user_id")).alias("name")
    ended = begun.filter(event % 10 != 0)
    first = event + 200 + event % 700
    return (
        begun.select(event.alias("sub_id"), name, event.alias("at"), F.lit("subscribe").alias("action"))
        .union(ended.select(event, name, first, F.lit("unsubscribe")))
        .union(ended.filter(event % 4 == 0).select(event, name, first + 50, F.lit("unsubscribe")))
    )
