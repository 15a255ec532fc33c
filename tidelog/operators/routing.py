"""Routing of named messages to the subscriptions live when they were published.

Messages are rows (name, at, ...); a subscription log is rows (sub_id, name, at, action).
Names match exactly. ``at`` is one integer clock.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelog.operators.settlement import NACK_REQUEUE
from tidelog.plans.interval import covering
from tidelog.plans.prefix import Scan, prefix

# Fixed actions of the subscription log.
SUBSCRIBE = "subscribe"
UNSUBSCRIBE = "unsubscribe"


def live_intervals(log: DataFrame) -> DataFrame:
    """When each subscription was live: [sub_start, sub_end), open when never ended.

    An id subscribes once; ending it again, or ending an unknown id, changes nothing.
    """
    at, action = F.col("at"), F.col("action")
    spans = log.groupBy("sub_id").agg(
        F.min(F.when(action == SUBSCRIBE, F.struct("at", "name"))).alias("_first"),
        F.min(F.when(action == UNSUBSCRIBE, at)).alias("sub_end"),
    )
    return spans.filter(F.col("_first").isNotNull()).select(
        "sub_id",
        F.col("_first.name").alias("name"),
        F.col("_first.at").alias("sub_start"),
        "sub_end",
    )


def fan_out(messages: DataFrame, intervals: DataFrame, **join) -> DataFrame:
    """Each message once per subscription live on its name; without one it is dropped."""
    return covering(messages, intervals, ["name"], "at", "sub_start", "sub_end", **join)


def published(messages: DataFrame, name: str) -> DataFrame:
    """Everything published under a name, in order, delivered or not."""
    return messages.filter(F.col("name") == name).orderBy("at")


def published_log(messages: DataFrame, **scan) -> DataFrame:
    """The position of every message in the log of its name."""
    return prefix(messages, ["name"], ["at"], {"log_position": Scan("count", inclusive=False)}, **scan)


def with_requeues(deliveries: DataFrame, outcomes: DataFrame) -> DataFrame:
    """First deliveries (attempt 0) and the redeliveries that requeued ones lead to.

    ``outcomes(sub_id, at, attempt, outcome)`` lists what became of each attempt. A requeue
    returns the message to the end of that one subscription, as the next attempt.
    """
    again = outcomes.filter(F.col("outcome") == NACK_REQUEUE).select(
        "sub_id", "at", (F.col("attempt") + 1).alias("attempt")
    )
    first = deliveries.withColumn("attempt", F.lit(0).cast("long"))
    return first.unionByName(deliveries.join(again, ["sub_id", "at"]))


def in_flight(enqueued: DataFrame, consumed: DataFrame, **scan) -> DataFrame:
    """Messages in flight per subscription after every enqueue and consume.

    Both inputs are rows (sub_id, at, attempt) with ``at`` the moment of the step. A requeue
    enqueues before the attempt it belongs to counts as consumed.
    """
    steps = enqueued.select("sub_id", "at", "attempt", F.lit(1).alias("step")).unionByName(
        consumed.select("sub_id", "at", "attempt", F.lit(-1).alias("step"))
    )
    ordered = steps.withColumn("_rank", -F.col("step"))
    return prefix(
        ordered,
        ["sub_id"],
        ["at", "_rank", "attempt"],
        {"in_flight": Scan("sum", F.col("step"))},
        **scan,
    ).drop("_rank")


def quiescent(enqueued: DataFrame, consumed: DataFrame) -> DataFrame:
    """Per subscription, what is still in flight in the end; zero everywhere is quiescent."""
    plus = enqueued.groupBy("sub_id").agg(F.count(F.lit(1)).alias("_in"))
    minus = consumed.groupBy("sub_id").agg(F.count(F.lit(1)).alias("_out"))
    left = F.coalesce("_in", F.lit(0)) - F.coalesce("_out", F.lit(0))
    return plus.join(minus, "sub_id", "full").select("sub_id", left.alias("in_flight"))


def unmet_expectations(messages: DataFrame, expected: DataFrame) -> DataFrame:
    """Names whose publish count differs from ``expected(name, n)``."""
    counts = messages.groupBy("name").agg(F.count(F.lit(1)).alias("_n"))
    actual = F.coalesce("_n", F.lit(0))
    return (
        expected.join(counts, "name", "left")
        .filter(actual != F.col("n"))
        .select("name", F.col("n").alias("expected"), actual.alias("published"))
    )
