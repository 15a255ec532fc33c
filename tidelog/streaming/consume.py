"""Subscriptions end to end: deliveries, dead letters, replies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tidelog.operators.records import with_items
from tidelog.plans.scratch import written
from tidelog.sources.log import publish


def items(records: DataFrame) -> DataFrame:
    """A subscription's records as items: a delivery, or an ``error`` that took its place.

    Failures of the source itself arrive the same way, and neither ends the query.
    """
    return with_items(records)


def publish_stream(
    messages: DataFrame,
    path: str,
    *,
    order: list[str],
    writer: str,
    row_id: Column,
    shards: int = 1,
    first_segment: int = 0,
) -> DataStreamWriter:
    """Appends every micro-batch of messages to a log as one segment.

    The segment is numbered by the batch, so a batch that is repeated changes nothing.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        kept = written(batch, "messages")
        publish(kept, path, first_segment + batch_id, order=order, writer=writer, row_id=row_id, shards=shards)

    return messages.writeStream.foreachBatch(append)


def reply(
    handler: Callable[[DataFrame], DataFrame],
    to: str,
    path: str,
    *,
    order: list[str],
    writer: str,
    row_id: Column,
    shards: int = 1,
    first_segment: int = 0,
) -> Callable[[DataFrame, int], None]:
    """What a reader does to publish what ``handler`` makes of the deliveries to another stream.

    ``handler`` is any DataFrame transformation that returns ``headers`` and ``payload``. The
    partition key is kept unless the handler sets another one. Answers are evaluated once, and
    a poll that is repeated publishes the same segment, which changes nothing.
    """

    def answer(records: DataFrame, number: int) -> None:
        deliveries = items(records).filter(F.col("error").isNull())
        answers = written(handler(deliveries).withColumn("stream", F.lit(to)), "answers")
        publish(answers, path, first_segment + number, order=order, writer=writer, row_id=row_id, shards=shards)

    return answer
