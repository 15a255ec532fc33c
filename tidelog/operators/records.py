"""Messages to records and back, over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import envelope, errors, positions
from tidelog.functions.envelope import lossy_text


def pack_records(messages: DataFrame, writer: str, row_id: Column) -> DataFrame:
    """Messages (``headers``, ``payload``) to records (``partition_key``, ``data``).

    ``writer`` and ``row_id`` make the key of messages that carry none: it is the same on
    every run, so a retried task routes a message to the same shard again.
    """
    return messages.withColumns(
        {
            "partition_key": envelope.routing_key(F.col("headers"), F.lit(writer), row_id),
            "data": envelope.pack(F.col("headers"), F.col("payload")),
        }
    ).drop("headers", "payload")


def accepted(records: DataFrame) -> DataFrame:
    """Records that are delivered: all but the producer-aggregated ones."""
    return records.filter(~envelope.is_aggregated(F.col("data")))


def refused(records: DataFrame) -> DataFrame:
    """Error rows for the records that are not delivered."""
    kind = F.lit(errors.AGGREGATED)
    return (
        records.filter(envelope.is_aggregated(F.col("data")))
        .withColumn("error", kind)
        .withColumn("error_detail", errors.detail(kind))
    )


def _unpacked(records: DataFrame) -> DataFrame:
    """Adds ``headers``, ``payload`` and ``position`` and drops the bytes."""
    length = F.col("_length")
    delivered = envelope.delivered_headers(
        envelope.unpack_entries(F.col("data"), length),
        F.col("partition_key"),
        F.col("sequence_number"),
        F.col("shard_id"),
    )
    return (
        records.withColumn("_length", envelope.block_length(F.col("data")))
        .withColumns(
            {
                "headers": delivered,
                "payload": envelope.unpack_payload(F.col("data"), length),
                "position": positions.of_record(),
            }
        )
        .drop("_length", "data")
    )


def unpack_records(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits records into deliveries (``headers``, ``payload``) and dead letters."""
    return _unpacked(accepted(records)), refused(records)


def with_items(records: DataFrame) -> DataFrame:
    """Deliveries and failures in one table, each row either a payload or an ``error``.

    A malformed record never ends the query; it arrives as an item like any other, and so does
    a row that comes with an ``error`` already. One projection does it: the records are read
    once.
    """
    before = F.col("error") if "error" in records.columns else F.lit(None).cast("string")
    told = F.col("error_detail") if "error_detail" in records.columns else F.lit(None).cast("string")
    kind = F.lit(errors.AGGREGATED)
    bad = F.coalesce(envelope.is_aggregated(F.col("data")), F.lit(False)) & before.isNull()
    marked = records.withColumns(
        {
            "error_detail": F.when(bad, errors.detail(kind)).otherwise(told),
            "error": F.when(bad, kind).otherwise(before),
        }
    )
    items = _unpacked(marked)
    good = F.col("error").isNull()
    return items.withColumns({c: F.when(good, F.col(c)) for c in ("headers", "payload", "position")})


def with_body(deliveries: DataFrame, schema: T.StructType) -> DataFrame:
    """Types the payload as ``body``; where that fails, ``body`` is null and ``error`` says why.

    One projection parses every payload once, so decoded and undecodable rows need no second
    scan. Fields of ``schema`` that are not nullable must be present.
    """
    corrupt = "_corrupt"
    parse_as = T.StructType(
        [T.StructField(f.name, f.dataType, True) for f in schema.fields]
        + [T.StructField(corrupt, T.StringType())]
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    # The array keeps the parsed value in one place: fields of it would each parse anew.
    parsed = F.array(F.from_json(lossy_text(F.col("payload")), parse_as, options))
    required = [f.name for f in schema.fields if not f.nullable]

    def checked(body: Column) -> Column:
        ok = body.isNotNull() & body[corrupt].isNull()
        for name in required:
            ok = ok & body[name].isNotNull()
        return F.when(ok, F.struct(*[body[f.name].alias(f.name) for f in schema.fields]))

    typed = deliveries.withColumn("body", F.get(F.transform(parsed, checked), F.lit(0)))
    kind = F.when(F.col("body").isNull(), F.lit(errors.INVALID))
    return typed.withColumn("error", kind).withColumn("error_detail", F.when(kind.isNotNull(), errors.detail(kind)))


def decode_json(deliveries: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Types the payload as ``body``; returns the typed rows and the undecodable ones.

    For both in one table, read once, see :func:`with_body`.
    """
    told = with_body(deliveries, schema)
    good = F.col("error").isNull()
    return told.filter(good).drop("error", "error_detail"), told.filter(~good).drop("body")


def classify(kind: Column) -> dict[str, Column]:
    """Columns describing an error kind."""
    return {"error_scope": errors.scope(kind), "error_detail": errors.detail(kind)}
