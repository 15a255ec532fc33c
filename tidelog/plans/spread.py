"""Joins of many rows per key with one row per key, without a task per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 64


def deal(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """``rows`` dealt by ``by`` over all shuffle partitions.

    Keys and states of shards shrink to little in a shuffle, and AQE, which goes by those bytes,
    would bring most of a large table into a task or two; a number that is asked for it keeps.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def join_spread(
    rows: DataFrame, table: DataFrame, on: Sequence[str], by: Sequence[str], salts: int = SALTS
) -> DataFrame:
    """Left join of ``rows`` with ``table``, which has one row per key ``on``.

    A key may hold most of the rows: they are dealt by ``by`` over ``salts`` parts of the key,
    and the key's one row is sent to each part.
    """
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*by), F.lit(salts)).cast("int"))
    parts = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt")
    keys = [*on, "_salt"]
    return deal(dealt, keys).join(deal(table.select("*", parts), keys), keys, "left").drop("_salt")
