"""Prefix scans over an ordered log: running count, sum, max and last value per key.

A plain window puts each key in one task, and a single shard may hold a third of a log. So
the rows are range partitioned on (key, order) into blocks of even size and written once,
bucketed by block; the windows then run inside each block without another shuffle. Only the
first key of a block can have begun in an earlier one, so what earlier blocks contribute is one
row per block, and that is all that is broadcast.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelog.plans.scratch import new_folder


@dataclass(frozen=True)
class Scan:
    """One running value. ``kind`` is count, sum, max, last or latest.

    ``last`` is the value of the last row, null or not; ``latest`` the last value that is set.
    ``inclusive`` counts the current row in; ``last`` with ``inclusive=False`` is a lag, and
    ``reverse=True`` runs from the far end, which makes it a lead.
    """

    kind: str
    value: Column | None = None
    inclusive: bool = True
    reverse: bool = False


def _inner(scan: Scan, window, value: str) -> Column:
    if scan.kind == "count":
        return F.count(F.lit(1)).over(window)
    if scan.kind == "sum":
        return F.sum(value).over(window)
    if scan.kind == "max":
        return F.max(value).over(window)
    if scan.kind == "latest":
        return F.last(value, ignorenulls=True).over(window)
    if scan.kind == "last":
        # A struct wrapper tells "no earlier row" from an earlier null.
        return F.last(F.struct(F.col(value).alias("v"))).over(window)
    raise ValueError(f"unknown scan {scan.kind}")


def _block_total(scan: Scan, value: str, order: Column) -> Column:
    if scan.kind == "count":
        return F.count(F.lit(1))
    if scan.kind == "sum":
        return F.sum(value)
    if scan.kind == "max":
        return F.max(value)
    pick = F.min_by if scan.reverse else F.max_by
    if scan.kind == "latest":
        return pick(value, F.when(F.col(value).isNotNull(), order))
    return pick(F.struct(F.col(value).alias("v")), order)


def _finish(scan: Scan, inner: Column) -> Column:
    if scan.kind == "count":
        return F.coalesce(inner, F.lit(0)).cast("long")
    if scan.kind == "last":
        return inner["v"]
    return inner


def _merge(scan: Scan, carried: Column, inner: Column) -> Column:
    if scan.kind in ("count", "sum"):
        both = F.coalesce(carried, F.lit(0)) + F.coalesce(inner, F.lit(0))
        return F.when(carried.isNull() & inner.isNull(), F.lit(None)).otherwise(both)
    if scan.kind == "max":
        return F.greatest(carried, inner)
    return F.coalesce(inner, carried)


def prefix(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    scans: dict[str, Scan],
    *,
    reverse: bool = False,
    blocks: int | None = None,
) -> DataFrame:
    """Adds one column per entry of ``scans``, run per ``keys`` along ``order``.

    ``order`` must be unique inside a key for the result to be determined. ``reverse`` turns
    all scans round; scans of either direction share the one table that is written.
    """
    if reverse:
        scans = {name: replace(scan, reverse=True) for name, scan in scans.items()}
    staged = df
    for name, scan in scans.items():
        if scan.value is not None:
            staged = staged.withColumn(f"_in_{name}", scan.value)
    stored = in_blocks(staged, list(keys), order, blocks)
    out = _run_blocked(stored, list(keys), order, scans)
    return out.select(*[c for c in df.columns if c not in scans], *scans)


def _run(df: DataFrame, partition: Sequence[str], order: Sequence[str], scans: dict[str, Scan]) -> DataFrame:
    columns = []
    for name, scan in scans.items():
        along = [F.col(c).desc() if scan.reverse else F.col(c).asc() for c in order]
        end = Window.currentRow if scan.inclusive else -1
        frame = Window.partitionBy(*partition).orderBy(*along).rowsBetween(Window.unboundedPreceding, end)
        columns.append(_inner(scan, frame, f"_in_{name}").alias(f"_run_{name}"))
    return df.select("*", *columns)


def in_blocks(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], blocks: int | None = None
) -> DataFrame:
    """Writes ``df`` range partitioned on (key, order), numbered by ``_block``.

    Blocks are buckets of the table, told by ``_slot``.

    A key's rows lie in consecutive blocks of about the same size. The numbering is part of
    the written table, so every later reader sees the same blocks. There are as many as
    shuffle partitions unless ``blocks`` says otherwise.
    """
    spark = df.sparkSession
    parts = blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *keys, *order).withColumn("_block", F.spark_partition_id())
    slots = F.lit(_slots(spark, parts))
    placed = ranged.withColumn("_slot", F.get(slots, F.col("_block") % parts))
    name = f"tidelog_{uuid.uuid4().hex}"
    writer = placed.write.format("parquet").option("path", new_folder(spark, "blocks"))
    writer.bucketBy(parts, "_slot").saveAsTable(name)
    stored = spark.table(name)
    # The frame knows its files and buckets; the catalogue need not keep the name.
    spark.sql(f"DROP TABLE {name}")
    return stored


_SLOTS: dict[int, list[int]] = {}


def _slots(spark: SparkSession, parts: int) -> list[int]:
    """One number per bucket that hashes into it, so that every block has a bucket to itself."""
    if parts not in _SLOTS:
        bucket = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts)).alias("bucket")
        numbers = spark.range(parts * (20 + parts.bit_length())).select(F.col("id").cast("int").alias("id"), bucket)
        found = dict(numbers.groupBy("bucket").agg(F.min("id")).collect())
        _SLOTS[parts] = [found.get(bucket, bucket) for bucket in range(parts)]
    return _SLOTS[parts]


def match(table: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """``table`` with its keys renamed, and the null-safe condition that joins on them."""
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_c_{key}"))
    return table.withColumnsRenamed({key: f"_c_{key}" for key in keys}), condition


def edges(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The totals of the first and the last key of each block: no other key spans two."""
    if not keys:
        return totals
    key, block = F.struct(*keys), Window.partitionBy("_slot", "_block")
    bounded = totals.select("*", F.min(key).over(block).alias("_low"), F.max(key).over(block).alias("_high"))
    return bounded.where(key.eqNullSafe(F.col("_low")) | key.eqNullSafe(F.col("_high"))).drop("_low", "_high")


def _run_blocked(
    stored: DataFrame, keys: list[str], order: Sequence[str], scans: dict[str, Scan]
) -> DataFrame:
    local = _run(stored, [*keys, "_slot", "_block"], order, scans)

    position = F.struct(*[F.col(c) for c in order])
    totals = stored.groupBy(*keys, "_slot", "_block").agg(
        *[_block_total(scan, f"_in_{name}", position).alias(f"_total_{name}") for name, scan in scans.items()]
    )
    carried, others = [], F.lit(0)
    for name, scan in scans.items():
        along = F.col("_block").desc() if scan.reverse else F.col("_block")
        before = Window.partitionBy(*keys).orderBy(along).rowsBetween(Window.unboundedPreceding, -1)
        total = F.col(f"_total_{name}")
        if scan.kind in ("count", "sum"):
            value = F.sum(total).over(before)
        elif scan.kind == "max":
            value = F.max(total).over(before)
        else:
            value = F.last(total, ignorenulls=True).over(before)
        carried.append(value.alias(f"_carry_{name}"))
        others = others + F.count(F.lit(1)).over(before)
    carry = edges(totals, keys).select(*keys, "_block", *carried, others.alias("_others"))
    renamed, condition = match(carry.where("_others > 0").drop("_others"), [*keys, "_block"])
    # At most one key of a block goes on from an earlier block, and one into a later.
    joined = local.join(F.broadcast(renamed), condition, "left")
    for name, scan in scans.items():
        merged = _merge(scan, F.col(f"_carry_{name}"), F.col(f"_run_{name}"))
        joined = joined.withColumn(name, _finish(scan, merged))
    return joined
