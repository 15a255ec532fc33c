"""Points joined to the intervals that cover them, per key.

Time is cut into grids whose cells grow fourfold from one to the next. An interval goes into the
grid whose cells are just as long as it is, where it touches two cells at most, whatever its
length and however unlike the lengths are. A point goes into its cell of every grid in use. The
join is an equi-join on (key, grid, cell) followed by the exact bounds, so only points and
intervals meet that are near each other on the scale of the interval: a cell's points reach four
lengths of the interval around it at most.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def span_of(points: DataFrame, point: str) -> tuple[int, int]:
    """Smallest and largest point; (0, 0) when there is none."""
    low, high = points.agg(F.min(point), F.max(point)).first()
    return (0, 0) if low is None else (low, high)


def _grid(length: Column) -> Column:
    """The least even number of bits whose power of two is ``length`` or more."""
    bits = F.when(length > 1, F.length(F.bin(length - 1))).otherwise(0)
    return (bits + bits % 2).cast("int")


def _cell(position: Column, bits: str) -> Column:
    return F.call_function("shiftright", position.cast("long"), F.col(bits))


def covering(
    points: DataFrame,
    intervals: DataFrame,
    on: Sequence[str],
    point: str,
    start: str,
    end: str,
    *,
    span: tuple[int, int] | None = None,
) -> DataFrame:
    """Rows of ``points`` with every interval of the same key where start <= point < end.

    ``end`` null means still open. ``point``, ``start`` and ``end`` are integers. ``span`` is
    :func:`span_of` the points where it is known already.
    """
    low, high = span_of(points, point) if span is None else span
    last = F.least(F.col(end) - 1, F.lit(high)) - low
    first = F.greatest(F.col(start), F.lit(low)) - low
    placed = intervals.where(first <= last).withColumn("_grid", _grid(last - first + 1))
    grids = sorted(row[0] for row in placed.select("_grid").distinct().collect())
    cells = F.explode(F.array_distinct(F.array(_cell(first, "_grid"), _cell(last, "_grid"))))
    spread = placed.withColumn("_cell", cells)
    renamed = spread.select(
        *[F.col(c).alias(f"_r_{c}") for c in [*on, start, end, "_grid", "_cell"]],
        *[c for c in intervals.columns if c not in {*on, start, end}],
    )
    used = F.array(*[F.lit(g) for g in grids]).cast("array<int>")
    keyed = points.withColumn("_grid", F.explode(used))
    keyed = keyed.withColumn("_cell", _cell(F.col(point) - low, "_grid"))
    condition = (F.col("_grid") == F.col("_r__grid")) & (F.col("_cell") == F.col("_r__cell"))
    for key in on:
        condition = condition & (F.col(key) == F.col(f"_r_{key}"))
    condition = condition & (F.col(point) >= F.col(f"_r_{start}"))
    condition = condition & (F.col(f"_r_{end}").isNull() | (F.col(point) < F.col(f"_r_{end}")))
    joined = keyed.join(renamed, condition)
    return joined.drop("_grid", "_cell", "_r__grid", "_r__cell", *[f"_r_{c}" for c in [*on, start, end]])
