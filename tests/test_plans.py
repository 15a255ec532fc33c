"""Blocked scans and bucketed joins give what plain windows and joins give."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog.operators import replay
from tidelog.plans.interval import covering
from tidelog.plans.prefix import Scan, prefix
from tidelog.plans.scratch import drop_scratch, new_folder, shared_folder, written

def scans():
    value = F.col("v")
    return {
        "n_before": Scan("count", inclusive=False),
        "n": Scan("count"),
        "total": Scan("sum", value),
        "high": Scan("max", value),
        "lagged": Scan("last", value, inclusive=False),
        "seen": Scan("latest", value),
        "seen_before": Scan("latest", value, inclusive=False),
    }


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds most rows, another is null, and a third of the values are missing."""
    key = F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), F.col("id") % 7)).when(
        F.col("id") % 29 != 0, F.lit("hot")
    )
    value = F.when(F.col("id") % 3 != 1, F.pmod(F.xxhash64("id"), F.lit(1000)))
    return spark.range(4000).select(key.alias("k"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(10**12)).alias("o"), value.alias("v"))


@pytest.mark.parametrize("reverse", [False, True])
def test_blocked_scan_equals_window(skewed, reverse):
    plain = prefix(skewed, ["k"], ["o"], scans(), reverse=reverse, blocks=1)
    blocked = prefix(skewed, ["k"], ["o"], scans(), reverse=reverse, blocks=16)
    assert plain.columns == blocked.columns
    assert sorted(map(repr, plain.collect())) == sorted(map(repr, blocked.collect()))


def test_both_directions_share_one_table(skewed):
    both = {"n": Scan("count"), "rest": Scan("sum", F.col("v"), inclusive=False, reverse=True)}
    found = prefix(skewed, ["k"], ["o"], both, blocks=9)
    window = Window.partitionBy("k").orderBy("o")
    wanted = skewed.select(
        "*", F.count(F.lit(1)).over(window.rowsBetween(Window.unboundedPreceding, 0)).alias("n"),
        F.sum("v").over(window.rowsBetween(1, Window.unboundedFollowing)).alias("rest"),
    )
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))


def test_scan_without_keys_or_rows(skewed):
    found = prefix(skewed.select("o"), [], ["o"], {"n": Scan("count")}, blocks=7).collect()
    assert [r.n for r in sorted(found, key=lambda r: r.o)] == list(range(1, 4001))
    assert prefix(skewed.where("false"), ["k"], ["o"], {"n": Scan("count")}).count() == 0


def test_blocks_are_scanned_where_they_lie(skewed):
    """One shuffle of the rows, when they are written: the windows need none."""
    frame = prefix(skewed, ["k"], ["o"], {"n": Scan("count")}, blocks=8)
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    rows = plan[: plan.index("BroadcastExchange")] if "BroadcastExchange" in plan else plan
    assert "Window" in rows and "Exchange" not in rows.replace("BroadcastExchange", "").split("BroadcastQueryStage")[0]


def test_blocks_split_the_hot_key(skewed):
    from tidelog.plans.prefix import in_blocks

    sizes = in_blocks(skewed, ["k"], ["o"], 16).groupBy("_block").count().collect()
    assert len(sizes) > 10
    assert max(s["count"] for s in sizes) < 1000


@pytest.mark.parametrize("scale", [1, 37, 4096])
def test_covering_equals_range_join(spark, scale):
    """Intervals from one position to the whole span, open ones, empty ones and such outside."""
    points = spark.range(800).select(
        F.when(F.col("id") % 4 == 0, "a").otherwise("hot").alias("k"), (F.col("id") * 3 - 50).alias("p")
    )
    length = F.pmod(F.xxhash64("id"), F.col("id") * scale + 2)
    spans = spark.range(90).select(
        F.col("id").alias("span"),
        F.when(F.col("id") % 5 == 0, "a").when(F.col("id") % 5 == 1, "none").otherwise("hot").alias("k"),
        (F.col("id") * 50 - 300).alias("s"),
        F.when(F.col("id") % 7 != 0, F.col("id") * 50 - 300 + length).alias("e"),
    )
    found = covering(points, spans, ["k"], "p", "s", "e").select("k", "p", "span")
    on = (points.k == spans.k) & (points.p >= spans.s) & (spans.e.isNull() | (points.p < spans.e))
    wanted = points.join(spans, on).select(points.k, "p", "span")
    assert sorted(map(repr, found.collect())) == sorted(map(repr, wanted.collect()))


def test_covering_copies_an_interval_twice_at_most(spark):
    """Whatever the lengths; a point is copied once per grid in use."""
    points = spark.range(1000).select(F.lit("a").alias("k"), F.col("id").alias("p"))
    spans = spark.range(60).select(
        F.lit("a").alias("k"), (F.col("id") * 16).alias("s"), (F.col("id") * 16 + F.pow(2, F.col("id") % 10)).cast("long").alias("e")
    )
    plan = covering(points, spans, ["k"], "p", "s", "e")
    assert "sequence(" not in plan._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count() == points.join(spans, (F.col("p") >= F.col("s")) & (F.col("p") < F.col("e"))).count()


def test_covering_without_points(spark):
    points = spark.createDataFrame([], "k string, p long")
    spans = spark.createDataFrame([("a", 1, None)], "k string, s long, e long")
    assert covering(points, spans, ["k"], "p", "s", "e").count() == 0


def test_scratch_uses_the_named_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")


def test_dropping_scratch_removes_only_what_was_made(spark, tmp_path):
    mine = written(spark.range(3), "mine")
    assert mine.count() == 3
    other = tmp_path / "other"
    spark.range(1).write.parquet(str(other))
    never = new_folder(spark, "never")
    assert drop_scratch(spark) >= 1
    assert other.exists()
    assert never not in [str(p) for p in tmp_path.iterdir()]
    assert drop_scratch(spark) == 0


def test_starts_of_many_shards_are_resolved_in_all_partitions(spark):
    stream = F.concat(F.lit("s"), (F.col("id") % 1).cast("string")).alias("stream")
    shards = spark.range(20_000).select(stream, F.col("id").cast("string").alias("shard_id"))
    points = shards.withColumn("checkpoint", F.lit("5")).where("shard_id like '%7'")
    installed = spark.createDataFrame([("s0", "horizon", None)], "stream string, kind string, ts_ms long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for position in (None, installed):
            starts = replay.resolve_starts(shards, points, position, "recover")
            held = starts.groupBy(F.spark_partition_id().alias("part")).count().collect()
            assert sum(r["count"] for r in held) == 20_000, held
            assert max(r["count"] for r in held) < 10_000, held
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
