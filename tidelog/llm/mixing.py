"""Mixing sources to target weights by weighted sampling without replacement.

A source whose target is e times its size and a rest takes e complete epochs, and the rest
from a sample: every document draws an exponential key divided by its quality weight, and
documents are taken in the order of their keys until the rest is used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import free_name, uniform, word_count
from tidelog.plans.prefix import Scan, prefix
from tidelog.plans.scratch import written

WEIGHTS = (3.0, 1.0, 2.0)
SEED = 7


def quality_weight(text: Column) -> Column:
    """Between 0.05 and 1: how much of a text is neither a digit nor a mark of tables or markup."""
    length = F.greatest(F.length(text), F.lit(1))
    plain = F.length(F.translate(text, "0123456789|%$&*#=<>{}[]_~^\\/@+", ""))
    return F.coalesce(0.05 + 0.95 * F.pow(plain / length, 4), F.lit(0.05))


def targets(sources: DataFrame, share: float, most: float, weights=WEIGHTS) -> DataFrame:
    """Adds weight and target to rows (source, source_size), one per source.

    Sources in code point order, null last, get the weights in turn. The targets share
    ``share`` times all sizes by weight; none exceeds ``most`` times its source's size, and
    what that frees is shared again by weight.
    """
    ranked = prefix(
        sources.withColumn("_null", F.col("source").isNull()),
        [],
        ["_null", "source"],
        {"n": Scan("count")},
    )
    turn = ((F.col("n") - 1) % len(weights)).cast("int")
    given = F.get(F.array(*[F.lit(float(w)) for w in weights]), turn)
    weighed = ranked.select("source", "source_size", given.cast("double").alias("weight"))
    # Filled by rising size per weight, the first sources meet their bound; all others get
    # the same amount per unit of weight.
    filled = prefix(
        weighed.withColumn("cap", most * F.col("source_size")).withColumn("at", F.col("cap") / F.col("weight")),
        [],
        ["at", "source"],
        {"caps": Scan("sum", F.col("cap")), "heavy": Scan("sum", F.col("weight"))},
    )
    whole = filled.agg(F.sum("source_size").alias("s"), F.sum("weight").alias("w")).first()
    total, weight = share * float(whole["s"] or 0), float(whole["w"] or 0)
    left = F.lit(weight) - F.col("heavy") + F.col("weight")
    level = (F.lit(total) - F.col("caps") + F.col("cap")) / left
    # The level of the first source that stays below its bound holds for all after it.
    found = filled.withColumn("level", level).where("level < at").agg(F.min_by("level", "at")).first()[0]
    # (none stays below when the shares use up every bound)
    target = F.col("cap") if found is None else F.least(F.col("cap"), F.lit(float(found)) * F.col("weight"))
    return filled.select("source", "source_size", "weight", target.alias("target"))


def mix(
    documents: DataFrame,
    *,
    share: float = 1.5,
    most: float = 2.0,
    weights=WEIGHTS,
    quality: Column | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Adds size, source_size, target, copies and taken to every document.

    ``copies`` says how often the mix holds the document, ``taken`` is copies times size. Of
    the documents ordered by key, those are sampled whose sizes fit the rest of the target;
    the one that crosses it is sampled if that ends nearer to the target. ``quality`` is a
    positive weight (null: least).

    Documents without words have size 0 and are taken as often as their place in the order
    says; null texts are among them. A null source is a source of its own. Repeated rows (equal
    doc_id and text) share a key, and as many of them are sampled as fit; other columns pass
    through, and columns named like the added ones are replaced. An empty table stays empty.
    Whole texts are read, of any length; one longer than the rest of a target is sampled only
    if that ends nearer to the target. Reruns agree: keys depend on doc_id, text and seed.
    """
    weight = F.greatest(F.coalesce(quality if quality is not None else quality_weight(F.col("text")), F.lit(0.0)), F.lit(1e-6))
    added = ["size", "source_size", "target", "copies", "taken"]
    keep = [c for c in documents.columns if c.lower() not in added]
    order = free_name(documents, "_key")
    key = -F.log(uniform(seed, F.col("doc_id"), F.col("text"))) / weight
    sized = documents.select(*keep, word_count(F.col("text")).alias("size"), key.alias(order))
    narrow = sized.select("source", "doc_id", F.col(order).alias("_key"), "size", F.monotonically_increasing_id().alias("_tie"))
    narrow = written(narrow, "mixture")
    totals = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    plan = targets(totals, share, most, weights)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.select(
        "source",
        F.col("source_size").cast("long").alias("source_size"),
        "target",
        F.least(epochs, F.lit(int(most))).cast("long").alias("_epochs"),
    ).withColumn("_rest", F.col("target") - F.col("_epochs") * F.col("source_size"))
    plan = written(plan.withColumnRenamed("source", "_source"), "mixture")
    summed = prefix(narrow, ["source"], ["_key", "doc_id", "size", "_tie"], {"_sum": Scan("sum", F.col("size"))})
    over = F.col("_sum") - F.col("_rest")
    fits = (over <= 0) | (over < F.col("_rest") - F.col("_sum") + F.col("size"))
    place = F.struct("_key", "doc_id", "size")
    judged = summed.join(plan, F.col("source").eqNullSafe(F.col("_source"))).select("_source", place.alias("_place"), fits.alias("_fits"))
    edge = written(judged.where("_fits").groupBy("_source").agg(F.max("_place").alias("_edge")), "mixture")
    # repeated rows may lie on both sides of the edge
    level = edge.select(F.col("_source").alias("_s"), "_edge")
    shared = judged.join(level, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_place") == F.col("_edge")))
    counts = shared.groupBy("_source").agg(F.count_if("_fits").alias("_room"), F.count(F.lit(1)).alias("_ties"))
    edge = edge.withColumnRenamed("_source", "_s").join(counts, F.col("_s").eqNullSafe(F.col("_source"))).select("_source", "_edge", "_room", "_ties")
    bounds = written(
        plan.withColumnRenamed("_source", "_s").join(edge, F.col("_s").eqNullSafe(F.col("_source")), "left").drop("_source"),
        "mixture",
    )
    split = not bounds.where("_room < _ties").isEmpty()
    clear = {c: free_name(documents, c) for c in ("_s", "_epochs", "_edge", "_room", "_sampled")}
    bounds = bounds.drop("_rest", "_ties").withColumnsRenamed(clear)
    joined = sized.join(bounds, F.col("source").eqNullSafe(F.col(clear["_s"])), "left")
    place = F.struct(F.col(order).alias("_key"), "doc_id", "size")
    edge = F.col(clear["_edge"])
    if split:
        before = joined.where(F.coalesce(place != edge, F.lit(True))).withColumn(clear["_sampled"], F.coalesce(place < edge, F.lit(False)))
        at = joined.where(place == edge).select(
            "source", F.monotonically_increasing_id().alias("_tie"), F.struct(*joined.columns).alias("_row")
        )
        numbered = prefix(at, ["source"], ["_tie"], {"_n": Scan("count")})
        sampled = F.col("_n") <= F.col("_row").getField(clear["_room"])
        joined = before.unionByName(numbered.select("_row.*", sampled.alias(clear["_sampled"])))
    else:
        joined = joined.withColumn(clear["_sampled"], F.coalesce(place <= edge, F.lit(False)))
    sampled = F.col(clear["_sampled"])
    copies = F.least(F.col(clear["_epochs"]) + F.when(sampled, 1).otherwise(0), F.lit(int(most)))
    return joined.withColumn("copies", copies.cast("long")).select(
        *keep,
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed(documents: DataFrame, **how) -> DataFrame:
    """The mix itself: every document as often as ``mix`` says, with its own columns, also
    those named like a column that ``mix`` adds."""
    added = ["size", "source_size", "target", "copies", "taken"]
    aside = {c: free_name(documents, f"_own_{c}") for c in documents.columns if c.lower() in added}
    plan = mix(documents.withColumnsRenamed(aside), **how)
    times = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    chosen = plan.where("copies > 0").withColumn(free_name(plan, "_time"), times)
    return chosen.select(*[F.col(aside.get(c, c)).alias(c) for c in documents.columns])
