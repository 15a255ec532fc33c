"""A quality classifier: perplexity under a language model of trusted text.

The model is an interpolated modified Kneser-Ney model over byte n-grams, counted in all trusted
texts. Its counts stay a table. Every block of documents asks for the n-grams it holds; joins
with the counts, sharded by n-gram, give their probabilities, which go back to the blocks. A
document is rejected if its perplexity exceeds a quantile of what trusted documents of its
language have that the model was not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.blocks import BLOCK_ROWS, Blocked, answered, in_blocks
from tidelog.llm.common import Stored, shuffled

ORDER = 5
QUANTILE = 0.99
FOLDS = 5
SYMBOLS = 256
PART = 1 << 18
SHORT = 2  # bytes of n-grams of which there are few: their tables may be broadcast
_START = b"\n" * (ORDER - 1)  # what a text is taken to follow


def grams(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """n-grams of the texts, as packed bytes, with the place of their text; some at a time."""
    held, owners, size = [], [], 0
    for place, text in enumerate(texts):
        data = _START + (text or "").encode("utf-8", "surrogatepass")
        for lo in range(0, max(len(data) - ORDER + 1, 0), PART):
            codes = np.frombuffer(data[lo : lo + PART + ORDER - 1], np.uint8).astype(np.int64)
            key = np.zeros(len(codes) - ORDER + 1, np.int64)
            for i in range(ORDER):
                key = (key << 8) | codes[i : len(codes) - ORDER + 1 + i]
            held.append(key)
            owners.append(np.full(len(key), place))
            size += len(key)
            if size >= PART:
                yield np.concatenate(held), np.concatenate(owners)
                held, owners, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(owners)


def _distinct(texts: list[str | None]) -> np.ndarray:
    return np.unique(np.concatenate([np.unique(k) for k, _ in grams(texts)] or [np.empty(0, np.int64)]))


def _counted(own: pa.Table, chosen: pa.Table, row: str) -> pa.Table:
    """Counts of the n-grams in the chosen rows of a block."""
    texts = own.filter(pc.is_in(own.column(row), chosen.column("_row").combine_chunks())).column("text")
    keys, counts = np.empty(0, np.int64), np.empty(0, np.int64)
    for lo in range(0, len(texts), 128):
        for key, _ in grams(texts.slice(lo, 128).to_pylist()):
            found, many = np.unique(key, return_counts=True)
            keys, at = np.unique(np.concatenate((keys, found)), return_inverse=True)
            counts = np.bincount(at, np.concatenate((counts, many)), len(keys)).astype(np.int64)
    return pa.table({"gram": keys, "count": counts})


def _mask(order: int) -> Column:
    return F.lit((1 << (8 * order)) - 1).cast("long")


def _looked_up(table: DataFrame, length: int) -> DataFrame:
    """``table``, of n-grams of that many bytes, as a side of a join."""
    return table if length <= SHORT else shuffled(table)


class Model:
    """Tables of n-gram probabilities and of back-off weights, one of each per order."""

    def __init__(self, counts: DataFrame, order: int = ORDER):
        self.order = order
        counted = {order: Stored(counts.groupBy("gram").agg(F.sum("count").alias("c")), "grams").df}
        for k in range(order - 1, 0, -1):
            lower = counted[k + 1].groupBy(F.col("gram").bitwiseAND(_mask(k)).alias("gram"))
            counted[k] = Stored(lower.agg(F.count(F.lit(1)).alias("c")), "grams").df
        self.weights: dict[int, DataFrame] = {}
        self.chances: dict[int, DataFrame] = {}
        for k in range(1, order + 1):
            self._add(k, counted[k])

    def _add(self, k: int, counted: DataFrame) -> None:
        d = _discounts(counted)
        context = F.shiftright("gram", 8).alias("context")
        of = counted.groupBy(context).agg(
            F.sum("c").alias("total"),
            F.sum(F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])).alias("freed"),
        )
        self.weights[k] = Stored(of.select("context", "total", (F.col("freed") / F.col("total")).alias("weight")), "weights").df
        taken = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        own = counted.withColumn("context", context).join(_looked_up(self.weights[k], k - 1), "context")
        seen = own.select("gram", "weight", ((F.col("c") - taken) / F.col("total")).alias("own"))
        if k == 1:
            chance = seen.select("gram", (F.col("own") + F.col("weight") / SYMBOLS).alias("p"))
        else:
            lower = self.chances[k - 1].select(F.col("gram").alias("suffix"), F.col("p").alias("below"))
            joined = seen.join(_looked_up(lower, k - 1), F.col("gram").bitwiseAND(_mask(k - 1)) == F.col("suffix"))
            chance = joined.select("gram", (F.col("own") + F.col("weight") * F.col("below")).alias("p"))
        self.chances[k] = Stored(chance, "chances").df

    def probability(self, keys: DataFrame) -> DataFrame:
        """Rows (key, p) for distinct n-grams of full order."""
        out = keys.select("key")
        p, scale = F.lit(None).cast("double"), F.lit(1.0)
        for k in range(self.order, 0, -1):
            part = F.col("key").bitwiseAND(_mask(k))
            chance = self.chances[k].select(F.col("gram").alias("g"), F.col("p").alias(f"p{k}"))
            out = out.join(_looked_up(chance, k), part == F.col("g"), "left").drop("g")
            if k > 1:
                weight = self.weights[k].select("context", F.col("weight").alias(f"w{k}"))
                out = out.join(_looked_up(weight, k - 1), F.shiftright(part, 8) == F.col("context"), "left").drop("context")
            p = F.coalesce(p, scale * F.col(f"p{k}"))
            if k > 1:
                scale = scale * F.coalesce(F.col(f"w{k}"), F.lit(1.0))
        # a byte never seen has what the order-1 weight leaves for each symbol
        rest = self.weights[1].select((F.col("weight") / SYMBOLS).alias("rest")).first()
        floor = float(rest[0]) if rest else 1.0 / SYMBOLS
        return out.select("key", F.coalesce(p, scale * F.lit(max(floor, 1e-12))).alias("p"))


def _discounts(counted: DataFrame) -> list[float]:
    """The three discounts of modified Kneser-Ney smoothing, from counts of counts."""
    n = counted.agg(*[F.count(F.when(F.col("c") == i, 1)) for i in (1, 2, 3, 4)]).first()
    if not all(n):
        return [0.5, 0.75, 0.9]  # too few n-grams to estimate them
    y = n[0] / (n[0] + 2 * n[1])
    found = [i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3)]
    return [min(max(d, 0.05), i + 0.95) for i, d in enumerate(found)]


def held_out(doc_id: Column) -> Column:
    """Trusted documents that set the thresholds; the model is trained on the others."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0


def perplexities(blocked: Blocked, model: Model, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and ``perplexity`` per byte (null for texts without bytes)."""

    def resolve(grouped: DataFrame) -> DataFrame:
        asked = Stored(grouped, "requests").df
        chances = model.probability(asked.select("key").distinct())
        return asked.join(shuffled(chances), "key").select("key", "askers", (-F.log2("p")).alias("bits"))

    def finish(own: pa.Table, answers: pa.Table | None) -> pa.Table:
        if answers is None:
            return own.append_column("perplexity", pa.nulls(own.num_rows, pa.float64()))
        keys, bits = answers.column("key").to_numpy(), answers.column("bits").to_numpy()
        order = np.argsort(keys)
        keys, bits = keys[order], bits[order]
        spent, sizes = np.zeros(own.num_rows), np.zeros(own.num_rows)
        for lo in range(0, own.num_rows, 128):
            for key, place in grams(own.column("text").slice(lo, 128).to_pylist()):
                place = place + lo
                spent += np.bincount(place, bits[np.searchsorted(keys, key)], own.num_rows)
                sizes += np.bincount(place, minlength=own.num_rows)
        found = np.exp2(spent / np.maximum(sizes, 1))
        return own.append_column("perplexity", pa.array(found, mask=sizes == 0))

    return answered(
        blocked,
        ask=_distinct,
        key_type=T.LongType(),
        resolve=resolve,
        finish=finish,
        added=[T.StructField("perplexity", T.DoubleType())],
        keep=keep,
    )


def judge(documents: DataFrame, trusted: DataFrame, *, quantile: float = QUANTILE, rows: int = BLOCK_ROWS):
    """The documents in blocks, and a stored table of verdicts about them.

    Verdicts: _block, _row, doc_id, lang, perplexity, threshold, keep. ``trusted`` names (in
    doc_id) the trusted documents; those of one fold of five are left out of the training, and
    their perplexities give each language its threshold, at ``quantile`` (an approximate
    percentile, within a ten-thousandth of the rank), or at the language's median times that
    quantile of all languages' perplexities over their medians, if that is larger.

    A document is kept unless its perplexity exceeds its language's threshold: texts without
    bytes, null texts among them, have no perplexity and are kept, and so are documents of
    languages without held-out trusted documents. A null lang is a language of its own. Rows
    with a null doc_id are never trusted, repeated rows are judged each, extra columns stay
    with the blocked documents; an empty table gives no verdicts.
    """
    blocked = in_blocks(documents, rows)
    numbered = blocked.table.select(F.col(blocked.block).alias("_block"), F.col(blocked.row).alias("_row"), "doc_id")
    names = trusted.select("doc_id").where("doc_id is not null").distinct()
    chosen = Stored(numbered.join(shuffled(names), "doc_id"), "trusted").df
    row = blocked.row
    training = chosen.where(~held_out(F.col("doc_id"))).select("_block", "_row")
    counts = blocked.with_rows(training, lambda own, other: _counted(own, other, row), T.StructType().add("gram", "long").add("count", "long"), ["text"])
    scored = perplexities(blocked, Model(counts), [blocked.block, blocked.row, "doc_id", "lang"])
    renamed = scored.withColumnsRenamed({blocked.block: "_block", blocked.row: "_row"})
    found = Stored(renamed, "perplexities").df
    calibration = found.join(shuffled(chosen.where(held_out(F.col("doc_id"))).select("_row")), "_row", "left_semi")
    own = calibration.groupBy(F.col("lang").alias("_lang")).agg(
        F.percentile_approx("perplexity", 0.5, 10_000).alias("median"),
        F.percentile_approx("perplexity", quantile, 10_000).alias("own"),
    )
    # Languages with few trusted documents borrow the spread of all of them.
    shared = calibration.join(own, F.col("lang").eqNullSafe(F.col("_lang"))).agg(
        F.percentile_approx(F.col("perplexity") / F.col("median"), quantile, 10_000)
    ).first()[0]
    bounds = own.select("_lang", F.greatest("own", F.col("median") * F.lit(float(shared or 1.0))).alias("threshold"))
    judged = found.join(bounds, F.col("lang").eqNullSafe(F.col("_lang")), "left").drop("_lang")
    return blocked, judged.withColumn("keep", F.coalesce(F.col("perplexity") <= F.col("threshold"), F.lit(True)))


def accepted(documents: DataFrame, trusted: DataFrame, **how) -> DataFrame:
    """The documents that are kept, with their own columns."""
    blocked, verdicts = judge(documents, trusted, **how)
    return blocked.keep(verdicts.where("keep"))
