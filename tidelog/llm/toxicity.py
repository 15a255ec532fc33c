"""Toxicity scores of texts, robust to disguised spelling.

A word that hides its letters (digits and signs for letters, marks or spaces between letters,
letters repeated) spans a lattice of what each character may stand for. A Viterbi search under
a character language model, learned from all texts, restores the likeliest spelling. Restored
words and their beginnings are then scored with weights learned from labelled texts.
"""

from __future__ import annotations

import heapq
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.blocks import in_blocks
from tidelog.llm.common import Stored

# What a character may stand for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "tl", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "li", "+": "t", "(": "c", "<": "c", "{": "c", "[": "c",
    "€": "e", "£": "l", "¥": "y", "¢": "c",
}
WILD = "*#"
BEAM = 48  # paths a search goes on with
BETWEEN = " .,-_*~'·​­/"

LETTERS = "abcdefghijklmnopqrstuvwxyz"
EDGE = 0  # code of a word's edge; letters are 1 to 26
SIZE = len(LETTERS) + 1
CONTEXT = 3
# Language model rows: one per run of four codes, at most. A proven bound for what is broadcast.
STATES = SIZE**CONTEXT
# Costs in nats of what the channel does.
COST_KEEP, COST_SWAP, COST_DROP, COST_WILD, COST_REPEAT = 0.0, 0.7, 0.7, 3.0, 0.4
COST_CUTS = (0.0, 3.0)  # a word's edge within a run of single characters; both readings count
INSIDE = 4  # letters of a weighed word that is seen within such a run, wherever it is cut

MAX_FEATURES = 4_096  # weights the model may have
MIN_DOCS = 5  # labelled toxic texts a feature must be in
PREFIXES = (4, 5, 6)
FIT_ROWS = 20_000  # labelled rows the last two coefficients are fitted on
FOLDS = 5
MEMO = 500_000  # tokens a task remembers; the others are read again

_SPACED = re.compile(r"(?<!\S)\S(?:[ \t]+\S){2,}(?!\S)")
_PLAIN = re.compile(r"[a-z]+\Z")
_TRIPLE = re.compile(r"([^\W\d_])\1\1")
_STRIP = ".,;:?\"'()[]{}<>«»“”‘’…-_*#%&~=^`"


def fold(word: str) -> str:
    """Lower case, full-width and look-alike forms and accents reduced to plain letters."""
    found = unicodedata.normalize("NFKD", word.casefold())
    return "".join(c for c in found if not unicodedata.combining(c))


class LanguageModel:
    """Log chances of a code after three codes, from counts of runs of four."""

    def __init__(self, counts: np.ndarray):
        shaped = counts.reshape(STATES, SIZE).astype(np.float64)
        below = shaped.reshape(SIZE, SIZE * SIZE, SIZE).sum(0)
        least = below.reshape(SIZE, SIZE, SIZE).sum(0)
        single = least.sum(0)
        chance = (single + 1) / (single.sum() + SIZE)
        for table in (least, below, shaped):
            rest = np.tile(chance, (len(table) // len(chance), 1)) if chance.ndim > 1 else chance[None, :]
            kinds = (table > 0).sum(1, keepdims=True) + 1.0
            chance = (table + kinds * rest) / (table.sum(1, keepdims=True) + kinds)
        self.cost = -np.log(chance).astype(np.float32).ravel()

    def after(self, state: int, code: int) -> float:
        return float(self.cost[state * SIZE + code])


def _options(word: str) -> list[list[tuple[str, float]]]:
    """For each character, what it may stand for (empty: nothing) and at what cost."""
    out = []
    for at, c in enumerate(word):
        own: dict[str, float] = {}
        if c in LETTERS:
            own[c] = COST_KEEP
            if at and word[at - 1] == c:
                own[""] = COST_REPEAT
        else:
            for letter in STANDS_FOR.get(c, ""):
                own[letter] = COST_SWAP
            if c in WILD and 0 < at < len(word) - 1 and not {word[at - 1], word[at + 1]} & set(WILD):
                own.update(dict.fromkeys(LETTERS, COST_WILD))
            if c in BETWEEN or c in WILD or not own:
                own[""] = COST_DROP
            elif at and word[at - 1] == c:
                own[""] = COST_REPEAT
        out.append(list(own.items()))
    return out


def _search(options: list[list[tuple[str, float]]], model: LanguageModel, cut: float | None) -> str:
    """The likeliest letters; with ``cut``, words may end between letters at that cost, and
    spaces part them."""
    paths: dict[int, tuple[float, str]] = {0: (0.0, "")}
    done: list[str] = []
    for at, own in enumerate(options):
        following: dict[int, tuple[float, str]] = {}
        for state, (spent, text) in paths.items():
            for letter, cost in own:
                if letter:
                    code = ord(letter) - 96
                    total = spent + cost + model.after(state, code)
                    to = (state * SIZE + code) % STATES
                    said = text + letter
                else:
                    total, to, said = spent + cost, state, text
                if to not in following or total < following[to][0]:
                    following[to] = (total, said)
        if cut is not None:
            ends = [(spent + cut + model.after(state, EDGE), text + " ") for state, (spent, text) in following.items() if state]
            if ends and (0 not in following or min(ends) < following[0]):
                following[0] = min(ends)
        if len(following) > BEAM:
            following = dict(heapq.nsmallest(BEAM, following.items(), key=lambda p: p[1]))
        paths = following
        if at % 64 == 63:
            # what all paths begin with is settled, so a long run costs no more for each letter
            settled = os.path.commonprefix([text for _, text in paths.values()])
            done.append(settled)
            paths = {state: (spent, text[len(settled) :]) for state, (spent, text) in paths.items()}
    last = min((spent + (model.after(state, EDGE) if state or cut is None else 0.0), text) for state, (spent, text) in paths.items())
    return "".join([*done, last[1]])


def restore(word: str, model: LanguageModel) -> str:
    """The likeliest letters behind a folded word."""
    return _search(_options(word), model, None)


def restore_words(run: str, model: LanguageModel) -> set[str]:
    """The likeliest words behind folded characters without word breaks."""
    options = _options(run)
    return {word for cut in COST_CUTS for word in _search(options, model, cut).split()}


def _hidden(word: str) -> bool:
    return not _PLAIN.match(word) or _TRIPLE.search(word) is not None


class Reader:
    """Reads tokens as written and restored, each new one once."""

    def __init__(self, model: LanguageModel):
        self.model = model
        self.memo: dict[str, tuple[str, ...]] = {}

    def token(self, token: str) -> tuple[str, ...]:
        if token.isascii():
            bare = token.lower().strip(_STRIP)
            if bare.isalpha() and not _TRIPLE.search(bare):
                return (bare,)
        else:
            bare = fold(token).strip(_STRIP)
        said = {"".join(filter(str.isalpha, bare))}
        if _hidden(bare) and any(c.isalpha() or c in STANDS_FOR for c in bare):
            # a long run is restored piece by piece
            said.update(restore(bare[lo : lo + 64], self.model) for lo in range(0, len(bare), 64))
        return tuple(w for w in said if w)

    def spaced(self, text: str) -> set[str]:
        """The words that runs of single characters spell; such runs do not show word breaks."""
        found = set()
        for match in _SPACED.finditer(text):
            joined = fold("".join(match.group().split()))
            for lo in range(0, len(joined), 48):
                found.add(restore(joined[lo : lo + 64], self.model))
            found.update(restore_words(joined, self.model))
        found.discard("")
        return found

    def words(self, text: str) -> set[str]:
        """The distinct words of a text."""
        found = self.spaced(text)
        for token in set(text.split()):
            known = self.memo.get(token)
            if known is None:
                known = self.token(token)
                if len(self.memo) < MEMO:
                    self.memo[token] = known
            found.update(known)
        return found


class Scorer:
    """Evidence of texts; tokens known to weigh nothing are passed over."""

    def __init__(self, model: LanguageModel, classifier: Classifier):
        self.reader, self.classifier = Reader(model), classifier
        self.lengths = sorted({len(f) for f in classifier.weights if len(f) >= INSIDE and f[-1] != "|"})
        self.light: set[str] = set()
        self.heavy: dict[str, list[tuple[str, float]]] = {}

    def weighed(self, words) -> list[tuple[str, float]]:
        return [(w, x) for w in words if (x := self.classifier.weight(w)) > 0]

    def inside(self, run: str) -> set[str]:
        """The weighed words a spaced run holds where no edge was put around them."""
        parts = (run[at : at + n] for n in self.lengths for at in range(len(run) - n + 1))
        return {part for part in parts if part in self.classifier.weights}

    def evidence(self, text: str) -> float:
        spaced = self.reader.spaced(text)
        found = dict(self.weighed(spaced.union(*map(self.inside, spaced))))
        for token in set(text.split()).difference(self.light):
            known = self.heavy.get(token)
            if known is None:
                known = self.weighed(self.reader.token(token))
                if known:
                    self.heavy[token] = known
                elif len(self.light) < MEMO:
                    self.light.add(token)
            found.update(known)
        return sum(found.values())


def features(words: set[str]) -> set[str]:
    """Whole words and their beginnings (marked with a trailing bar)."""
    return words | {w[:n] + "|" for w in words for n in PREFIXES if len(w) > n}


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _run_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of runs of four codes in the plain words of a task's texts."""
    counts = np.zeros(STATES * SIZE, np.int64)
    codes = np.zeros(256, np.int64)
    codes[ord("a") : ord("z") + 1] = np.arange(1, 27)
    codes[ord("A") : ord("Z") + 1] = np.arange(1, 27)
    for batch in batches:
        column = batch.column(0)
        for lo in range(0, len(column), 256):
            texts = [t for t in column.slice(lo, 256).to_pylist() if t]
            data = np.frombuffer(" ".join(texts).encode("utf-8", "surrogatepass"), np.uint8)
            for part in range(0, len(data), 1 << 22):
                run = np.concatenate(([EDGE] * CONTEXT, codes[data[part : part + (1 << 22)]], [EDGE]))
                edge = run == EDGE
                # what lies before the last edge is no context
                a, b, c, d = run[:-3].copy(), run[1:-2].copy(), run[2:-1], run[3:]
                b[edge[2:-1]] = EDGE
                a[edge[2:-1] | edge[1:-2]] = EDGE
                real = ~(edge[3:] & edge[2:-1])
                key = ((a * SIZE + b) * SIZE + c) * SIZE + d
                counts += np.bincount(key[real], minlength=len(counts))
    held = np.flatnonzero(counts)
    if len(held):
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(counts[held])], names=["run", "n"])


def language_model(documents: DataFrame) -> LanguageModel:
    """Counts of all texts; at most 27^4 of them, so they fit the driver and a task."""
    runs = documents.select("text").mapInArrow(_run_counts, "run long, n long").groupBy("run").agg(F.sum("n").alias("n"))
    counts = np.zeros(STATES * SIZE)
    for row in runs.toLocalIterator():
        counts[row["run"]] = row["n"]
    return LanguageModel(counts)


class Classifier:
    """Weights of features, and the two coefficients that turn evidence into a chance."""

    def __init__(self, weights: dict[str, float], scale: float = 1.0, base: float = -3.0):
        self.weights, self.scale, self.base = weights, scale, base

    def weight(self, word: str) -> float:
        """The weight of a word: that of itself or of its beginnings, the largest."""
        own = self.weights.get(word, 0.0)
        for n in PREFIXES:
            if len(word) > n:
                own = max(own, self.weights.get(word[:n] + "|", 0.0))
        return own


def _weights(labelled: DataFrame, model: LanguageModel) -> dict[str, float]:
    """Log odds of the features that speak for toxicity the most.

    Every labelled text votes once per feature. A feature counts if its share of toxic texts
    lies over that of the others by a clear margin (five standard errors).
    """

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(model)
        tally: dict[str, list[int]] = {}

        def told():
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(tally)), pa.array([v[0] for v in tally.values()], pa.int64()), pa.array([v[1] for v in tally.values()], pa.int64())],
                names=["feature", "toxic", "other"],
            )
            tally.clear()

        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for feature in features(reader.words(text or "")):
                    tally.setdefault(feature, [0, 0])[0 if toxic else 1] += 1
                if len(tally) > 300_000:
                    yield from told()
        yield from told()

    total = labelled.groupBy("toxic").count().collect()
    sizes = {bool(r["toxic"]): r["count"] for r in total}
    toxic, other = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic or not other:
        return {}
    counted = (
        labelled.select("text", "toxic")
        .mapInArrow(votes, "feature string, toxic long, other long")
        .groupBy("feature")
        .agg(F.sum("toxic").alias("a"), F.sum("other").alias("b"))
        .where(F.col("a") >= MIN_DOCS)
    )
    share = F.col("a") / toxic
    rest = F.col("b") / other
    pooled = (F.col("a") + F.col("b")) / (toxic + other)
    error = F.sqrt(pooled * (1 - pooled) * (1 / toxic + 1 / other))
    odds = F.log((F.col("a") + 0.5) / (toxic + 1)) - F.log((F.col("b") + 0.5) / (other + 1))
    strong = counted.where((share - rest > 5 * error) & (odds > 2.0))
    best = strong.select("feature", odds.alias("odds"), (share - rest).alias("gain")).orderBy(F.col("gain").desc(), "feature").limit(MAX_FEATURES)
    return {r["feature"]: float(r["odds"]) for r in best.collect()}


def _fit(evidence: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Scale and base of a logistic curve, by Newton steps with a small penalty."""
    x = np.stack((evidence, np.ones_like(evidence)), 1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        pull = np.array([0.1, 0.0])
        slope = x.T @ (p - labels) + pull * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-6)
        w -= np.clip(np.linalg.solve(bend, slope), -5, 5)
    return max(float(w[0]), 0.05), float(w[1])


def train(documents: DataFrame, labels: DataFrame) -> tuple[LanguageModel, Classifier]:
    """The language model of all texts, and a classifier of those labelled outside the held-out
    fold. Feature weights are learned from all of these; the two coefficients of the score from
    ``FIT_ROWS`` of them at most, those with the least hashes."""
    model = language_model(documents)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).alias("toxic"))
    # The labels go to the blocks of their documents; the texts are not shuffled.
    blocked = in_blocks(documents.select("doc_id", "text"))
    numbered = blocked.table.select(F.col(blocked.block).alias("_block"), F.col(blocked.row).alias("_row"), "doc_id")
    chosen = Stored(numbered.join(known, "doc_id").select("_block", "_row", "toxic"), "labels").df
    row = blocked.row

    def pick(own: pa.Table, others: pa.Table) -> pa.Table:
        told = dict(zip(others.column("_row").to_pylist(), others.column("toxic").to_pylist(), strict=True))
        part = own.filter(pc.is_in(own.column(row), others.column("_row").combine_chunks()))
        toxic = pa.array([told[r] for r in part.column(row).to_pylist()], pa.bool_())
        return part.select(["doc_id", "text"]).append_column("toxic", toxic)

    schema = T.StructType([*blocked.schema.fields, T.StructField("toxic", T.BooleanType())])
    kept = Stored(blocked.with_rows(chosen, pick, schema), "labelled")
    rough = Classifier(_weights(kept.df, model))
    told = score_evidence(kept.df, model, rough).select("_evidence", "toxic", F.xxhash64("doc_id").alias("h"))
    sample = told.orderBy("h").limit(FIT_ROWS).collect()
    kept.delete()
    if rough.weights:
        rough.scale, rough.base = _fit(np.array([r["_evidence"] for r in sample]), np.array([float(r["toxic"]) for r in sample]))
    return model, rough


def score_evidence(documents: DataFrame, model: LanguageModel, classifier: Classifier) -> DataFrame:
    """Adds column ``_evidence`` and drops the text."""
    kept = [c for c in documents.columns if c != "text"]
    schema = T.StructType([*[f for f in documents.schema.fields if f.name != "text"], T.StructField("_evidence", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model, classifier)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            found = [scorer.evidence(t.as_py() or "") for t in texts]
            columns = [batch.column(batch.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], names=[*kept, "_evidence"])

    return documents.select(*kept, "text").mapInArrow(run, schema)


def score(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows doc_id, held_out, score, predicted: one per document.

    Labels are learned only from rows whose crc32(doc_id) mod 5 is not 0; ``held_out`` marks the
    others. The score is the chance of label 1 by the words of the whole text, and nothing else
    of the document. Empty and null texts hold no words and get the least score. Without labels
    of both kinds every score is the base chance. A null doc_id counts as not held out; repeated
    rows are scored each; other columns are ignored; an empty table gives no rows.
    """
    model, classifier = train(documents, labels)
    told = score_evidence(documents.select("doc_id", "text"), model, classifier)
    x = F.greatest(F.least(F.lit(classifier.base) + F.lit(classifier.scale) * F.col("_evidence"), F.lit(50.0)), F.lit(-50.0))
    chance = 1.0 / (1.0 + F.exp(-x))
    scored = told.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), chance.alias("score"))
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
