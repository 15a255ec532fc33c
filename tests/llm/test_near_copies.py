"""Near copies against brute force over fingerprints and shingle sets."""

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from tests.llm.test_dedup import classes, lower, words
from tidelog.llm import kneser_ney, lines, near_copies, simhash
from tidelog.llm.blocks import in_blocks
from tidelog.llm.common import Stored, table


def shingles(text):
    found = words(lower(text))
    return {tuple(found[i : i + 5]) for i in range(max(len(found) - 4, 1))} if found else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 0.0


def edited(text, rng, edits, mark):
    out = text.split(" ")
    for n, at in enumerate(rng.choice(len(out), edits, replace=False)):
        out[at] = f"edit{mark}x{n}"
    return " ".join(out)


def corpus(spark, sf):
    """Some documents of the table, and copies of the longer ones with few to many edits."""
    rng = np.random.default_rng(11)
    base = {r.doc_id: r.text for r in table(spark, sf, "documents").collect()}
    rows = dict(base)
    long = [i for i, t in base.items() if len(words(t)) >= 60]
    for n in range(160):
        origin = base[long[n % 40]]
        many = max(1, int(len(words(origin)) * (n % 8) * 0.004))
        rows[100_000 + n] = edited(origin, rng, many, n)
    return rows


def test_groups_equal_brute_force(spark, sf):
    rows = corpus(spark, sf)
    prints = {i: simhash.fingerprint(simhash.shingle_hashes(t, 5)) % 2**64 for i, t in rows.items()}
    sets = {i: shingles(t) for i, t in rows.items()}
    ids = sorted(rows)
    alike = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if sets[a] & sets[b] and jaccard(sets[a], sets[b]) >= 0.8]
    links = [(a, b) for a, b in alike if (prints[a] ^ prints[b]).bit_count() <= near_copies.RADIUS]
    same = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if prints[a] == prints[b]]
    wanted = set(classes(ids, links + same).values())
    frame = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    kept = [r.doc_id for r in near_copies.one_of_each(frame, piece=20).collect()]
    assert len(kept) == len(set(kept)) and set(kept) == wanted
    # fingerprints lose few of the pairs that are similar enough, and no other document goes
    assert len(links) >= 0.75 * len(alike)
    copied = {i for pair in alike + same for i in pair}
    assert set(ids) - copied <= wanted


def test_pairs_are_verified_by_shingles(spark):
    texts = [(1, "a b c d e f g h"), (2, "a b c d e f g i"), (3, "A b c d e f g h"), (4, None), (5, "  ")]
    frame = spark.createDataFrame(texts, "fp long, text string")
    sets = frame.select("fp", near_copies.shingle_set(F.col("text")).alias("shingles"))
    pairs = spark.createDataFrame([(2, 1), (3, 1), (4, 1), (5, 4)], "u long, v long")

    def found(least):
        return {(r.u, r.v) for r in near_copies.similar_pairs(pairs, sets, least).collect()}

    assert found(0.8) == {(3, 1)}
    assert found(0.6) == {(3, 1), (2, 1)}  # 3 of 5 shingles are shared


def test_shingle_sets(spark):
    texts = ["", " \n ", "one", "a  b\tc d E f", None, "x y z w v " * 300]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    found = [r[0] for r in frame.select(F.size(near_copies.shingle_set(F.col("text")))).collect()]
    assert [n or 0 for n in found] == [len(shingles(t)) for t in texts]


def test_odd_rows(messy, none):
    clash = messy.withColumnsRenamed({"key": "_fp", "_block": "_group", "_row": "Fp"})
    for frame in (messy, clash):
        kept = near_copies.one_of_each(frame)
        assert kept.columns == frame.columns
        rows = kept.collect()
        assert [r.doc_id for r in rows if not (r.text or "").strip()] == [2]
        ids = [r.doc_id for r in rows]
        assert 1 in ids and 6 not in ids
    assert near_copies.one_of_each(none).count() == 0


def test_what_grows_with_the_input_is_not_broadcast(spark, monkeypatch):
    """Joins of tables with a row per document, line or n-gram are shuffled, however small Spark
    takes these for."""
    broadcast, store = [], Stored.__init__

    def watched(self, df, label):
        plan = df._jdf.queryExecution().executedPlan().toString()
        broadcast.extend((label, line) for line in plan.splitlines() if "BroadcastHashJoin" in line)
        store(self, df, label)

    monkeypatch.setattr(Stored, "__init__", watched)
    rows = [(n, prose(n // 2, 60) + f" word{n}", "en") for n in range(40)]
    documents = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = near_copies.one_of_each(documents)
    assert not broadcast
    assert "BroadcastHashJoin" not in kept._jdf.queryExecution().executedPlan().toString()

    lines.intervals(in_blocks(documents.union(documents), 8), 2)
    assert not [line for _, line in broadcast if "_block" not in line]  # prefix scans have a row per block

    broadcast.clear()
    trusted = documents.where("doc_id < 20").select("doc_id")
    kneser_ney.accepted(documents, trusted)
    assert {label for label, _ in broadcast} <= {"chances", "perplexities"}
    # of the tables of n-grams those of one and two bytes
    assert sum(label == "chances" for label, _ in broadcast) == 2 + 2 + 1
