"""Quality, toxicity and mixing, and the pipeline made of the operators."""

import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.conftest import prose
from tidelog.llm import kneser_ney, mixing, toxicity
from tidelog.llm.common import table, uniform, word_count

N = kneser_ney.ORDER


def literal_model(texts):
    """Byte probabilities of an interpolated modified Kneser-Ney model, from its definition."""
    counts = {N: Counter()}
    for t in texts:
        data = b"\n" * (N - 1) + (t or "").encode()
        counts[N].update(data[i : i + N] for i in range(len(data) - N + 1))
    for k in range(N - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount, total, kinds = {}, {}, {}
    for k, table_ in counts.items():
        n = [sum(c == i for c in table_.values()) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if all(n) else 0
        found = [i + 1 - (i + 2) * y * n[i + 1] / n[i] for i in range(3)] if all(n) else [0.5, 0.75, 0.9]
        discount[k] = [min(max(d, 0.05), i + 0.95) for i, d in enumerate(found)] if all(n) else found
        total[k], kinds[k] = Counter(), defaultdict(Counter)
        for g, c in table_.items():
            total[k][g[:-1]] += c
            kinds[k][g[:-1]][min(c, 3)] += 1

    def chance(g):
        p = 1 / 256
        for k in range(1, N + 1):
            part = g[N - k :]
            if part[:-1] not in total[k]:
                continue
            c = counts[k].get(part, 0)
            d = discount[k]
            freed = sum(d[i - 1] * m for i, m in kinds[k][part[:-1]].items())
            p = (max(c - d[min(c, 3) - 1], 0) if c else 0) / total[k][part[:-1]] + freed / total[k][part[:-1]] * p
        return p

    return chance


def test_perplexities_equal_the_definition(spark, messy):
    rows = [(i, prose(i, 60), "en") for i in range(30)] + [(r.doc_id, r.text, r.lang) for r in messy.where("doc_id in (2, 3, 4, 7)").collect()]
    rows = [(n, t, g) for n, (_, t, g) in enumerate(rows)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trusted = frame.where("doc_id < 25").select("doc_id")
    _, verdicts = kneser_ney.judge(frame, trusted.union(trusted), rows=8)
    chance = literal_model([t for i, t, _ in rows if i < 25 and zlib.crc32(str(i).encode()) % 5])
    found = verdicts.collect()
    assert len(found) == len(rows)
    for r in found:
        data = b"\n" * (N - 1) + (rows[r.doc_id][1] or "").encode()
        bits = [-math.log2(chance(data[i : i + N])) for i in range(len(data) - N + 1)]
        if not bits:
            assert r.perplexity is None and r.keep
        else:
            assert r.perplexity == pytest.approx(2 ** (sum(bits) / len(bits)), rel=1e-9)
            assert r.keep == (r.threshold is None or r.perplexity <= r.threshold)


def test_quality_on_odd_rows(spark, messy, none):
    trusted = messy.select("doc_id")
    kept = kneser_ney.accepted(messy, trusted, rows=4)
    assert kept.columns == messy.columns
    assert {2, 3} <= {r.doc_id for r in kept.collect()}
    assert kneser_ney.accepted(messy, trusted.limit(0)).count() == messy.count()
    assert kneser_ney.accepted(none, trusted).count() == 0


def test_quality_tells_junk_from_prose(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    _, verdicts = kneser_ney.judge(table(spark, sf, "documents"), labels.where("quality = 1"))
    rates = {r.quality: r.kept for r in verdicts.join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("keep").cast("int")).alias("kept")).collect()}
    assert rates[1] > 0.97 and rates[0] < 0.2


def test_disguised_words_are_restored(spark, sf):
    model = toxicity.language_model(table(spark, "/root/testdata/sf0.01", "documents"))
    for hidden, plain in (("1d10t", "idiot"), ("m0r0n", "moron"), ("st*pid", "stupid"), ("looooser", "loser"), ("s.t.u.p.i.d", "stupid"), ("tr@sh", "trash")):
        assert toxicity.restore(hidden, model) == plain
    reader = toxicity.Reader(model)
    assert "idiot" in reader.words("you i d i o t there")
    assert {"hello", "there"} <= reader.words("Hello, (there)!")
    assert toxicity.restore("*" * 200, model) is not None


def test_spaced_words_are_found_behind_others(spark):
    model = toxicity.language_model(table(spark, "/root/testdata/sf0.01", "documents"))
    scorer = toxicity.Scorer(model, toxicity.Classifier({w: 7.0 for w in ("idiot", "stupid", "moron", "trash", "loser")}))
    for text in ("you are a s t u p i d man", "I s t u p i d", "y o u a r e a n i d i o t", "i m o r o n", "a 1 d 1 0 t", "what a l o s e r y o u a r e"):
        assert scorer.evidence(text) == 7.0, text
    assert scorer.evidence(" ".join("the people said" * 60 + "youareanidiot" + "the people said" * 60)) == 7.0
    assert scorer.evidence("t h e p e o p l e s a i d this is a b c") == 0.0
    assert "idiot" in toxicity.Reader(model).words("y o u a r e a n i d i o t")


def test_toxicity_on_the_table(spark):
    sf = "/root/testdata/sf0.01"
    labels = table(spark, sf, "labels")
    found = toxicity.score(table(spark, sf, "documents"), labels)
    assert found.count() == table(spark, sf, "documents").count()
    told = found.join(labels, "doc_id").where("not held_out").collect()
    assert sum(r.predicted == r.toxic for r in told) / len(told) > 0.93
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.collect())


def test_toxicity_on_odd_rows(spark, messy, none):
    labels = spark.createDataFrame([(1, 1), (5, 0), (7, None), (None, 1), (1, 1)], "doc_id long, toxic int")
    rows = toxicity.score(messy, labels).collect()
    assert len(rows) == messy.count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert toxicity.score(messy, labels.limit(0)).count() == messy.count()
    assert toxicity.score(none, labels).count() == 0


def test_word_count(spark):
    texts = [None, "", " ", "a", " a ", "a\tb\x0bc\n", "x y z", "\x0ca\x0c"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", word_count(F.col("t")).alias("n")).collect()
    assert [r.n for r in rows] == [0, 0, 0, 1, 1, 3, 2, 1]


@pytest.fixture(scope="module")
def sources(spark):
    rows = [(i, " ".join(["w"] * (1 + i * 7 % 50)), [None, "a", "b", "c", "d", "é"][i % 6 if i % 3 else 1]) for i in range(900)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_mixing_meets_targets(sources):
    rows = mixing.mix(sources).collect()
    assert len(rows) == 900
    sizes, targets, taken, largest = Counter(), {}, Counter(), Counter()
    for r in rows:
        sizes[r.source] += r.size
        targets[r.source] = r.target
        taken[r.source] += r.taken
        largest[r.source] = max(largest[r.source], r.size)
        assert r.taken in (0, r.size, 2 * r.size)
    assert all(r.source_size == sizes[r.source] for r in rows)
    weight = dict(zip(sorted(s for s in sizes if s is not None) + [None], [3, 1, 2] * 3))
    assert sum(targets.values()) == pytest.approx(1.5 * sum(sizes.values()))
    free = {s: targets[s] / weight[s] for s in sizes if targets[s] < 2 * sizes[s] - 1e-6}
    assert all(v == pytest.approx(next(iter(free.values()))) for v in free.values())
    assert all(2 * sizes[s] / weight[s] <= next(iter(free.values())) + 1e-6 for s in sizes if s not in free)
    assert all(abs(taken[s] - targets[s]) <= largest[s] for s in sizes)
    again = mixing.mix(sources.repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted((r.doc_id, r.taken) for r in again)
    assert mixing.mixed(sources).count() == sum(r.copies for r in rows)


def test_mixing_prefers_good_documents(sources):
    better = mixing.mix(sources, share=0.1, quality=F.when(F.col("doc_id") % 2 == 0, 10.0).otherwise(0.1))
    share = {r.even: r.n for r in better.where("taken > 0 and source = 'a'").groupBy((F.col("doc_id") % 2 == 0).alias("even")).agg(F.count("*").alias("n")).collect()}
    assert share[True] > 10 * share.get(False, 0)


@pytest.mark.parametrize("ids", [7, None])
def test_mixing_splits_repeated_rows_at_the_edge(spark, ids):
    rows = [(ids, "three plain words", "a")] * 1000
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = mixing.mix(frame.repartition(5)).collect()
    assert len(found) == 1000 and {r.target for r in found} == {4500.0}
    assert sum(r.taken for r in found) == 4500 and {r.copies for r in found} == {1, 2}


def test_mixing_equals_sequential_sampling(spark, sf):
    """The sample of every source, drawn one document after the other in the order of its keys."""
    documents = table(spark, sf, "documents").select("doc_id", "source", "text")
    documents = documents.unionByName(documents.where("doc_id % 7 = 0")).unionByName(documents.where("doc_id % 7 = 0"))
    weight = mixing.quality_weight(F.col("text"))
    key = -F.log(uniform(mixing.SEED, F.col("doc_id"), F.col("text"))) / F.greatest(weight, F.lit(1e-6))
    drawn = sorted((r.source is None, r.source or "", r.key, r.doc_id, len(r.text.split())) for r in documents.withColumn("key", key).collect())
    plan = {r.source: r for r in mixing.mix(documents).select("source", "source_size", "target").distinct().collect()}
    wanted, seen = Counter(), Counter()
    for none, source, _, doc_id, size in drawn:
        p = plan[None if none else source]
        epochs = min(p.target // p.source_size, 2)
        rest = p.target - epochs * p.source_size
        before, after = rest - seen[source, none], seen[source, none] + size - rest
        seen[source, none] += size
        wanted[doc_id] += int(epochs + (after <= 0 or after < before)) * size
    found = Counter()
    for r in mixing.mix(documents).collect():
        found[r.doc_id] += r.taken
    assert found == wanted


def test_mixing_on_odd_rows(messy, none):
    rows = mixing.mix(messy).collect()
    assert len(rows) == messy.count()
    assert {r.source for r in rows} == {"a", "b", "c", None}
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0


def test_pipeline_stages(spark, sf):
    docs = table(spark, sf, "documents")
    columns = set(docs.columns)
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert set(stage(spark, docs.limit(0), sf).columns) == columns
    out = corpus_pipeline.run(spark, sf)
    assert 0 < out.count()
    assert out.where("n_tokens is null or length(ids_sha256) <> 64").count() == 0


def test_mix_with_clashing_names(messy):
    """Columns named like those added, or like the working columns, in any case."""
    clash = messy.withColumnsRenamed({"key": "_key", "n_chars": "Size", "_block": "_edge", "_row": "target"})
    rows = mixing.mix(clash).collect()
    plain = mixing.mix(messy).collect()
    assert sorted(((r.doc_id, r["size"], r.taken) for r in rows), key=repr) == sorted(((r.doc_id, r["size"], r.taken) for r in plain), key=repr)
    kept = mixing.mixed(clash)
    assert kept.columns == clash.columns
    own = {repr((r.doc_id, r.Size, r.target)) for r in clash.collect()}
    assert {repr((r.doc_id, r.Size, r.target)) for r in kept.collect()} <= own


def test_pipeline_stages_on_odd_rows(spark, sf, messy):
    """Each stage by itself on nulls, empty, blank and very long texts and repeated rows."""
    stages = dict(corpus_pipeline.STAGES)
    columns = corpus_pipeline.COLUMNS
    rows = sorted((tuple(r) for r in messy.select(*columns).collect()), key=repr)

    def result(name):
        return sorted((tuple(r) for r in stages[name](spark, messy, sf).collect()), key=repr)

    kept = result("quality classifier")
    assert set(kept) <= set(rows) and {r for r in rows if not r[1]} <= set(kept)
    lines = result("line dedup")
    assert sorted(map(repr, (r[0] for r in lines))) == sorted(map(repr, (r[0] for r in rows)))
    assert [r for r in lines if r[1] is None] == [(2, None, "en", "a", None)]
    assert sum(r[1].count("same line here") for r in lines if r[1]) == 1
    near = result("SimHash near-dedup")
    assert set(near) <= set(rows) and len(set(near)) == len(near)
    assert [r[0] for r in near if not (r[1] or "").strip()] == [2]
    mix = result("mixing sources to target weights")
    assert set(mix) <= set(rows)
    tokens = stages["byte-level BPE encoding and decoding"](spark, messy, sf).collect()
    assert len(tokens) == len(rows)
    assert {r.n_tokens for r in tokens if r.doc_id in (2, 3)} == {0}
