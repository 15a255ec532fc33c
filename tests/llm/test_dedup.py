"""Near-duplicates, lines and passages against brute force."""

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from xxhash import xxh64_intdigest

import corpus_pipeline
from tests.llm.conftest import SCHEMA, prose
from tidelog.llm import lines, passages, simhash
from tidelog.llm.common import table
from tidelog.llm.components import connected_components
from tidelog.llm.blocks import in_blocks


def classes(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def test_components(spark):
    rng = np.random.default_rng(5)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (260, 2))] + [(i, i + 1) for i in range(400, 480)] + [(9, 9), (999, 999)]
    found = {r.node: r.component for r in connected_components(spark.createDataFrame([*links, (None, 3)], "u long, v long")).collect()}
    assert found == classes({n for link in links for n in link}, links)
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0


def literal_fingerprint(text):
    found = words(lower(text))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + 4]) for i in range(max(len(found) - 3, 1))]
    hashes = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("piece", [2, 2048])
def test_simhash_on_odd_rows(messy, piece):
    found = simhash.near_duplicates(messy, piece=piece)
    rows = found.collect()
    assert set(found.columns) == {*messy.columns, "fingerprint", "component_id"}
    assert len(rows) == messy.count()
    for row in rows:
        assert row.fingerprint % 2**64 == literal_fingerprint(row.text)
    by = {row.doc_id: row.component_id for row in rows}
    assert by[6] == by[1] == 1
    assert by[3] == by[4] == by[2] == 2


def test_simhash_components_equal_brute_force(spark, sf):
    documents = table(spark, sf, "documents")
    base = {r.doc_id: r.text for r in documents.collect()}
    rows = [(i, t) for i, t in base.items()]
    for n in range(60):  # a chain of small edits, and edits of one text
        t = base[n % 5].split(" ")
        t[(7 * n) % len(t)] = f"edit{n}"
        rows.append((10_000 + n, " ".join(t)))
    prints = {i: literal_fingerprint(t) for i, t in rows}
    ids = sorted(prints)
    links = [(a, b) for n, a in enumerate(ids) for b in ids[n + 1 :] if (prints[a] ^ prints[b]).bit_count() <= 4]
    wanted = classes(ids, links)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for piece in (3, 2048):
        found = {r.doc_id: r.component_id for r in simhash.near_duplicates(frame, piece=piece).collect()}
        assert found == wanted
    assert {r.doc_id for r in simhash.one_of_each(frame).collect()} == set(wanted.values())


def test_bk_trees_find_all_within(spark):
    rng = np.random.default_rng(2)
    centre = rng.integers(0, 2**63, 6, np.uint64)
    flips = np.array([np.bitwise_or.reduce(np.uint64(1) << rng.integers(0, 64, n % 6 + 1).astype(np.uint64)) for n in range(400)])
    values = np.unique(centre[rng.integers(0, 6, 400)] ^ flips)
    tree = np.sort(rng.integers(0, 3, len(values)))
    forest = simhash.Forest(tree, values)
    found = {(int(q), int(m)) for qs, ms in forest.within(tree, values, 4) for q, m in zip(qs, ms)}
    wanted = {(i, j) for i in range(len(values)) for j in range(len(values)) if tree[i] == tree[j] and int(values[i] ^ values[j]).bit_count() <= 4}
    assert found == wanted


def literal_lines(rows, least):
    """rows (doc_id, text) in order; the texts without later copies of runs of lines."""
    seen, out = set(), []
    cut = [[(n, line) for n, line in enumerate((t or "").split("\n")) if line.strip(" \t\x0b\x0c\r")] for _, t in rows]
    gone = [set() for _ in rows]
    for d, told in enumerate(cut):
        for p in range(len(told) - least + 1):
            run = tuple(line for _, line in told[p : p + least])
            if run in seen:
                gone[d].update(n for n, _ in told[p : p + least])
            seen.add(run)
    for d, (i, t) in enumerate(rows):
        out.append((i, t if t is None else "\n".join(line for n, line in enumerate(t.split("\n")) if n not in gone[d])))
    return out


@pytest.mark.parametrize("least", [1, 2, 3, 5])
def test_lines_equal_brute_force(spark, least):
    rng = np.random.default_rng(least)
    rows = [(i, "\n".join(f"line {x}" if x else rng.choice(["", " \t"]) for x in rng.integers(0, 5, rng.integers(0, 40)))) for i in range(25)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = lines.dedup_lines(frame, min_lines=least, rows=4)
    assert sorted((r.doc_id, r.text) for r in found.collect()) == literal_lines(rows, least)


def test_lines_on_odd_rows(messy, none):
    found = lines.dedup_lines(messy)
    rows = found.collect()
    assert set(found.columns) == {*messy.columns, "removed"}
    assert len(rows) == messy.count()
    by = {r.doc_id: r for r in rows}
    assert by[2].text is None
    assert by[8].removed == []
    assert by[9].removed == [1, 2]
    assert by[9].text.startswith("intro\n" + prose(5, 60)[:20])
    assert lines.dedup_lines(none).count() == 0


def test_line_stage_deletes_lines_whose_neighbours_differ(spark):
    rows = [(i, f"own {i}\nsubscribe to our letter today\n\nalso own {i}", "en", "a", 9) for i in range(6)]
    found = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "")
    texts = {r.doc_id: r.text for r in found.collect()}
    assert texts == {i: rows[0][1] if i == 0 else f"own {i}\n\nalso own {i}" for i in range(6)}


def test_compact_windows_cover_every_subsequence():
    rng = np.random.default_rng(3)
    varied, repetitive = rng.integers(1, 2**63, 90).astype(np.uint64), rng.integers(1, 5, 90).astype(np.uint64)
    cut = varied.copy()
    cut[[20, 57]] = 0
    for values in (varied, repetitive, cut, varied[:10], np.full(30, 7, np.uint64)):
        found = list(zip(*(x.tolist() for x in passages.compact_windows(values, 10)), strict=True))
        for l, c, r in found:
            assert l <= c <= r and r - l >= 9
            assert values[c] == values[l : r + 1].min() > 0
        for i in range(len(values)):
            for j in range(i + 9, len(values)):
                low = values[i : j + 1].min()
                holders = [c for l, c, r in found if l <= i and j <= r and values[c] == low]
                assert bool(holders) == bool(low)
                if values is varied or values is cut:
                    assert sum(l <= i <= c <= j <= r for l, c, r in found) == bool(low)
    assert len(passages.compact_windows(varied[:9], 10)[0]) == 0


def test_passages_are_found_and_clean_texts_left_alone(spark):
    shared, near = prose(900, 70), prose(901, 80).split()
    rows = [(i, prose(i, 200)) for i in range(40)]
    rows += [(100 + i, f"{prose(300 + i, 60)} {shared} {prose(400 + i, 40)}") for i in range(12)]
    for i in range(6):
        other = list(near)
        other[40] = f"changed{i}"
        rows.append((200 + i, f"{prose(500 + i, 50)} {' '.join(other)} {prose(600 + i, 30)}"))
    rows += [(300, rows[0][1]), (301, rows[0][1])]
    found = passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string"), rows=16).collect()
    texts = dict(rows)
    by = classes(texts, [(r.doc_id, r.other_id) for r in found])
    assert len({by[100 + i] for i in range(12)}) == 1
    assert len({by[200 + i] for i in range(6)}) == 1
    assert by[300] == by[301] == by[0]
    assert all(by[i] == i for i in range(1, 40))
    for r in found:
        one, two = (set(), set())
        for s, (i, a, b) in ((one, (r.doc_id, r.start, r.stop)), (two, (r.other_id, r.other_start, r.other_stop))):
            told = words(lower(texts[i]))[a:b]
            assert len(told) >= 50 or s is two
            s.update(tuple(told[k : k + 5]) for k in range(len(told) - 4))
        assert len(one & two) / len(one | two) == pytest.approx(r.similarity)
        assert r.similarity >= 0.8


def edited_passages(groups: int, seed: int):
    """rows (doc_id, text): passages of 60 words, each in three documents as it is and in six with
    one word replaced, dropped or put in, among other words."""
    rng, rows = np.random.default_rng(seed), []
    for g in range(groups):
        passage = prose(7_000 + 100 * seed + g, 60).split()
        for n in range(9):
            told, at = list(passage), int(rng.integers(3, 57))
            if n > 2:
                told[at : at + n % 2] = [f"edit{g}x{n}"] if n < 7 else []
            rows.append((f"{prose(int(rng.integers(1, 2**40)), 30)} {' '.join(told)} {prose(int(rng.integers(1, 2**40)), 30)}"))
    places = rng.permutation(len(rows))
    return [(int(places[n]), text) for n, text in enumerate(rows)], [places[9 * g : 9 * g + 9].tolist() for g in range(groups)]


def shingle_runs(text, least=46):
    told = words(lower(text))
    shingles = [tuple(told[k : k + 5]) for k in range(len(told) - 4)]
    return [frozenset(shingles[k : k + least]) for k in range(len(shingles) - least + 1)]


def alike(one, two, similarity=0.8):
    """Whether two texts hold passages of 50 words each that are similar enough, by trying all."""
    one, two = shingle_runs(one), shingle_runs(two)
    if len(frozenset().union(*one) & frozenset().union(*two)) < similarity * min(map(len, [*one, *two])):
        return False
    return any(len(x & y) >= similarity * len(x | y) for x in one for y in two)


@pytest.mark.parametrize("piece", [4, 1024])
def test_edited_passages_are_linked_whichever_is_the_first(spark, piece):
    rows, groups = edited_passages(40, 1)
    found = passages.near_passages(spark.createDataFrame(sorted(rows), "doc_id long, text string"), piece=piece).collect()
    by = classes(range(len(rows)), [(r.doc_id, r.other_id) for r in found])
    assert all(len({by[i] for i in docs}) == 1 for docs in groups)
    assert len({by[docs[0]] for docs in groups}) == len(groups)


def test_passages_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    rows = edited_passages(2, 2)[0]
    line = prose(71, 30)  # too short for a passage, in many documents
    base = [prose(60 + n, 58).split() for n in range(3)]
    for n in range(24):
        told = list(base[n % 3])
        for at in rng.integers(0, len(told), n % 4):  # up to three edits: some match, some do not
            told[at] = f"word{n}x{at}"
        if n % 5 == 0:
            told = told[:54]
        rows.append((100 + n, f"{prose(300 + n, n)} {line} {' '.join(told)} {prose(400 + n, 40)}"))
    texts = dict(rows)
    links = [(a, b) for a in texts for b in texts if a < b and alike(texts[a], texts[b])]
    found = passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string"), rows=16, piece=8).collect()
    by = classes(texts, [(r.doc_id, r.other_id) for r in found])
    assert len(links) > 60
    assert all(by[a] == by[b] for a, b in links)
    for r in found:
        sets = []
        for i, a, b in ((r.doc_id, r.start, r.stop), (r.other_id, r.other_start, r.other_stop)):
            told = words(lower(texts[i]))[a:b]
            sets.append({tuple(told[k : k + 5]) for k in range(len(told) - 4)})
        assert r.stop - r.start >= 50
        assert len(sets[0] & sets[1]) / len(sets[0] | sets[1]) == pytest.approx(r.similarity)
        assert r.similarity >= 0.8


def test_passages_at_the_edge_and_after_their_own_half(spark):
    whole, edge, long = prose(901, 70).split(), prose(902, 52).split(), prose(903, 150).split()
    other, third = list(edge), list(long)
    other[1] = "changed"
    for at in (40, 85, 120):
        third[at] = "changed"
    rows = [
        (1, f"{prose(1, 40)} {' '.join(whole)} {prose(2, 40)}"),
        (2, f"{prose(3, 40)} {' '.join(whole[:35])} {prose(4, 90)} {' '.join(whole)} {prose(5, 40)}"),
        (3, f"{prose(6, 40)} {' '.join(edge)} {prose(7, 40)}"),
        (4, f"{prose(8, 40)} {' '.join(other)} {prose(9, 40)}"),
        (5, f"{prose(10, 40)} {' '.join(long)} {prose(11, 40)}"),
        (6, f"{prose(12, 40)} {' '.join(third)} {prose(13, 40)}"),
    ]
    texts = dict(rows)
    assert all(alike(texts[i], texts[i + 1]) for i in (1, 3, 5))
    found = passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {tuple(sorted((r.doc_id, r.other_id))) for r in found} == {(1, 2), (3, 4), (5, 6)}


@pytest.mark.parametrize("vocabulary", [3, 9, 60])
def test_bounds_miss_no_similar_stretch(vocabulary):
    rng = np.random.default_rng(vocabulary)
    for similarity in (0.6, 0.8, 1.0):
        held = [np.repeat(rng.integers(0, vocabulary, 12), rng.integers(1, 5, 12))[: rng.integers(5, 30)].astype(np.uint32) for _ in range(12)]
        regions = passages._Regions(held)
        for least in (6, 9):
            for shared in (set(held[0].tolist()), set(range(vocabulary // 2))):
                marks = np.array([v in shared for h in held for v in h.tolist()])
                loss = similarity / (1 - similarity) if similarity < 1 else 2.0**20
                found = passages._stretches(marks, regions.gap, regions.place, regions.size, least, loss)
                for at, h in zip(regions.begins.tolist(), held, strict=True):
                    for s in range(len(h) - least + 1):
                        runs = [set(h[s:e].tolist()) for e in range(s + least, len(h) + 1)]
                        if any(len(run & shared) >= similarity * len(run) - 1e-9 for run in runs):
                            assert found[at + s]


def test_documents_with_one_word_over_and_over_are_not_all_tried(monkeypatch):
    tried = []
    matches = passages.matches
    monkeypatch.setattr(passages, "matches", lambda a, b, *how, **more: tried.append(1) or matches(a, b, *how, **more))
    # A run of one word, too short for a passage, in many; some go on alike.
    texts = [f"{prose(2_000 + i, 40)} {'the ' * (14 + i % 34)}{prose(3_000 + i, 40)}" for i in range(240)]
    texts += [f"{prose(4_000 + i, 20)} {'the ' * 30}{prose(77, 45)} {prose(5_000 + i, 30)}" for i in range(6)]
    regions = [passages.shingle_hashes(t).astype(np.uint32).tobytes() for t in texts]
    many = list(range(len(texts)))
    group = pa.table({"_row": many, "l": [0] * len(texts), "alone": [True] * len(texts), "asking": [True] * len(texts), "asked": [True] * len(texts), "doc": many, "region": pa.array(regions, pa.binary())})
    found = passages._compared(group, 46, 0.8, 10).to_pylist()
    by = classes(many, [(r["doc_id"], r["other_id"]) for r in found])
    assert {by[i] for i in many[240:]} == {240}
    assert all(by[i] == i for i in many[:240])
    assert len(tried) < len(texts)  # of 30,135 pairs


def test_seeds_are_in_common_for_certain():
    assert passages.seed_shape(46, 0.8) == (14, 10)
    assert passages.seed_shape(46, 1.0) == (30, 21)
    rng = np.random.default_rng(4)
    for values in (rng.integers(1, 2**63, 300), rng.integers(1, 4, 300)):
        values = values.astype(np.uint64)
        kept = set(values[passages.centres(values, 10)].tolist())
        assert all(int(values[i : i + 10].min()) in kept for i in range(291))
        assert kept == set(values[passages.compact_windows(values, 10)[1]].tolist())
    assert len(passages.centres(np.arange(5, dtype=np.uint64), 10)) == 0


def test_shared_runs_of_the_table_are_linked(spark, sf):
    documents = table(spark, sf, "documents")
    texts = {r.doc_id: r.text for r in documents.collect()}
    runs = defaultdict(set)
    for i, t in texts.items():
        told = words(lower(t))
        for k in range(len(told) - 49):
            runs[tuple(told[k : k + 50])].add(i)
    by = classes(texts, [(r.doc_id, r.other_id) for r in passages.near_passages(documents).collect()])
    assert all(len({by[i] for i in docs}) == 1 for docs in runs.values())


def test_passages_on_odd_rows(spark, messy, none):
    found = passages.near_passages(messy, rows=3).collect()
    assert {(r.doc_id, r.other_id) for r in found} == {(1, 1), (6, 1)}
    assert passages.near_passages(none).count() == 0


def test_blocks_keep_rows(messy):
    blocked = in_blocks(messy, 2)
    assert blocked.table.select(blocked.block).distinct().count() > 1
    assert len(SCHEMA.split(",")) == len(blocked.columns)


def test_simhash_with_clashing_names_and_an_empty_table(messy, none):
    clash = messy.withColumnsRenamed({"key": "_fp", "_row": "Fingerprint"})
    rows = simhash.near_duplicates(clash)
    assert rows.count() == messy.count() and "_fp" in rows.columns
    assert simhash.near_duplicates(none).count() == 0 and simhash.one_of_each(none).count() == 0
