"""Near-duplicate passages, found with compact windows.

A text is a sequence of shingles. Under one hash function the Cartesian tree over its shingle
hashes cuts all subsequences of ``min_words`` or more into few compact windows: window (l, c, r)
stands for every subsequence that starts in [l, c] and ends in [c, r], and all of them have the
hash at c as their min-hash. Windows of different documents with one min-hash share a signature.

Min-hashes agree by chance only. But a passage that is similar enough also holds a run of words
without any change (``seed_shape``), so the same windows are taken over longer runs of words: the
min-hashes of all unchanged runs, seeds, agree for certain. A group of equal seeds is first
compared with one of its documents, so a passage in n documents makes about n pairs and not n
squared. What does not match that one is compared with the others of the group, until it is
linked to them or none is left. Documents that agree under enough hash functions are compared
as well.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidelog.llm.blocks import BLOCK_ROWS, Blocked, in_blocks
from tidelog.llm.common import Stored, word_bytes, word_count

WIDTH = 5
MIN_WORDS = 50
SIMILARITY = 0.8
HASHES = 4
ENOUGH = 2
AROUND = 5  # shingles on either side of a window's centre that tell its surroundings
GAP = 3 * WIDTH  # shingles two matches may lie apart within one passage
MEMBERS = 256  # documents compared with one copy of their representative
PIECE = 1024  # documents of a group that are compared in one piece
BREAK = 7  # shingles, of both texts, that an edit within a passage costs at least
SMALL = 512  # shingles up to which all passages of two texts are tried at once
OCCURRENCES = 8  # places of a shingle that are all tried as starts of a run

_SPREAD = np.uint64(0xBF58476D1CE4E5B9)


def mixed(hashes: np.ndarray, function: int) -> np.ndarray:
    """The hashes under another function: a bijection of 64 bits."""
    x = hashes + np.uint64(0x9E3779B97F4A7C15 * (function + 1) % 2**64)
    x = (x ^ (x >> np.uint64(30))) * _SPREAD
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E3779B97F4A7C15
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """The first n powers of a base, in 64 bits."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        steps = np.full(1 << max(n, 1024).bit_length(), base, np.uint64)
        steps[0] = 1
        _powers[base] = known = np.cumprod(steps)
    return known[:n]


def run_hashes(text: str | None, widths: tuple[int, ...]) -> list[np.ndarray]:
    """For each width a hash of every run of so many words: a polynomial of its bytes, mixed.

    The polynomials of all runs are differences of one running sum.
    """
    joined, starts, ends = word_bytes(text, lower=True)
    if len(starts) < min(widths):
        return [np.empty(0, np.uint64) for _ in widths]
    letters = np.frombuffer(joined, np.uint8).astype(np.uint64) + np.uint64(1)
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(letters * _power(_BASE, len(letters)))))
    shift = _power(pow(_BASE, -1, 2**64), len(letters))
    found = []
    for width in widths:
        begin, end = starts[: max(len(starts) - width + 1, 0)], ends[width - 1 :]
        found.append(mixed((sums[end] - sums[begin]) * shift[begin], HASHES + 97))
    return found


def shingle_hashes(text: str | None) -> np.ndarray:
    """A hash of every run of ``WIDTH`` words."""
    return run_hashes(text, (WIDTH,))[0]


def seed_shape(least: int, similarity: float) -> tuple[int, int]:
    """(words of a seed, seeds in a row of which one is kept), so that two passages of ``least``
    shingles or more with this similarity have a kept seed in common.

    With c shingles in common at most c (1 / similarity - 1) are not, and every edit between two
    unchanged runs costs ``BREAK`` of them or more, unless the passage repeats its own words
    there. So c shingles lie in few runs, and the longest is no shorter than computed here.
    """
    fewest = math.ceil(similarity * least - 1e-9)
    run, edits = fewest, 1
    while similarity < 1 and edits < least:
        run = min(run, math.ceil(max(fewest, BREAK * edits * similarity / (1 - similarity)) / (edits + 1) - 1e-9))
        edits += 1
    words = run + WIDTH - 1
    width = max(WIDTH, round(0.6 * words))
    return width, words - width + 1


def _minima(values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimum, first run, last run, its place) of all runs of ``least`` values, where equal
    minima of neighbouring runs are one."""
    low, size = values, 1
    while 2 * size <= least:
        low, size = np.minimum(low[:-size], low[size:]), 2 * size
    if size < least:
        low = np.minimum(low[: size - least], low[least - size :])
    first = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
    last = np.concatenate((first[1:] - 1, [len(low) - 1]))
    node = low[first]
    # A minimum is at the end at which it came in or went out; else it is looked up.
    before = np.concatenate(([True], node[:-1] > node[1:]))
    after = np.concatenate((node[1:] > node[:-1], [True]))
    before[0] = after[-1] = False
    centre = np.where(before, first + least - 1, last)
    unknown = np.flatnonzero(~before & ~after & (node > 0))
    lo, hi = last[unknown], first[unknown] + least
    wide = lo >= hi  # equal values took turns
    lo = np.where(wide, first[unknown], lo)
    many = hi - lo
    ends = np.cumsum(many)
    at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many, many) + np.repeat(lo, many)
    hit = np.flatnonzero(values[at] == np.repeat(node[unknown], many))
    owner = np.searchsorted(ends, hit, "right")
    centre[unknown[owner]] = at[hit]
    return node, first, last, centre


def centres(values: np.ndarray, least: int) -> np.ndarray:
    """The centres of the compact windows alone."""
    if len(values) < least:
        return np.empty(0, np.int64)
    node, _, _, centre = _minima(values, least)
    return centre[node > 0]


def compact_windows(values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The windows (l, c, r) that hold runs of ``least`` values or more, without zeros in them.

    These are the inner nodes of the Cartesian tree that are wide enough. Their values are the
    minima of all runs of exactly ``least`` values; equal minima of neighbouring runs make one
    node, and a node reaches to the nearest smaller minima on either side. A zero cuts the
    values. Equal values may share a window.
    """
    none = np.empty(0, np.int64)
    if len(values) < least:
        return none, none, none
    node, first, last, centre = _minima(values, least)
    left, right = np.zeros(len(node), np.int64), np.full(len(node), len(values) - 1)
    stack: list[int] = []
    told = node.tolist()
    for n, value in enumerate(told):
        while stack and told[stack[-1]] > value:
            right[stack.pop()] = first[n] + least - 2
        below = len(stack) - 1
        while below >= 0 and told[stack[below]] == value:
            below -= 1
        if below >= 0:
            left[n] = last[stack[below]] + 1
        stack.append(n)
    real = node > 0
    return left[real], centre[real], right[real]


def _windows_of(texts: list[str | None], hashes: int, least: int, seed: tuple[int, int]) -> list[np.ndarray]:
    """Columns (place of the text, k, key, sig, l, r) of the windows of some texts, and with k =
    ``hashes`` of their seeds, whose l and r are the shingle at which they begin."""
    found = [run_hashes(t, (WIDTH, seed[0])) for t in texts]
    starts = np.cumsum([0, *(len(f) + 1 for f, _ in found)])[:-1]
    cut = np.zeros(1, np.uint64)
    shingles = np.concatenate([x for f, _ in found for x in (f, cut)])
    walls = starts[1:] - 1
    ends = starts + [len(f) for f, _ in found]
    sums = np.concatenate((cut, np.cumsum(mixed(shingles, HASHES + 96))))
    out = []
    for k in range(hashes):
        values = np.maximum(mixed(shingles, k), np.uint64(1))
        values[walls] = 0
        values[-1:] = 0
        l, c, r = compact_windows(values, least)
        place = np.searchsorted(starts, c, "right") - 1
        near = sums[np.minimum(c + AROUND + 1, ends[place])] - sums[np.maximum(c - AROUND, starts[place])]
        at = starts[place]
        out.append((place, np.full(len(c), k), values[c].view(np.int64), near.view(np.int64) >> 32, l - at, r - at))
    begins = np.cumsum([0, *(len(f) + 1 for _, f in found)])[:-1]
    values = np.concatenate([x for _, f in found for x in (np.maximum(f, np.uint64(1)), cut)])
    c = centres(values, seed[1])
    place = np.searchsorted(begins, c, "right") - 1
    at = c - begins[place]
    out.append((place, np.full(len(c), hashes), values[c].view(np.int64), np.zeros(len(c), np.int64), at, at))
    return [np.concatenate(x) for x in zip(*out, strict=True)]


def _windows(blocked: Blocked, copies: DataFrame, hashes: int, least: int, seed: tuple[int, int]) -> DataFrame:
    """Rows (_row, key, tag, span) of every distinct text; tag holds (sig, k) and span (l, r)."""
    row_name = blocked.row
    names = ["_row", "key", "tag", "span"]

    def run(own: pa.Table, others: pa.Table) -> pa.Table:
        own = own.filter(pc.invert(pc.is_in(own.column(row_name), others.column("_row").combine_chunks())))
        tables = []
        for lo in range(0, own.num_rows, 64):
            part = own.slice(lo, 64)
            place, k, key, sig, l, r = _windows_of(part.column("text").to_pylist(), hashes, least, seed)
            columns = [part.column(row_name).to_numpy()[place], key, sig << 8 | k, l << 32 | r]
            tables.append(pa.table([pa.array(c, pa.int64()) for c in columns], names=names))
        return pa.concat_tables([pa.table([pa.array([], pa.int64()) for _ in names], names=names), *tables])

    return blocked.with_rows(copies, run, "_row long, key long, tag long, span long", ["text"])


def _pairs(windows: DataFrame, enough: int) -> DataFrame:
    """Rows (a, b, al, ar, bl, br): documents (by row, a first in its groups) to compare."""
    at = F.struct(F.col("_row").alias("row"), "l", "r")
    near = windows.groupBy("k", "key", "sig").agg(F.min(at).alias("rep"))
    top = near.groupBy("k", "key").agg(F.min("rep").alias("top"))
    members = windows.join(near, ["k", "key", "sig"]).select("k", F.col("rep").alias("x"), at.alias("y"))
    between = near.join(top, ["k", "key"]).select("k", F.col("top").alias("x"), F.col("rep").alias("y"))
    both = members.unionByName(between).where("x.row <> y.row")
    grouped = both.groupBy(F.col("x.row").alias("a"), F.col("y.row").alias("b")).agg(
        F.bit_count(F.bit_or(F.expr("shiftleft(1, k)"))).alias("n"),
        F.min("x.l").alias("al"),
        F.max("x.r").alias("ar"),
        F.min("y.l").alias("bl"),
        F.max("y.r").alias("br"),
    )
    return grouped.where(F.col("n") >= enough).drop("n")


def _seeded(seeds: DataFrame) -> DataFrame:
    """Rows (a, at, b, place): every seed of a document b with its place, and the first document
    a of those that have it."""
    rep = F.min(F.struct("_row", "l")).over(Window.partitionBy("key"))
    tied = seeds.select("_row", "l", rep.alias("rep")).where("_row <> rep._row")
    return tied.select(F.col("rep._row").alias("a"), F.col("rep.l").alias("at"), F.col("_row").alias("b"), F.col("l").alias("place"))


def _seed_pairs(seeded: DataFrame, wide: int, reach: int) -> DataFrame:
    """The pairs of ``seeded``, with the hulls of their seeds and what lies around these."""
    return seeded.groupBy("a", "b").agg(
        F.greatest(F.min("at") - reach, F.lit(0)).alias("al"),
        (F.max("at") + wide + reach).alias("ar"),
        F.greatest(F.min("place") - reach, F.lit(0)).alias("bl"),
        (F.max("place") + wide + reach).alias("br"),
    )


def _last_seen(values: np.ndarray) -> np.ndarray:
    """Where each value was seen last before; -1 if never."""
    order = np.argsort(values, kind="stable")
    seen = np.full(len(values), -1)
    same = values[order[1:]] == values[order[:-1]]
    seen[order[1:][same]] = order[:-1][same]
    return seen


def _fewest(values: np.ndarray, least: int) -> float:
    """The fewest distinct values in ``least`` neighbouring ones; infinite if there are not so many."""
    if len(values) < least:
        return math.inf
    seen = _last_seen(values)
    if seen.max() < 0:
        return least
    seen = np.lib.stride_tricks.sliding_window_view(seen, least)
    return int((seen < np.arange(len(seen))[:, None]).sum(1).min())


def _distinct(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """At (n, e) the number of distinct values from starts[n] to e inclusive."""
    n, starts = np.arange(len(values)), starts[:, None]
    seen = _last_seen(values)
    if seen.max() < 0:
        return n - starts + 1
    return np.cumsum((seen < starts) & (n >= starts), 1)


def _nearest(a: np.ndarray, b: np.ndarray, diagonal: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (p, q) of the values of ``a`` that ``b`` has, of several the one closest to the diagonal."""
    order = np.argsort(b, kind="stable")
    held = b[order]
    if (held[1:] != held[:-1]).all():
        at = np.minimum(np.searchsorted(held, a), len(b) - 1)
        p = np.flatnonzero(held[at] == a)
        return p, order[at[p]]
    far = len(a) + len(b)
    drift = np.abs(np.arange(len(b))[None, :] - np.arange(len(a))[:, None] - diagonal)
    drift[a[:, None] != b[None, :]] = far
    q = drift.argmin(1)
    p = np.flatnonzero(drift[np.arange(len(a)), q] < far)
    return p, q[p]


def _sorted_set(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def _jaccard(one: np.ndarray, two: np.ndarray) -> float:
    one, two = _sorted_set(one), _sorted_set(two)
    both = np.sort(np.concatenate((one, two)))
    common = np.count_nonzero(both[1:] == both[:-1])
    return common / (len(one) + len(two) - common)


def _longest(
    a: np.ndarray, b: np.ndarray, diagonal: int, least: int, similarity: float
) -> tuple[int, int, int, int, float] | None:
    """The longest passage of all that begin and end with shared runs. If they are shorter than
    ``least`` in both texts, they are filled up to it."""
    p, q = _nearest(a, b, diagonal)
    if not len(p):
        return None
    if len(p) < similarity * least and len(_sorted_set(a)) == len(a) and len(_sorted_set(b)) == len(b):
        return None  # where no shingle repeats, two passages have at least ``least`` different ones
    # Longer is better as long as shingles go on alike in both: passages hold whole runs.
    cut = (np.diff(p) != 1) | (np.diff(q) != 1)
    first, last = np.flatnonzero(np.concatenate(([True], cut))), np.flatnonzero(np.concatenate((cut, [True])))
    n = np.arange(len(first))
    later = n[None, :] >= n[:, None]
    left = np.minimum.accumulate(np.where(later, q[first][None, :], len(b) - 1), 1)
    right = np.maximum.accumulate(np.where(later, q[last][None, :], 0), 1)
    common = _distinct(a[p], first)[:, last]
    begins = np.unique(np.concatenate((q[first], [len(b) - 1])))
    deepest = _distinct(b, begins)[np.searchsorted(begins, left), right]
    union = _distinct(a, p[first])[:, p[last]] + deepest - common
    wide, deep = p[last][None, :] - p[first][:, None] + 1, right - left + 1
    short = np.maximum(wide, deep) < least
    filled = np.where(short, np.maximum(least - wide, 0) + np.maximum(least - deep, 0), 0)
    right_size = ~short if min(len(a), len(b)) < least else True
    good = later & right_size & (common >= similarity * (union + filled))
    if not good.any():
        return None
    x, y = np.unravel_index(np.where(good, wide + deep, 0).argmax(), good.shape)
    s, e, t, u = int(p[first[x]]), int(p[last[y]]) + 1, int(left[x, y]), int(right[x, y]) + 1
    if short[x, y]:
        e, u = min(max(e, s + least), len(a)), min(max(u, t + least), len(b))
        s, t = min(s, e - least), min(t, u - least)
    return s, e, t, u, _jaccard(a[s:e], b[t:u])


def _around(
    a: np.ndarray, b: np.ndarray, i: int, j: int, size: int, least: int, similarity: float
) -> tuple[int, int, int, int, float] | None:
    """The longest passage around a run that ``a`` has at i and ``b`` at j."""
    lo, base = max(i - least - GAP, 0), max(j - least - GAP, 0)
    near = a[lo : i + size + least + GAP], b[base : j + size + least + GAP]
    found = _longest(*near, j - base - (i - lo), least, similarity)
    return found and (found[0] + lo, found[1] + lo, found[2] + base, found[3] + base, found[4])


def matches(
    a: np.ndarray, b: np.ndarray, least: int, similarity: float, anchor: int, bounded: bool = False
) -> Iterator[tuple[int, int, int, int, float]]:
    """Passages (start, stop in a, start, stop in b, similarity), in shingles, of ``least`` or
    more in one of them, whose sets have at least that Jaccard similarity: first whole runs of
    shared shingles, then what lies around unchanged runs of ``anchor`` or more that are in none.
    ``bounded`` tells that bounds were tried before."""
    order = np.argsort(b, kind="stable")
    held = b[order]
    lo, hi = np.searchsorted(held, a, "left"), np.searchsorted(held, a, "right")
    many = hi - lo
    if not bounded:
        common = len(np.unique(a[many > 0]))
        if not common or common < similarity * least and common < similarity * min(_fewest(a, least), _fewest(b, least)):
            return
    if max(len(a), len(b)) <= SMALL:
        # Where no shingle repeats, there is one way only to place them.
        if (held[1:] != held[:-1]).all():
            if not _longest(a, b, 0, least, similarity):
                return
        elif len(np.unique(a)) == len(a) and not _longest(b, a, 0, least, similarity):
            return
    take = np.where(many > OCCURRENCES, 2, many)
    i = np.repeat(np.arange(len(a)), take)
    nth = np.arange(len(i)) - np.repeat(np.cumsum(take) - take, take)
    at = np.repeat(lo, take) + nth
    ends = (nth == 1) & (np.repeat(many, take) > OCCURRENCES)
    at[ends] = np.repeat(hi, take)[ends] - 1
    j = order[at]
    # Runs lie on one diagonal.
    order = np.lexsort((i, j - i))
    i, j = i[order], j[order]
    new = np.concatenate(([True], (np.diff(i) != 1) | (np.diff(j) != 1)))
    begin = np.flatnonzero(new)
    size = np.diff([*begin, len(i)])
    # Of several places in b the one in the longest run.
    order = np.lexsort((j, -np.repeat(size, size), i))
    order = order[np.concatenate(([True], np.diff(i[order]) > 0))]
    shared, place = i[order], j[order]
    # A passage goes on while its matches lie close to each other in both texts. One that is
    # not similar enough is cut where they lie farthest apart.
    apart = np.maximum(np.diff(shared), np.abs(np.diff(place)))
    cuts = np.flatnonzero(apart > GAP) + 1
    parts = list(zip([0, *cuts], [*cuts, len(shared)], strict=True))
    known = []
    while parts:
        lo, hi = parts.pop()
        s, e = int(shared[lo]), int(shared[hi - 1]) + 1
        t, u = int(place[lo:hi].min()), int(place[lo:hi].max()) + 1
        if max(e - s, u - t) < least:
            continue
        score = _jaccard(a[s:e], b[t:u])
        if score >= similarity:
            known.append((s, e, t, u))
            yield s, e, t, u, score
        elif hi - lo > 1:
            at = lo + 1 + int(apart[lo : hi - 1].argmax())
            parts += [(lo, at), (at, hi)]
    long = np.flatnonzero(size >= anchor)
    for n in long[np.argsort(-size[long], kind="stable")]:
        x, y, many = int(i[begin[n]]), int(j[begin[n]]), int(size[n])
        if any(s <= x and x + many <= e for s, e, _, _ in known) and any(t <= y and y + many <= u for _, _, t, u in known):
            continue
        found = (x, x + many, y, y + many, 1.0) if many >= least else _around(a, b, x, y, many, least, similarity)
        if found:
            known.append(found[:4])
            yield found


NAMES = ["doc_id", "start", "stop", "other_id", "other_start", "other_stop", "similarity"]


def _told(doc, l: int, other, start: int, found: tuple[int, int, int, int, float], least: int) -> tuple:
    """A passage as a row of ``NAMES``; the text in which it is long enough comes first."""
    s, e, t, u, score = found
    one, two = (doc, l + s, l + e + WIDTH - 1), (other, start + t, start + u + WIDTH - 1)
    return (*one, *two, score) if e - s >= least else (*two, *one, score)


def _regions(blocked: Blocked, wanted: DataFrame, rows: int, carried: str) -> DataFrame:
    """The rows of ``wanted`` (_row, l, r and ``carried``, a schema) with the document's id and
    its shingles from l to r."""
    wanted = wanted.withColumn("_block", F.floor(F.col("_row") / rows).cast("long"))
    row_name = blocked.row
    names = [c.split()[0] for c in carried.split(", ")]

    def cut(own: pa.Table, others: pa.Table) -> pa.Table:
        places = {r: i for i, r in enumerate(own.column(row_name).to_pylist())}
        asked = others.sort_by("_row")
        texts, ids = own.column("text"), own.column("doc_id")
        last, shingles = None, None
        regions, docs = [], []
        for row, l, r in zip(*(asked.column(c).to_pylist() for c in ("_row", "l", "r")), strict=True):
            if row != last:
                last, shingles = row, shingle_hashes(texts[places[row]].as_py()).astype(np.uint32)
            regions.append(shingles[l : r + 1].tobytes())
            docs.append(ids[places[row]].as_py())
        kept = asked.select([*names, "_row", "l"])
        return kept.append_column("doc", pa.array(docs, ids.type)).append_column("region", pa.array(regions, pa.binary()))

    schema = f"{carried}, _row long, l int, doc {_id_type(blocked)}, region binary"
    return blocked.with_rows(wanted, cut, schema, ["doc_id", "text"])


def _id_type(blocked: Blocked) -> str:
    return next(f.dataType.simpleString() for f in blocked.table.schema.fields if f.name == "doc_id")


def _rows_of(out: list[tuple], doc: pa.DataType) -> tuple[list[pa.Array], list[str]]:
    types = [doc, pa.int32(), pa.int32(), doc, pa.int32(), pa.int32(), pa.float64()]
    columns = list(zip(*out, strict=True)) if out else [[]] * len(types)
    return [pa.array(c, t) for c, t in zip(columns, types, strict=True)], NAMES


def _schema(blocked: Blocked) -> str:
    ids = _id_type(blocked)
    return f"doc_id {ids}, start int, stop int, other_id {ids}, other_start int, other_stop int, similarity double"


def _verified(blocked: Blocked, pairs: DataFrame, rows: int, least: int, similarity: float, anchor: int) -> DataFrame:
    """Compares pairs: every representative is sent once for some members, each member once.

    Besides ``NAMES`` the rows have the pair (a, b) and the shingles (first, last) of b."""
    sizes = pairs.groupBy("a").count()
    dealt = pairs.join(sizes, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.ceil(F.col("count") / MEMBERS)).cast("int"))
    dealt = Stored(dealt, "pairs").df
    reps = dealt.groupBy("a", "salt").agg(F.min("al").alias("l"), F.max("ar").alias("r"))
    wanted = reps.select("a", "salt", F.lit(0).alias("side"), F.col("a").alias("_row"), "l", "r").unionByName(
        dealt.select("a", "salt", F.lit(1).alias("side"), F.col("b").alias("_row"), F.col("bl").alias("l"), F.col("br").alias("r"))
    )
    regions = _regions(blocked, wanted, rows, "a long, salt int, side int")
    ordered = regions.repartition("a", "salt").sortWithinPartitions("a", "salt", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rep = None
        for batch in batches:
            out, pair = [], []
            for a, _, side, b, l, doc, region in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                shingles = np.frombuffer(region, np.uint32)
                if side == 0:
                    rep = (l, doc, shingles)
                    continue
                start, other, held = rep
                for found in matches(shingles, held, least, similarity, anchor):
                    out.append(_told(doc, l, other, start, found, least))
                    pair.append((a, b, l + found[0], l + found[1] - 1))
            columns, names = _rows_of(out, batch.schema.field("doc").type)
            numbers = list(zip(*pair, strict=True)) if pair else [[]] * 4
            columns += [pa.array(c, pa.int64()) for c in numbers]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "a", "b", "first", "last"])

    return ordered.mapInArrow(compare, f"{_schema(blocked)}, a long, b long, first long, last long")


def _stretches(shared: np.ndarray, gap: np.ndarray, place: np.ndarray, size: np.ndarray, least: int, loss: float) -> np.ndarray:
    """Whether a stretch of ``least`` shingles or more (or a whole region that has fewer) that begins
    here may hold so many shared ones that they make up for its others, of which each takes off
    ``loss``. Each value counts once.

    The regions follow each other: ``place`` and ``size`` tell where in a region a shingle lies and
    how many this has, ``gap`` how far back the value was before (beyond the region if it was not).
    The first ``least`` shingles are counted exactly, of what follows only what is new for certain
    is taken off. So no stretch that is similar enough is missed.
    """
    at = np.arange(len(shared))
    weight = np.where(shared, 1.0, -loss)
    # A value is the first one of its kind for the stretches that begin after it was before.
    change = np.bincount(at - np.minimum(gap, least) + 1, weight, len(shared)).astype(np.float64)
    change[1:] -= weight[:-1]
    begun = np.cumsum(change)
    after = np.cumsum(np.where(shared, gap > least, np.where(gap > place, -loss, 0.0)))
    # Regions lie so far apart in height that none sees into the next.
    height = (after.max(initial=0) - after.min(initial=0) + 1) * np.cumsum(place == 0)
    after -= height
    highest = np.maximum.accumulate(after[::-1])[::-1]
    least = np.minimum(least, size)
    whole = np.flatnonzero(place + least <= size)
    last = whole + least[whole] - 1
    found = np.zeros(len(shared), bool)
    found[whole] = begun[whole] + highest[last] - after[last] >= -1e-3 - 1e-15 * height.max(initial=0)
    return found


class _Regions:
    """Regions of documents one after the other: for each shingle its number, its region, its place
    in it, how many the region has and how far back the same one was before."""

    def __init__(self, held: list[np.ndarray]):
        _, self.number = np.unique(np.concatenate([np.empty(0, np.uint32), *held]), return_inverse=True)
        self.sizes = np.array([len(h) for h in held], np.int64)
        self.ends = np.cumsum(self.sizes)
        self.begins = self.ends - self.sizes
        self.owner = np.repeat(np.arange(len(held)), self.sizes)
        at = np.arange(len(self.number))
        self.place, self.size = at - self.begins[self.owner], self.sizes[self.owner]
        self.base = int(self.number.max(initial=0)) + 1
        self.known = self.owner * self.base + self.number
        seen = _last_seen(self.known)
        self.gap = np.where(seen < 0, self.place + 1, at - seen)
        self.known.sort()

    def holding(self, shared: np.ndarray, least: int, loss: float, at=slice(None)) -> np.ndarray:
        """The regions (of the shingles ``at``, which are whole regions) that hold a stretch."""
        found = _stretches(shared, self.gap[at], self.place[at], self.size[at], least, loss)
        return np.unique(self.owner[at][found])

    def fewest(self, least: int, loss: float) -> np.ndarray:
        """Of each region the fewest distinct shingles in the first ``least`` of a stretch of
        shingles that other regions have too; infinite if it has no stretch."""
        common = np.bincount(self.number[self.gap > self.place], minlength=self.base) > 1
        begin = np.flatnonzero(_stretches(common[self.number], self.gap, self.place, self.size, least, loss))
        change = np.bincount(np.arange(len(self.gap)) - np.minimum(self.gap, least) + 1, minlength=len(self.gap))
        change[1:] -= 1
        found = np.full(len(self.sizes), np.inf)
        np.minimum.at(found, self.owner[begin], np.cumsum(change)[begin])
        return found


def _compared(group: pa.Table, least: int, similarity: float, anchor: int) -> pa.Table:
    """Compares the documents of a piece that ask with those that are asked, until each is linked
    to all that it may match.

    A passage shares most of its shingles with the other one, so a document without a stretch of
    shingles most of which others have too matches none. Without it, others may have none either.
    """
    short = math.ceil(similarity * least - 1e-9)
    loss = similarity / (1 - similarity) if similarity < 1 else 2.0**20
    doc, group = group.schema.field("doc").type, group.sort_by("_row")
    while True:
        held = [np.frombuffer(r, np.uint32) for r in group.column("region").to_pylist()]
        regions = _Regions(held)
        fewest = regions.fewest(least, loss)
        able = np.isfinite(fewest) & (regions.sizes >= short)
        if 10 * np.count_nonzero(~able) <= len(able):
            break
        group = group.filter(pa.array(able))
    row, l, alone, asking, asked = (group.column(c).to_numpy() for c in ("_row", "l", "alone", "asking", "asked"))
    docs = group.column("doc").to_pylist()
    number, owner, first = regions.number, regions.owner, regions.gap > regions.place
    asked = asked & able
    marks = np.zeros(regions.base, bool)
    # Those that matched the first document are linked through it.
    label = np.where(alone, np.arange(len(held)), -1)
    out = []
    for x in np.flatnonzero(asking & able):
        likely = asked & (label != label[x])
        likely &= ~alone | (row > row[x])  # of two without a match the first one asks
        if not likely.any():
            continue
        mine = slice(regions.begins[x], regions.ends[x])
        own = number[mine]
        marks[own] = True
        at = np.flatnonzero(likely[owner])
        shared = np.bincount(owner[at][marks[number[at]] & first[at]], minlength=len(held))
        likely &= shared >= similarity * np.maximum(fewest, fewest[x]) - 1e-9
        # What two passages do not share is little, and in one of them at most half of it. One may
        # be shorter than ``least``, but what it lacks then is so little that the bound holds.
        at = np.flatnonzero(likely[owner])
        present = marks[number[at]]
        marks[own] = False
        chosen = regions.holding(present, least, loss, at)
        half = np.isin(chosen, regions.holding(present, short, 2 * loss, at))
        kept = []
        for lo in range(0, len(chosen), MEMBERS):
            part = chosen[lo : lo + MEMBERS]
            wanted = (part[:, None] * regions.base + own[None, :]).ravel()
            present = regions.known[np.minimum(np.searchsorted(regions.known, wanted), len(regions.known) - 1)] == wanted
            tiled = [np.tile(v[mine], len(part)) for v in (regions.gap, regions.place, regions.size)]
            enough, less = (
                _stretches(present, *tiled, *how).reshape(len(part), -1).any(1) for how in ((least, loss), (short, 2 * loss))
            )
            kept.append(part[enough & (less | half[lo : lo + MEMBERS])])
        likely = np.concatenate([np.empty(0, np.int64), *kept])
        for y in likely[np.argsort(-shared[likely], kind="stable")]:
            if label[x] == label[y]:
                continue
            for found in matches(held[x], held[y], least, similarity, anchor, bounded=True):
                out.append(_told(docs[x], int(l[x]), docs[y], int(l[y]), found, least))
                label[label == label[x]] = label[y]
    columns, names = _rows_of(out, doc)
    return pa.table(columns, names=names)


def _among_others(
    blocked: Blocked, seeded: DataFrame, found: DataFrame, rows: int, wide: int, least: int, similarity: float, anchor: int, piece: int
) -> DataFrame:
    """Compares documents that did not match the first one of their group with its others.

    A group is what has seeds in one stretch of its first document. Its documents are dealt to
    pieces; each piece of those without a match meets each piece of all, where a document is
    compared until it is linked, through whatever others, to all that it may match.
    """
    reach = least + GAP
    linked = found.select("a", "b", "first", "last")
    covered = F.col("first").isNotNull() & F.col("place").between(F.col("first"), F.col("last"))
    members = (
        seeded.join(linked, ["a", "b"], "left")
        .groupBy("a", F.floor(F.col("at") / least).cast("int").alias("part"), "b")
        .agg(F.min("place").alias("l"), F.max("place").alias("r"), (~F.bool_or(covered)).alias("alone"))
    )
    members = Stored(members, "members").df
    sizes = members.groupBy("a", "part").agg(
        F.ceil(F.count(F.lit(1)) / piece).cast("int").alias("pieces"),
        F.ceil(F.count_if("alone") / piece).cast("int").alias("asking"),
        F.count(F.lit(1)).alias("many"),
    )
    among = members.join(sizes.where("asking > 0 and many > 1"), ["a", "part"])
    mine = F.pmod(F.xxhash64("b"), F.col("pieces")).cast("int")
    asks = F.when(F.col("alone"), F.pmod(F.xxhash64("b"), F.col("asking")).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col("asking") - 1), lambda x: F.struct(x.alias("x"), F.col("mine").alias("y")))
    further = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda y: F.struct(F.col("asks").alias("x"), y.alias("y")))
    dealt = among.withColumn("mine", mine).withColumn("asks", asks).withColumn(
        "cell", F.explode(F.when(F.col("alone"), F.array_union(cells, further)).otherwise(cells))
    )
    wanted = dealt.select(
        "a", "part", F.col("cell.x").alias("x"), F.col("cell.y").alias("y"), "alone",
        F.coalesce(F.col("asks") == F.col("cell.x"), F.lit(False)).alias("asking"), (F.col("mine") == F.col("cell.y")).alias("asked"),
        F.col("b").alias("_row"), F.greatest(F.col("l") - reach, F.lit(0)).alias("l"), (F.col("r") + wide + reach).alias("r"),
    )
    regions = _regions(blocked, wanted, rows, "a long, part int, x int, y int, alone boolean, asking boolean, asked boolean")

    def compare(group: pa.Table) -> pa.Table:
        return _compared(group, least, similarity, anchor)

    return regions.groupBy("a", "part", "x", "y").applyInArrow(compare, _schema(blocked))


def near_passages(
    documents: DataFrame,
    *,
    min_words: int = MIN_WORDS,
    similarity: float = SIMILARITY,
    hashes: int = HASHES,
    enough: int = ENOUGH,
    rows: int = BLOCK_ROWS,
    piece: int = PIECE,
) -> DataFrame:
    """Rows (doc_id, start, stop, other_id, other_start, other_stop, similarity): passages of
    ``min_words`` words or more that two documents share, in word positions, stop exclusive.

    Words are cut at ASCII white space and compared without case (A-Z). Two passages match if
    the sets of their five-word shingles have at least the Jaccard similarity; where they begin
    and end with shared shingles, that of ``other_id`` may be shorter; no shorter ones are searched
    for among the others of a group in texts that repeat their own words. Documents with
    the same passage are tied to a common representative, or to others of its group, rather than
    all to each other, and exact copies of a text to the first of them, with similarity 1 over
    the whole text: what all matches connect, the rows connect.

    Null, empty and short texts share nothing. Repeated rows are copies of each other. A
    passage repeated within one document only is not reported. A null doc_id is reported as
    null. Other columns are ignored; an empty table gives no rows. Texts are read whole.
    """
    least = max(min_words - WIDTH + 1, 1)
    seed = seed_shape(least, similarity)
    anchor = seed[0] - WIDTH + 1
    blocked = in_blocks(documents.select("doc_id", "text"), rows)
    text = F.col("text")
    places = F.struct(F.col(blocked.row).alias("row"), F.col("doc_id").alias("doc"))
    marks = blocked.table.where(text.isNotNull()).select(
        F.col(blocked.block).alias("_block"), F.col(blocked.row).alias("_row"), "doc_id",
        F.xxhash64(text).alias("h"), F.xxhash64(F.lit(1), text).alias("h2"), word_count(text).cast("int").alias("n"), places.alias("place"),
    )
    firsts = marks.groupBy("h", "h2").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("many")).where("many > 1")
    copies = Stored(
        marks.join(firsts, ["h", "h2"]).where("_row <> first.row").select("_block", "_row", "doc_id", "n", F.col("first.doc").alias("other_id")),
        "copies",
    ).df
    everything = _windows(blocked, copies.select("_block", "_row"), hashes, least, seed)
    same = Window.partitionBy("key")
    crowded = everything.withColumn("low", F.min("_row").over(same)).withColumn("high", F.max("_row").over(same)).where("low < high")
    k, l, r = F.col("tag").bitwiseAND(255), F.shiftright("span", 32), F.col("span").bitwiseAND(2**32 - 1)
    windows = Stored(
        crowded.select(
            "_row", "key", F.shiftright("tag", 8).alias("sig"), k.cast("int").alias("k"), l.cast("int").alias("l"), r.cast("int").alias("r")
        ),
        "windows",
    )
    seeded = Stored(_seeded(windows.df.where(F.col("k") == hashes)), "seeds").df
    hulls = _pairs(windows.df.where(F.col("k") < hashes), enough).unionByName(_seed_pairs(seeded, anchor, least + GAP))
    pairs = hulls.groupBy("a", "b").agg(*[F.min(c).alias(c) if c.endswith("l") else F.max(c).alias(c) for c in ("al", "ar", "bl", "br")])
    found = Stored(_verified(blocked, pairs, rows, least, similarity, anchor), "found").df
    further = _among_others(blocked, seeded, found, rows, anchor, least, similarity, anchor, piece)
    whole = copies.where(F.col("n") >= min_words).select(
        "doc_id", F.lit(0).alias("start"), F.col("n").alias("stop"), "other_id",
        F.lit(0).alias("other_start"), F.col("n").alias("other_stop"), F.lit(1.0).alias("similarity"),
    )
    return found.select(*NAMES).unionByName(further).unionByName(whole)
