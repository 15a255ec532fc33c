"""Byte-level BPE encoding and decoding.

Texts are cut by the tokenizer's pattern. Every distinct word that is not a token itself is
encoded once: a fold over its bytes merges, step by step, the pair with the lowest rank, which
it looks up in a literal rank map. The words' ids then go back to the documents' blocks.
Decoding concatenates the binary pieces of the ids.

The fold has two forms that give the same ids: ``fold_merges`` made of higher-order functions,
and ``merge_bytes``, which runs in Python on batches of distinct words and is the one ``encode``
takes unless told otherwise, for it needs a small part of the time.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.blocks import BLOCK_ROWS, answered, in_blocks

SLOTS = 1 << 17
# Bytes of a word up to which the native fold, quadratic in them, is used; longer words are
# merged with a heap, to the same ids.
FOLD_BYTES = 128
NEVER = 1 << 60  # the rank of a pair that does not merge


@dataclass(frozen=True)
class Vocabulary:
    """``pieces[id]`` are the bytes of a token; ``merges[a, b]`` the id two tokens merge to.

    Ids of merged tokens rise with their rank.
    """

    pieces: list[bytes]
    merges: dict[tuple[int, int], int]
    words: dict[str, int] = field(default_factory=dict)

    @property
    def start(self) -> dict[bytes, int]:
        """The tokens of single bytes."""
        return {p: i for i, p in enumerate(self.pieces) if len(p) == 1}


def _with_words(pieces: list[bytes], merges) -> Vocabulary:
    """Adds the tokens that the merges themselves make of a whole word."""
    words = {}
    start = {p: i for i, p in enumerate(pieces) if len(p) == 1}
    for number, piece in enumerate(pieces):
        try:
            word = piece.decode()
        except UnicodeDecodeError:
            continue
        if merge_bytes(piece, start, merges) == [number]:
            words[word] = number
    return Vocabulary(pieces, merges, words)


def from_ranks(path: str) -> Vocabulary:
    """A rank file: a line per token with its base64 bytes and its rank, which is its id.

    Any two tokens merge whose joined bytes are a token.
    """
    with open(path, "rb") as lines:
        ranked = sorted((int(b), base64.b64decode(a)) for a, b in (line.split() for line in lines if line.strip()))
    pieces = [piece for _, piece in ranked]
    ids = {piece: i for i, piece in enumerate(pieces)}
    if [r for r, _ in ranked] != list(range(len(ranked))):
        raise ValueError("ranks are not 0, 1, 2, ...")
    merges = {
        (ids[p[:cut]], ids[p[cut:]]): i
        for i, p in enumerate(pieces)
        for cut in range(1, len(p))
        if p[:cut] in ids and p[cut:] in ids
    }
    found = _with_words(pieces, merges)
    # A word that is a token is that token, whatever the merges make of it.
    for i, piece in enumerate(pieces):
        try:
            found.words[piece.decode()] = i
        except UnicodeDecodeError:
            continue
    return found


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1
    characters for themselves, the other bytes, in order, for U+0100 and up."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def from_json(path: str) -> tuple[Vocabulary, list[str], bool]:
    """A byte-level BPE tokenizer file: its vocabulary and special strings.

    Only listed pairs merge. The last value says whether words that are tokens skip the merges.
    """
    with open(path, encoding="utf-8") as f:
        told = json.load(f)
    model, letters = told["model"], byte_letters()
    spoken = {i: bytes(letters[c] for c in token) for token, i in model["vocab"].items() if all(c in letters for c in token)}
    pieces = [spoken.get(i, b"") for i in range(max(spoken) + 1)]
    merges = {}
    for pair in model["merges"]:
        a, b = pair.split(" ") if isinstance(pair, str) else pair
        merges[model["vocab"][a], model["vocab"][b]] = model["vocab"][a + b]
    if list(merges.values()) != sorted(set(merges.values())):
        raise ValueError("ids do not rise with the merges")
    return _with_words(pieces, merges), [t["content"] for t in told["added_tokens"]], bool(model["ignore_merges"])


def merge_bytes(word: bytes, start: dict[bytes, int], merges: dict[tuple[int, int], int]) -> list[int]:
    """Ids of a word: of its pairs the one of lowest rank merges, the leftmost of equal ones.

    Long words keep their pairs in a heap.
    """
    ids: list[int | None] = [start[word[i : i + 1]] for i in range(len(word))]
    if len(ids) <= 32:
        get = merges.get
        ranks = [get(pair, NEVER) for pair in zip(ids, ids[1:], strict=False)]
        while ranks and (best := min(ranks)) != NEVER:
            at = ranks.index(best)
            ids[at : at + 2] = [best]
            del ranks[at]
            if at:
                ranks[at - 1] = get((ids[at - 1], best), NEVER)
            if at + 1 < len(ids):
                ranks[at] = get((best, ids[at + 1]), NEVER)
        return ids
    after = [*range(1, len(ids)), None]
    before = [None, *range(len(ids) - 1)]
    heap = [(m, i, ids[i], ids[i + 1]) for i in range(len(ids) - 1) if (m := merges.get((ids[i], ids[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        merged, i, a, b = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j is None or ids[j] != b:
            continue
        ids[i], ids[j] = merged, None
        after[i] = after[j]
        if after[j] is not None:
            before[after[j]] = i
        for left, right in ((before[i], i), (i, after[i])):
            if left is not None and right is not None:
                m = merges.get((ids[left], ids[right]))
                if m is not None:
                    heapq.heappush(heap, (m, left, ids[left], ids[right]))
    return [i for i in ids if i is not None]


def _literal(values: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), kind)


class RankMap:
    """The merges as literal arrays: the slot of a pair holds its key and what it merges to."""

    def __init__(self, merges: dict[tuple[int, int], int]):
        keys: list[list[int]] = [[] for _ in range(SLOTS)]
        found: list[list[int]] = [[] for _ in range(SLOTS)]
        for (a, b), merged in merges.items():
            slot = (a * 7_919 + b) % SLOTS
            keys[slot].append(a * (1 << 24) + b)
            found[slot].append(merged)
        self.keys = _literal(keys, "array<array<bigint>>")
        self.merged = _literal(found, "array<array<int>>")

    def get(self, a: Column, b: Column) -> Column:
        """The merged id, or null."""
        a, b = a.cast("long"), b.cast("long")
        slot = ((a * 7_919 + b) % SLOTS).cast("int")
        at = F.array_position(F.get(self.keys, slot), a * (1 << 24) + b)
        return F.get(F.get(self.merged, slot), (at - 1).cast("int"))


def fold_merges(word: Column, vocabulary: Vocabulary) -> Column:
    """Ids (array of int) of a word, by folding merges over its bytes."""
    ranks = RankMap(vocabulary.merges)
    start = vocabulary.start
    first = _literal([start[bytes([b])] for b in range(256)], "array<int>")
    letters = F.split(F.decode(F.encode(word, "UTF-8"), "ISO-8859-1"), "")
    ids = F.transform(letters, lambda c: F.get(first, F.ascii(c)))

    def lowest(s: Column) -> Column:
        """Merged id and place of the best pair, as one number; null if none merges."""
        pairs = F.zip_with(s, F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), ranks.get)
        placed = F.transform(pairs, lambda m, i: m.cast("long") * (1 << 24) + i)
        return F.array_min(placed)

    def weighed(s: Column) -> Column:
        return F.get(F.transform(F.array(s), lambda x: F.struct(x.alias("s"), lowest(x).alias("best"))), 0)

    def step(state: Column, _: Column) -> Column:
        at = F.pmod(state["best"], F.lit(1 << 24)).cast("int")
        merged = F.floor(state["best"] / (1 << 24)).cast("int")
        rest = F.slice(state["s"], at + 3, F.greatest(F.size(state["s"]) - at - 2, F.lit(0)))
        joined = F.concat(F.slice(state["s"], F.lit(1), at), F.array(merged), rest)
        return F.when(state["best"].isNull(), state).otherwise(weighed(joined))

    steps = F.sequence(F.lit(1), F.greatest(F.octet_length(word), F.lit(1)))
    return F.aggregate(steps, weighed(ids), step, lambda state: state["s"])


def encode_words(words: DataFrame, vocabulary: Vocabulary, name: str = "ids", native: bool = False) -> DataFrame:
    """Adds the ids of column ``key`` as column ``name``; with higher-order functions if ``native``."""
    short = F.octet_length("key") <= FOLD_BYTES
    schema = T.StructType([*words.schema.fields, T.StructField(name, T.ArrayType(T.IntegerType()))])
    start, merges = vocabulary.start, vocabulary.merges

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [merge_bytes(w.as_py().encode(), start, merges) for w in batch.column("key")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(found, pa.list_(pa.int32()))], names=[*batch.schema.names, name]
            )

    if not native:
        return words.mapInArrow(merge, schema)
    folded = words.where(short).withColumn(name, fold_merges(F.col("key"), vocabulary))
    return folded.unionByName(words.where(~short).mapInArrow(merge, schema))


def encode(documents: DataFrame, vocabulary: Vocabulary, pattern: str, *, name: str = "ids", rows: int = BLOCK_ROWS, native: bool = False) -> DataFrame:
    """Adds the token ids of ``text`` (array of int) as column ``name``.

    A null or empty text has no ids. Texts are encoded whole, of any length; repeated rows and
    other columns pass through, one named like the added one is replaced; an empty table stays
    empty.
    """
    import regex

    documents = documents.drop(name)
    words = vocabulary.words
    find = regex.compile(pattern).findall

    def ask(texts: list[str | None]) -> set:
        seen: set[str] = set()
        for text in texts:
            if text:
                seen.update(find(text))
        return seen.difference(words)

    def finish(own: pa.Table, answers: pa.Table | None) -> pa.Table:
        table, starts, counts, values = dictionary(vocabulary, answers)
        lists, ends = [np.empty(0, np.int32)], [0]
        for text in own.column("text"):
            found = find(text.as_py() or "")
            at = np.fromiter(map(table.__getitem__, found), np.int64, len(found))
            many = counts[at]
            stop = np.cumsum(many)
            size = int(stop[-1]) if len(stop) else 0
            lists.append(values[np.arange(size) + np.repeat(starts[at] - stop + many, many)])
            ends.append(ends[-1] + size)
        offsets = pa.array(np.array(ends, np.int64), pa.int64())
        found = pa.LargeListArray.from_arrays(offsets, pa.array(np.concatenate(lists), pa.int32()))
        return own.append_column(name, found.cast(pa.list_(pa.int32())))

    return answered(
        in_blocks(documents, rows),
        ask=ask,
        key_type=T.StringType(),
        resolve=lambda grouped: encode_words(grouped, vocabulary, native=native).select("askers", "ids"),
        finish=finish,
        added=[T.StructField(name, T.ArrayType(T.IntegerType()))],
    )


def dictionary(vocabulary: Vocabulary, answers: pa.Table | None):
    """Word to place, and per place the start and number of its ids among all ids.

    Answers are ids alone, since their pieces spell the word.
    """
    words = vocabulary.words
    own = np.fromiter(words.values(), np.int32, len(words))
    table = dict(zip(words, range(len(own)), strict=True))
    counts, values = np.ones(len(own), np.int64), own
    if answers is not None:
        lists = answers.column("ids").combine_chunks()
        flat = pc.list_flatten(lists)
        spoken = pa.array(vocabulary.pieces, pa.binary()).take(flat)
        keys = pc.binary_join(pa.ListArray.from_arrays(lists.offsets, spoken), b"").cast(pa.string()).to_pylist()
        table.update(zip(keys, range(len(own), len(own) + len(keys)), strict=True))
        counts = np.concatenate((counts, pc.list_value_length(lists).to_numpy()))
        values = np.concatenate((own, flat.to_numpy().astype(np.int32)))
    return table, np.cumsum(counts) - counts, counts, values


def decode(ids: Column, vocabulary: Vocabulary) -> Column:
    """The bytes (binary) of an array of ids: their pieces one after another.

    Null for null; an id outside the vocabulary has no bytes.
    """
    pieces = _literal([p.decode("latin-1") for p in vocabulary.pieces], "array<string>")
    text = F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), "")
    return F.encode(text, "ISO-8859-1")


def digests(encoded: DataFrame, vocabulary: Vocabulary, name: str = "ids") -> DataFrame:
    """Replaces the ids by n_tokens, ids_sha256 and decoded_sha256."""
    ids = F.col(name)
    spoken = F.encode(F.array_join(ids.cast("array<string>"), " "), "UTF-8")
    return encoded.withColumns(
        {
            "n_tokens": F.size(ids).cast("long"),
            "ids_sha256": F.sha2(spoken, 256),
            "decoded_sha256": F.sha2(decode(ids, vocabulary), 256),
        }
    ).drop(name)
