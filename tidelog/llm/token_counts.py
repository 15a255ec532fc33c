"""Token counts without token ids: pieces per distinct word, summed per document."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.blocks import BLOCK_ROWS, answered, in_blocks
from tidelog.llm.bpe import Vocabulary, merge_bytes


def token_counts(
    documents: DataFrame,
    vocabulary: Vocabulary,
    specials: list[str],
    pattern: str,
    *,
    limit: int = 512,
    rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Adds n_bytes, n_tokens and over_limit (more than ``limit`` tokens) to every document.

    The pieces of every distinct word are counted once and joined to the words of the
    documents. A special string inside a text is one token and cuts the text. A null or empty
    text has 0 bytes and tokens. Columns named like the added ones are replaced, others pass
    through; repeated rows are counted each; an empty table stays empty.
    """
    import regex

    words = vocabulary.words
    find = regex.compile(pattern).findall
    longest_first = sorted(filter(None, specials), key=len, reverse=True)
    cut = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)").split

    def pieces(text: str | None) -> tuple[int, list[str]]:
        """Number of special strings, and the words between them."""
        if not text:
            return 0, []
        if not any(s in text for s in longest_first):
            return 0, find(text)
        parts = cut(text)
        return len(parts) - 1, [w for part in parts for w in find(part)]

    def ask(texts: list[str | None]) -> set:
        seen: set[str] = set()
        for text in texts:
            seen.update(pieces(text)[1])
        return seen.difference(words)

    start, merges = vocabulary.start, vocabulary.merges

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            many = [len(merge_bytes(w.encode(), start, merges)) for w in batch.column("key").to_pylist()]
            columns = [*batch.columns, pa.array(many, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "pieces"])

    def finish(own: pa.Table, answers: pa.Table | None) -> pa.Table:
        table = dict.fromkeys(words, 1)
        if answers is not None:
            table.update(zip(answers.column("key").to_pylist(), answers.column("pieces").to_pylist(), strict=True))
        tokens = np.zeros(own.num_rows, np.int64)
        for n, text in enumerate(own.column("text")):
            special, found = pieces(text.as_py())
            tokens[n] = special + sum(map(table.__getitem__, found))
        return own.append_column("n_tokens", pa.array(tokens))

    added = ("n_bytes", "n_tokens", "over_limit")
    kept = documents.select(*[c for c in documents.columns if c.lower() not in added])
    counted = answered(
        in_blocks(kept, rows),
        ask=ask,
        key_type=T.StringType(),
        resolve=lambda grouped: grouped.mapInArrow(count, T.StructType([*grouped.schema.fields, T.StructField("pieces", T.IntegerType())])),
        finish=finish,
        added=[T.StructField("n_tokens", T.LongType())],
    )
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return counted.withColumns({"n_bytes": size, "over_limit": F.col("n_tokens") > limit})
