"""Importance resampling towards a target distribution.

Texts are cut into words by a pre-tokenizer that needs no training; windows of consecutive
words are counted in hashed buckets, once for the corpus and once for the target. A bucket's
gain is the logarithm of how much likelier it is in the target, a document's weight the sum of
its gains, and documents are drawn without replacement by weight plus Gumbel noise.

Texts are read once: what is stored of a document is the bucket of each of its windows. The
only table sent to every task is the gains, one number per bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.llm.common import Stored, free_name
from tidelog.plans.prefix import Scan, prefix

# A word: a run of ASCII digits, lower-case letters and anything beyond ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BUCKETS = 10_000
SLICE_ROWS = 256


def splitter():
    """The pre-tokenizer: returns the words of a text with their offsets."""
    from tokenizers import Regex, pre_tokenizers

    return pre_tokenizers.Split(Regex(WORD), behavior="removed", invert=True)


def window_hashes(raw: bytes, longest: int, split) -> tuple[int, np.ndarray]:
    """The number of words of a text (UTF-8) and the CRC of every window of 1 to ``longest``.

    Only ASCII letters are lowered. The words are laid out with single spaces between them, so
    a window is what lies between the start of its first word and the end of its last.
    """
    text = raw.lower().decode("utf-8", "replace")
    words = [piece.encode() for piece, _ in split.pre_tokenize_str(text)]
    hashes = [crc32(word) for word in words]
    if longest > 1 and words:
        line = memoryview(b" ".join(words))
        ends = np.cumsum([len(word) + 1 for word in words]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        ends = ends.tolist()
        for length in range(2, longest + 1):
            pairs = zip(starts, ends[length - 1 :], strict=False)
            hashes += [crc32(line[start:end]) for start, end in pairs]
    return len(words), np.array(hashes, np.uint32)


def _hash_windows(longest: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = splitter()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                texts = part.column(1).cast(pa.binary()).to_pylist()
                found = [window_hashes(raw or b"", longest, split) for raw in texts]
                sizes = [len(hashes) for _, hashes in found]
                flat = np.concatenate([hashes for _, hashes in found]) % np.uint32(buckets)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.astype(np.int32)))
                words = pa.array([n for n, _ in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), words, lists], names=["doc_id", "n_words", "features"]
                )

    return run


def hashed(texts: DataFrame, longest: int, buckets: int, id_column: str) -> DataFrame:
    """Rows (doc_id, n_words, features): the bucket of every window of every text."""
    rows = texts.select(F.col(id_column).cast("long").alias("doc_id"), F.col("text").cast("string"))
    return rows.mapInArrow(
        _hash_windows(longest, buckets), "doc_id long, n_words long, features array<int>"
    )


def _count_buckets(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=buckets)
        held = np.flatnonzero(total)
        columns = [pa.array(held), pa.array(total[held])]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "n"])

    return run


def histogram(features: DataFrame, buckets: int) -> np.ndarray:
    """How often each bucket occurs; counted per partition, summed by bucket."""
    partial = features.select("features").mapInArrow(_count_buckets(buckets), "bucket long, n long")
    counts = np.zeros(buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).toLocalIterator():
        counts[row.bucket] = row.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's chances, counts raised by one, rounded down."""
    buckets = len(corpus)
    all_corpus, all_target = int(corpus.sum()), int(target.sum())
    out = np.empty(buckets, np.int64)
    for bucket, (s, t) in enumerate(zip(corpus.tolist(), target.tolist(), strict=True)):
        ratio = ((t + 1) * (all_corpus + buckets)) / ((s + 1) * (all_target + buckets))
        out[bucket] = np.floor(1000 * np.log(ratio))
    return out


def _sum_gains(by_bucket: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False)[offsets[0] : offsets[-1]]
            running = np.concatenate(([0], np.cumsum(by_bucket[flat])))
            weights = np.diff(running[offsets - offsets[0]])
            columns = [
                batch.column(0), batch.column(1),
                pa.array(np.diff(offsets).astype(np.int64)), pa.array(weights),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "n_features", "weight"])

    return run


def gumbel(seed: int, doc_id: Column) -> Column:
    """Thousandths of a Gumbel draw that depends on the seed and the id alone, rounded down."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digits = F.substring(F.sha2(text, 256), 1, 8)
    h = F.conv(digits, 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance(
    documents: DataFrame,
    target: DataFrame,
    *,
    longest: int = 1,
    buckets: int = BUCKETS,
    percent: int = 10,
    min_words: int = 20,
    seed: int = 2024,
    id_column: str = "doc_id",
) -> DataFrame:
    """Rows (doc_id, n_features, weight, score, rank), all long, one per document.

    Features are the windows of 1 to ``longest`` words, repeats counted. Of the documents with
    ``min_words`` words or more, ``percent`` of a hundred (rounded down) with the highest
    scores are drawn, ties to the smaller id (null first); ``rank`` numbers them from 1 and is
    null for the others.

    A null or empty text, and one without words, has no features and weight 0. Texts are used
    whole, however long. Repeated rows are counted, scored and drawn each on its own (their
    noise is the same, as it depends on the id; a null id counts as an empty one). Other
    columns, whatever their names, are ignored. An empty table gives no rows; an empty target
    weighs every bucket by its share of the corpus alone.
    """
    known = Stored(hashed(documents, longest, buckets, id_column), "features")
    wanted = hashed(target.select(F.lit(0).alias("doc_id"), "text"), longest, buckets, "doc_id")
    by_bucket = gains(histogram(known.df, buckets), histogram(wanted, buckets))
    weighed = known.df.mapInArrow(
        _sum_gains(by_bucket), "doc_id long, n_words long, n_features long, weight long"
    )
    scored = Stored(
        weighed.select(
            "doc_id", "n_features", "weight",
            (F.col("weight") + gumbel(seed, F.col("doc_id"))).alias("score"),
            (F.col("n_words") < min_words).alias("short"),
        ).withColumn("behind", -F.col("score")),
        "scored",
    )
    known.delete()
    drawn = scored.df.where("not short").count() * percent // 100
    placed = prefix(scored.df, [], ["short", "behind", "doc_id"], {"place": Scan("count")})
    scored.delete()
    rank = F.when(~F.col("short") & (F.col("place") <= drawn), F.col("place"))
    return placed.select("doc_id", "n_features", "weight", "score", rank.cast("long").alias("rank"))


def resampled(documents: DataFrame, target: DataFrame, *, id_column: str = "doc_id", **how) -> DataFrame:
    """The drawn documents with all their columns; rows that share an id are kept together."""
    found = importance(documents, target, id_column=id_column, **how).where("rank is not null")
    mark = free_name(documents, "_drawn")
    ids = found.select(F.col("doc_id").alias(mark)).distinct()
    return documents.join(ids, documents[id_column].cast("long").eqNullSafe(ids[mark]), "left_semi")
