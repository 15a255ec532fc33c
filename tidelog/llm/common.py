"""Small helpers shared by the operators."""

from __future__ import annotations

import ctypes
import sys
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelog.plans.scratch import new_folder

# ASCII white space; everything else belongs to words.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def delete_folder(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


class Stored:
    """A table written to the shared folder, and how to delete it."""

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = new_folder(self.spark, label)
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def delete(self) -> None:
        delete_folder(self.spark, self.path)


def shuffled(table: DataFrame) -> DataFrame:
    """``table`` as a side of a join that must not be broadcast, as it grows with the input.

    Spark goes by the bytes of compressed files and takes what an explode makes for as small as
    what it reads, so a table it finds small enough may not fit the driver.
    """
    return table.hint("merge")


@contextmanager
def temporary(df: DataFrame, label: str):
    """Yields ``df`` as a stored table that is deleted at the end of the block."""
    stored = Stored(df, label)
    try:
        yield stored.df
    finally:
        stored.delete()


def release() -> None:
    """Hands freed memory back to the system; a worker that is used again would keep it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform == "linux" else None
    if trim is not None:
        trim(0)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def word_count(text: Column) -> Column:
    """Number of maximal runs without ASCII white space; 0 for null."""
    runs = F.size(F.split(text, r"[\x20\x09-\x0D]+"))
    outer = F.when(text.rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    outer = outer + F.when(text.rlike(r"[\x20\x09-\x0D]\z"), 1).otherwise(0)
    blank = text.isNull() | ~text.rlike(WORD_PATTERN)
    return F.when(blank, F.lit(0)).otherwise(runs - outer).cast("long")


def uniform(seed: int, *columns) -> Column:
    """A number in (0, 1) that depends on the columns and the seed alone."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return (bits.cast("double") + 0.5) * float(2.0**-53)


def word_bytes(text: str | None, lower: bool = False) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a text joined by single spaces, as bytes, with their starts and ends."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    if lower:
        raw = raw.lower()  # of bytes: ASCII letters only
    # split() of bytes cuts at exactly the six ASCII white space characters
    joined = b" ".join(raw.split())
    if not joined:
        return b"", np.empty(0, np.int64), np.empty(0, np.int64)
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = np.concatenate(([0], gaps + 1))
    ends = np.concatenate((gaps, [len(joined)]))
    return joined, starts, ends
