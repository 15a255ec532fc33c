"""Per-document work that needs entries of a table too large to broadcast.

Documents are numbered into blocks of consecutive rows. Each block asks for every key it needs
once; equal keys of many blocks meet in one row and are resolved once; the answers go back to
their blocks, and each block is finished with its answers at hand. What is shuffled are the
distinct keys of blocks, not the occurrences: the texts themselves are stored once, bucketed by
block, and never shuffled.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.common import free_name, parallelism, release
from tidelog.plans.scratch import new_folder

BLOCK_ROWS = 8_192
# Blocks, about, whose requests for one key share a row; bounds the list of askers.
FAMILY = 4_096
# Answers a task gathers before it packs them for their blocks.
PORTION = 500_000


@dataclass(frozen=True)
class Blocked:
    """A stored table; ``block`` and ``row`` name the columns that number blocks and rows, and
    blocks fall into ``families``."""

    table: DataFrame
    block: str
    row: str
    columns: list[str]
    families: int

    @property
    def schema(self) -> T.StructType:
        return T.StructType([f for f in self.table.schema.fields if f.name in self.columns])

    def with_rows(self, others: DataFrame, apply, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
        """``apply`` (documents, others) for each block, ``others`` dealt by their ``_block``."""
        own = self.table.select(self.block, self.row, *(self.columns if columns is None else columns))
        return own.groupBy(self.block).cogroup(others.groupBy("_block")).applyInArrow(apply, schema)

    def keep(self, rows: DataFrame) -> DataFrame:
        """The documents whose numbers are in ``rows`` (columns _block and _row)."""
        names, row = self.columns, self.row

        def chosen(own: pa.Table, others: pa.Table) -> pa.Table:
            return own.filter(pc.is_in(own.column(row), others.column("_row").combine_chunks())).select(names)

        return self.with_rows(rows.select("_block", "_row"), chosen, self.schema)


def in_blocks(documents: DataFrame, rows: int = BLOCK_ROWS) -> Blocked:
    """``documents`` stored with their block and row numbers, bucketed by block.

    The numbers are part of the stored table, so a task that is repeated sees the same blocks.
    A block does not reach from one partition into the next, so small partitions are read
    together: there are no more partitions than blocks would fill, and twice as many blocks at
    most.
    """
    spark = documents.sparkSession
    block, row = free_name(documents, "_block"), free_name(documents, "_row")
    blocks = -(-documents.count() // rows)
    buckets = max(parallelism(spark), blocks)
    table = f"tidelog_{uuid.uuid4().hex}"
    numbered = documents.coalesce(max(1, blocks)).withColumn(row, F.monotonically_increasing_id())
    (
        numbered.withColumn(block, F.floor(F.col(row) / rows).cast("long"))
        .write.format("parquet")
        .option("compression", "zstd")
        .option("path", new_folder(spark, "documents"))
        .bucketBy(buckets, block)
        .saveAsTable(table)
    )
    stored = spark.table(table)
    # The frame knows its files and buckets; the catalogue need not keep the name.
    spark.sql(f"DROP TABLE {table}")
    return Blocked(stored, block, row, documents.columns, blocks // FAMILY + 1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their askers as compressed tables, one for each asker; in portions."""
    held: list[pa.Table] = []
    askers: list[np.ndarray] = []

    def flush() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        rows, blocks = pa.concat_tables(held).combine_chunks(), np.concatenate(askers)
        held.clear()
        askers.clear()
        order = np.argsort(blocks, kind="stable")
        blocks = blocks[order]
        cuts = np.flatnonzero(np.diff(blocks)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
            if lo == hi:
                continue
            part = rows.take(pa.array(order[lo:hi]))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, part.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(part)
            columns = [pa.array([int(blocks[lo])]), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["_block", "packed"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table.sort_by("key") if "key" in table.column_names else table
        upto = np.cumsum(pc.list_value_length(table.column("askers")).to_numpy())
        at = 0
        while at < len(upto):
            # A row has FAMILY askers or so at most; a batch of frequent keys has too many.
            begun = int(upto[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(upto, begun + PORTION, side="right")))
            part = table.slice(at, end - at)
            lists = part.column("askers").combine_chunks()
            held.append(part.drop_columns(["askers"]).take(pc.list_parent_indices(lists)))
            askers.append(pc.list_flatten(lists).to_numpy())
            at = end
            if sum(map(len, askers)) >= PORTION:
                yield from flush()
    yield from flush()
    release()


def _unpacked(packed: pa.ChunkedArray) -> pa.Table | None:
    """The rows of compressed tables; None if there are none."""
    tables = [pa.ipc.open_stream(p.as_buffer()).read_all() for p in packed]
    return pa.concat_tables(tables) if tables else None


def answered(
    blocked: Blocked,
    *,
    ask: Callable[[list[str | None]], set | np.ndarray],
    key_type: T.DataType,
    resolve: Callable[[DataFrame], DataFrame],
    finish: Callable[[pa.Table, pa.Table | None], pa.Table],
    added: list[T.StructField],
    keep: list[str] | None = None,
) -> DataFrame:
    """The documents with the columns that ``finish`` adds.

    ``ask`` names the keys some texts need. ``resolve`` gets rows (key, askers) and returns
    them with further columns, without the key if these tell it. ``finish`` gets the documents of a block and its answers (what
    ``resolve`` returned; a key may come twice; None if it asked for nothing) and returns the documents with ``added``.
    ``keep`` names the columns wanted in the end (all, if None), block and row numbers among them.
    """
    arrow = pa.string() if isinstance(key_type, T.StringType) else pa.int64()

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set = set()
        parts: list[np.ndarray] = []
        current = None

        def flush() -> Iterator[pa.RecordBatch]:
            keys = np.unique(np.concatenate(parts)) if parts else sorted(known)
            for lo in range(0, len(keys), 65_536):
                part = pa.array(keys[lo : lo + 65_536], arrow)
                numbers = pa.array(np.full(len(part), current, np.int64))
                yield pa.RecordBatch.from_arrays([numbers, part], names=["block", "key"])
            known.clear()
            parts.clear()

        for batch in batches:
            numbers = batch.column(0).to_numpy()
            cuts = np.flatnonzero(np.diff(numbers)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(numbers)], strict=True):
                if lo == hi:
                    continue
                if current != numbers[lo]:
                    yield from flush()
                    current = numbers[lo]
                for at in range(lo, hi, 128):
                    found = ask(batch.column(1)[at : min(at + 128, hi)].to_pylist())
                    if isinstance(found, set):
                        known |= found
                    else:
                        parts.append(found)
                        if len(parts) > 32:
                            parts[:] = [np.unique(np.concatenate(parts))]
                if len(known) > 1_000_000:
                    yield from flush()
        yield from flush()
        release()

    requests = blocked.table.select(blocked.block, "text").mapInArrow(
        asked, T.StructType([T.StructField("block", T.LongType()), T.StructField("key", key_type)])
    )
    family = F.pmod(F.xxhash64("block"), F.lit(blocked.families)).alias("family")
    grouped = requests.groupBy("key", family).agg(F.collect_list("block").alias("askers")).drop("family")
    told = resolve(grouped).mapInArrow(_packed, "_block long, packed binary")

    names = blocked.columns if keep is None else keep
    everything = {f.name: f for f in blocked.table.schema.fields}
    schema = T.StructType([*[everything[n] for n in names], *added])

    def finished(own: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        return finish(own, _unpacked(answers.column("packed"))).select(schema.names)

    return blocked.with_rows(told, finished, schema, list(dict.fromkeys(["text", *[n for n in names if n not in (blocked.block, blocked.row)]])))
