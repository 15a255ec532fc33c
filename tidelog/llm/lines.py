"""Line deduplication with a suffix array over line ids.

Each document is a sequence of line ids. The suffixes of all sequences are sorted by prefix
doubling: the ranks by the first n lines, taken at a place and n lines on, give the ranks by 2n
lines. Suffixes alone in their rank repeat nothing and leave the race; sorting ends when the
ranks cover ``min_lines`` lines. Then suffixes of one rank are the intervals of the array whose
longest common prefix is that long, and together they cover the maximal repeated runs. The
first copy of each stays, later ones are deleted.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.llm.blocks import BLOCK_ROWS, Blocked, in_blocks
from tidelog.llm.common import Stored, shuffled
from tidelog.plans.prefix import Scan, prefix

_WHITE = " \t\x0b\x0c\r"
BLANK = r"^[ \t\x0B\f\r]*$"


def _id(line: Column) -> Column:
    """128 bits of hash stand for a line."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def _sequences(blocked: Blocked) -> DataFrame:
    """Rows (_block, _row, doc, pos, id): the lines that are not blank, in order."""
    ids = F.transform(
        F.filter(F.split("text", "\n"), lambda line: ~line.rlike(BLANK)), _id
    )
    return blocked.table.select(
        F.col(blocked.block).alias("_block"),
        F.col(blocked.row).alias("_row"),
        F.col("doc_id").alias("doc"),
        F.posexplode(ids).alias("pos", "id"),
    )


def _ranked(suffixes: DataFrame, keys: list[str]) -> DataFrame:
    """Replaces ``keys`` by ``rank``: how many suffixes are sorted before, plus one.

    Suffixes alone with their key are left out.
    """
    groups = suffixes.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    placed = prefix(groups, [], keys, {"upto": Scan("sum", F.col("n"))})
    ranks = placed.select(*keys, (F.col("upto") - F.col("n") + 1).alias("_rank"))
    return suffixes.join(shuffled(ranks), keys).drop(*keys).withColumnRenamed("_rank", "rank")


def intervals(blocked: Blocked, min_lines: int) -> DataFrame:
    """Rows (_block, _row, doc, pos, rank) of all suffixes whose first ``min_lines`` lines occur
    more than once; equal ranks share them, and ranks are places in the suffix array."""
    suffixes = Stored(_ranked(_sequences(blocked), ["id"]), "suffixes")
    covered = 1
    while covered < min_lines:
        step = min(covered, min_lines - covered)
        second = suffixes.df.select("_row", (F.col("pos") - step).alias("pos"), F.col("rank").alias("rank2"))
        following = Stored(_ranked(suffixes.df.join(shuffled(second), ["_row", "pos"]), ["rank", "rank2"]), "suffixes")
        suffixes.delete()
        suffixes, covered = following, covered + step
    return suffixes.df


def dedup_lines(documents: DataFrame, *, min_lines: int = 2, rows: int = BLOCK_ROWS) -> DataFrame:
    """Documents without later copies of repeated line runs; adds ``removed`` (array of int).

    A run is ``min_lines`` or more consecutive lines that are not blank (blank lines in between
    are passed over, and stay). Its first copy, by doc_id (null last), stored order and line,
    stays, in whichever document; all lines of later copies are deleted, overlapping copies
    included. ``removed`` numbers the deleted lines, blank lines not counted, from 0. Lines end
    at a line feed only.

    A text that loses all its lines becomes empty; a null text stays null. Repeated rows are
    copies of each other. Other columns pass through, one named ``removed`` is replaced; an
    empty table stays empty. Texts of any length are split whole.
    """
    kept = documents.select(*[c for c in documents.columns if c.lower() != "removed"])
    blocked = in_blocks(kept, rows)
    found = intervals(blocked, min_lines)
    place = F.struct(F.col("doc").isNull(), "doc", "_row", "pos")
    first = found.groupBy("rank").agg(F.min(place).alias("first"))
    later = found.join(shuffled(first), "rank").where(place != F.col("first"))
    span = F.explode(F.sequence("pos", F.col("pos") + min_lines - 1)).alias("pos")
    deleted = later.select("_block", "_row", span).distinct()

    row_name, names = blocked.row, [*kept.columns, "removed"]

    def delete(own: pa.Table, others: pa.Table) -> pa.Table:
        gone: dict[int, set[int]] = {}
        for row, pos in zip(others.column("_row").to_pylist(), others.column("pos").to_pylist(), strict=True):
            gone.setdefault(row, set()).add(pos)
        texts, removed = [], []
        for row, text in zip(own.column(row_name).to_pylist(), own.column("text").to_pylist(), strict=True):
            out = gone.get(row)
            removed.append(sorted(out or ()))
            if out and text is not None:
                stay, pos = [], 0
                for line in text.split("\n"):
                    blank = not line.strip(_WHITE)
                    if blank or pos not in out:
                        stay.append(line)
                    pos += not blank
                text = "\n".join(stay)
            texts.append(text)
        at = own.schema.get_field_index("text")
        changed = own.set_column(at, "text", pa.array(texts, pa.string()))
        changed = changed.append_column("removed", pa.array(removed, pa.list_(pa.int32())))
        return changed.select(names)

    schema = T.StructType([*blocked.schema.fields, T.StructField("removed", T.ArrayType(T.IntegerType()))])
    return blocked.with_rows(deleted, delete, schema)
