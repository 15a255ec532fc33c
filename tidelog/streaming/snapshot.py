"""A keyed table kept up to date by ``foreachBatch``, safe to retry and to start over.

Every micro-batch adds one version: the rows it changed, marked with the run of the query and
the batch. A version is there once its success marker is. A batch that is repeated finds its own
mark on the last version and replaces that one; a query that was given a new state location has
another run id, so its batch 0 follows what earlier runs wrote. Every ``FOLD`` versions the whole
table is written, so that a reader opens a bounded number of versions; older ones are deleted.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

FOLD = 16
_NAME = re.compile(r"version-(\d+)-(full|part)-(.+)-(\d+)$")


def run_of(spark: SparkSession) -> str:
    """Id of the streaming query that calls: it outlives restarts, not a new state location."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"


class Snapshot:
    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str]) -> None:
        self.spark = spark
        self.path = path
        self.schema = schema
        self.keys = list(keys)

    def _folder(self):
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.path)
        return path, path.getFileSystem(context._jsc.hadoopConfiguration())

    def _versions(self) -> list[tuple[int, str, str, int]]:
        """(number, full or part, run, batch) of the versions that are complete, in order."""
        root, files = self._folder()
        if not files.exists(root):
            return []
        marker = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        found = []
        for status in files.listStatus(root):
            name = _NAME.match(status.getPath().getName())
            if name and files.exists(marker(status.getPath(), "_SUCCESS")):
                found.append((int(name[1]), name[2], name[3], int(name[4])))
        return sorted(found)

    def _location(self, number: int, kind: str, run: str, batch_id: int) -> str:
        return f"{self.path}/version-{number:012d}-{kind}-{run}-{batch_id}"

    def _rows(self, versions: list[tuple[int, str, str, int]]) -> DataFrame:
        """The table as the last of ``versions`` left it: per key, the newest row."""
        start = max((i for i, v in enumerate(versions) if v[1] == "full"), default=0)
        parts = [
            self.spark.read.schema(self.schema).parquet(self._location(*v)).withColumn("_version", F.lit(v[0]))
            for v in versions[start:]
        ]
        if not parts:
            return self.spark.createDataFrame([], self.schema)
        rows = reduce(DataFrame.unionByName, parts)
        if len(parts) > 1:
            values = F.struct(*self.schema.fieldNames())
            newest = rows.groupBy(*self.keys).agg(F.max_by(values, "_version").alias("_row"))
            rows = newest.select("_row.*")
        return rows.select(*self.schema.fieldNames())

    def _before(self, run: str, batch_id: int) -> list[tuple[int, str, str, int]]:
        versions = self._versions()
        return versions[:-1] if versions and versions[-1][2:] == (run, batch_id) else versions

    def before(self, run: str, batch_id: int) -> DataFrame:
        """The table that a batch starts from."""
        return self._rows(self._before(run, batch_id))

    def apply(self, changes: DataFrame, run: str, batch_id: int) -> None:
        """Makes ``changes``, one row per key, the batch's version of those keys."""
        versions = self._before(run, batch_id)
        number = versions[-1][0] + 1 if versions else 0
        full = number % FOLD == 0
        if full:
            kept = self._rows(versions).join(changes.select(*self.keys), self.keys, "left_anti")
            changes = kept.unionByName(changes.select(*self.schema.fieldNames()))
        place = self._location(number, "full" if full else "part", run, batch_id)
        changes.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(place)
        self._drop_before(number)

    def _drop_before(self, number: int) -> None:
        """Deletes versions that no table from the one before ``number`` on is made of."""
        versions = [v for v in self._versions() if v[0] < number]
        start = max((i for i, v in enumerate(versions) if v[1] == "full"), default=0)
        _, files = self._folder()
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for old in versions[:start]:
            files.delete(path(self._location(*old)), True)

    def last_batch(self) -> int | None:
        """The batch that wrote last; None before the first."""
        versions = self._versions()
        return versions[-1][3] if versions else None

    def current(self) -> DataFrame:
        """The table after the last batch."""
        return self._rows(self._versions())
