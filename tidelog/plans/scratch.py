"""Tables written once to shared storage, so a plan can be cut there and its size is known.

Reading a written table back gives Catalyst its exact size: a per-shard table that fits
``spark.sql.autoBroadcastJoinThreshold`` is then broadcast without shuffling the records it
is joined to, and a larger one falls back to a shuffled join on its own. It also survives the
loss of executors, which a cached table would have to recompute.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}
_FOLDERS: dict[str, list[str]] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local master may do without the setting; a machine-local folder would lose data
    on a cluster.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _ROOTS:
        _ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="tidelog-")
    return _ROOTS[context.applicationId]


def new_folder(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing else uses."""
    path = f"{shared_folder(spark)}/tidelog-{label}-{uuid.uuid4().hex}"
    _FOLDERS.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Writes ``df`` to the shared folder and returns the table read back.

    With ``by``, rows that differ in that column lie apart, and a filter on it reads its own.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    writer = df.write if by is None else df.write.partitionBy(by)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession) -> int:
    """Deletes the folders this application made, once their results are no longer needed.

    Tables returned by operators may still read from them. Returns how many were there.
    """
    context = spark.sparkContext
    dropped = 0
    for path in _FOLDERS.pop(context.applicationId, []):
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        dropped += folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
    return dropped
