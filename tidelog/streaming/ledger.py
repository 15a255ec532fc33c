"""Audit of a lease ledger as it grows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from tidelog.operators.leases import lease_snapshot, replay_ledger
from tidelog.schema import LEASE_STATE, SHARD_KEYS
from tidelog.streaming.snapshot import Snapshot, run_of


def audit_leases(
    commands: DataFrame, verdicts_path: str, state_path: str, **how
) -> DataStreamWriter:
    """Writes the verdict of every command, carrying each shard's lease between micro-batches.

    A micro-batch is replayed like a table, so a shard with most of the commands is still cut
    into blocks. Verdicts land in one folder per run of the query and batch; a repeated batch
    replaces its own.
    """

    def audit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_of(spark)
        state = Snapshot(spark, state_path, LEASE_STATE, SHARD_KEYS)
        before = state.before(run, batch_id)
        folder = f"{verdicts_path}/run={run}/batch={batch_id}"
        replay_ledger(batch, before, **how).write.mode("overwrite").parquet(folder)
        state.apply(lease_snapshot(spark.read.parquet(folder)), run, batch_id)

    return commands.writeStream.foreachBatch(audit)
