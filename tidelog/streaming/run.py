"""Running streaming queries to the end of what is available."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery


def finish(query: StreamingQuery, timeout: int | None = None) -> None:
    """Waits for a query that stops by itself, for ``timeout`` seconds at most if given."""
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"streaming query still running after {timeout} s")
    if query.exception() is not None:
        raise query.exception()


def run_once(writer: DataStreamWriter, checkpoint: str, timeout: int | None = None) -> None:
    """Runs over everything available now and stops."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finish(query, timeout)


def to_parquet(stream: DataFrame, path: str) -> DataStreamWriter:
    """Append to a parquet folder, exactly once."""
    return stream.writeStream.format("parquet").option("path", path).outputMode("append")
