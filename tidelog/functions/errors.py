"""Error rows: failures that belong to the data travel as rows, not as exceptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed error kinds.
CONFIG = "Config"
STREAM = "Stream"
READ = "Read"
AGGREGATED = "AggregatedRecord"
PUBLISH = "Publish"
LEASE = "Lease"
NOT_CONNECTED = "NotConnected"
INVALID = "Invalid"

# Kinds that concern a whole subscription rather than one row.
_SUBSCRIPTION_WIDE = [CONFIG, STREAM, NOT_CONNECTED]


class LogError(ValueError):
    """A descriptor or option that is rejected before any input is touched."""


def detail(kind: Column) -> Column:
    """One line of text for an error row over the columns ``stream`` and ``shard_id``."""
    where = F.concat(F.lit("'"), F.col("stream"), F.lit("' shard '"), F.col("shard_id"), F.lit("'"))
    return (
        F.when(kind == AGGREGATED, F.concat(F.lit("aggregated record refused on "), where))
        .when(kind == READ, F.concat(F.lit("read failed on "), where))
        .when(kind == LEASE, F.concat(F.lit("lease command refused on "), where))
        .when(kind == INVALID, F.concat(F.lit("undecodable payload on "), where))
        .when(kind.isNotNull(), F.concat(kind, F.lit(" error on "), where))
    )


def scope(kind: Column) -> Column:
    """``record`` errors concern one row; ``subscription`` errors stop the reader."""
    return F.when(kind.isin(_SUBSCRIPTION_WIDE), "subscription").when(kind.isNotNull(), "record")
