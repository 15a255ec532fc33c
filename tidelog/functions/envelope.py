"""The binary header envelope, as column expressions.

Layout of an enveloped record: magic, header block length as big-endian u32, header block of
``name: value`` lines, payload. A record without user headers is its bare payload.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidelog.schema import (
    AGGREGATED_MAGIC,
    ENVELOPE_MAGIC,
    PARTITION_KEY_HEADER,
    SEQUENCE_HEADER,
    SHARD_HEADER,
    SPREAD_KEY_PREFIX,
)

RESERVED = [PARTITION_KEY_HEADER, SEQUENCE_HEADER, SHARD_HEADER]

# Unicode White_Space, the set that header names and values are trimmed of.
_SPACE_POINTS = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
_SPACE_POINTS += [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
WHITE_SPACE = "".join(chr(p) for p in _SPACE_POINTS)

_NO_ENTRIES = "cast(array() as array<struct<key: string, value: string>>)"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates ``value`` once for use in ``body``, also inside its lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def lossy_text(data: Column) -> Column:
    """Bytes as text; ill-formed UTF-8 becomes U+FFFD."""
    return F.make_valid_utf8(data.cast("string"))


def pack(headers: Column, payload: Column) -> Column:
    """Record bytes for a message. The partition key travels outside the envelope."""
    body = F.coalesce(payload, F.lit(b""))
    lines = F.transform(
        F.filter(F.map_entries(headers), lambda e: e["key"] != PARTITION_KEY_HEADER),
        lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit("")), F.lit("\n")),
    )
    block = F.encode(F.array_join(lines, ""), "UTF-8")
    enveloped = _let(
        block,
        lambda b: F.when(F.length(b) == 0, body).otherwise(
            F.concat(F.lit(ENVELOPE_MAGIC), F.unhex(F.lpad(F.hex(F.length(b)), 8, "0")), b, body)
        ),
    )
    return F.when(headers.isNull(), body).otherwise(enveloped)


def block_length(data: Column) -> Column:
    """Byte length of the header block; null when the record is not enveloped."""
    stated = F.conv(F.hex(F.substring(data, 5, 4)), 16, 10).cast("long")
    well_formed = (
        (F.length(data) >= 8)
        & (F.substring(data, 1, 4) == F.lit(ENVELOPE_MAGIC))
        & (F.length(data) >= 8 + stated)
    )
    return F.when(well_formed, stated.cast("int"))


def _trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITE_SPACE))


def parse_entries(text: Column) -> Column:
    """Header lines to (key, value) entries: split at the first colon, trim, last name wins."""
    lines = F.filter(F.split(text, "\n"), lambda line: F.contains(line, F.lit(":")))
    entries = F.transform(
        lines,
        lambda line, i: F.struct(
            _trimmed(F.substring_index(line, ":", 1)).alias("key"),
            i.alias("at"),
            _trimmed(F.substr(line, F.instr(line, ":") + 1)).alias("value"),
        ),
    )
    # Sorted by name then line, an entry is the last of its name when the next differs.
    kept = _let(
        F.array_sort(entries),
        lambda sorted_: F.filter(
            sorted_,
            lambda e, i: ~F.get(sorted_, i + 1)["key"].eqNullSafe(e["key"]),
        ),
    )
    return F.transform(kept, lambda e: F.struct(e["key"].alias("key"), e["value"].alias("value")))


def unpack_entries(data: Column, length: Column) -> Column:
    """Header entries of a record whose :func:`block_length` is ``length``; none when null."""
    text = lossy_text(F.substr(data, F.lit(9), length))
    return F.when(length.isNull(), F.expr(_NO_ENTRIES)).otherwise(parse_entries(text))


def unpack_headers(data: Column, length: Column) -> Column:
    """Headers of a record as a map."""
    return F.map_from_entries(unpack_entries(data, length))


def unpack_payload(data: Column, length: Column) -> Column:
    """Payload of a record whose :func:`block_length` is ``length``; all of it when null."""
    return F.when(length.isNull(), data).otherwise(F.substr(data, 9 + length))


def is_aggregated(data: Column) -> Column:
    """True for producer-aggregated records, which are refused rather than delivered."""
    return (F.length(data) > 4) & (F.substring(data, 1, 4) == F.lit(AGGREGATED_MAGIC))


def delivered_headers(
    entries: Column, partition_key: Column, sequence: Column, shard: Column
) -> Column:
    """Message headers from a record's entries, reserved names set from the record itself."""

    def entry(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("key"), value.alias("value"))

    reserved = F.array(
        entry(PARTITION_KEY_HEADER, partition_key),
        entry(SEQUENCE_HEADER, sequence),
        entry(SHARD_HEADER, shard),
    )
    own = F.filter(entries, lambda e: ~e["key"].isin(RESERVED))
    return F.map_from_entries(F.concat(own, reserved))


def partition_key_of(headers: Column) -> Column:
    """The partition key a delivered message carries."""
    return F.element_at(headers, PARTITION_KEY_HEADER)


def routing_key(headers: Column, writer: Column, row_id: Column) -> Column:
    """The key a message is routed by: its own, else one that spreads over the shards."""
    spread = F.concat_ws("-", F.lit(SPREAD_KEY_PREFIX), writer, row_id)
    return F.coalesce(partition_key_of(headers), spread)


def headers_text(headers: Column) -> Column:
    """Headers as sorted ``name=value`` text, for display and comparison."""
    return F.array_join(
        F.array_sort(
            F.transform(F.map_entries(headers), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
        ),
        ";",
    )
