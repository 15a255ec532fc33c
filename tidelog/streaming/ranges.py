"""Sets of settled positions as disjoint ranges.

A range is (low, high, sequence), with the sequence number of its last position. Neighbours
merge, and what the checkpoint has passed is dropped, so a set is as large as the gaps between
settled records are many, however many records were settled.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
from pyspark.sql import types as T

Range = tuple[int, int, str]

RANGES = T.ArrayType(
    T.StructType(
        [
            T.StructField("low", T.LongType()),
            T.StructField("high", T.LongType()),
            T.StructField("sequence", T.StringType()),
        ]
    )
)


def of_rows(rows: Iterable) -> list[Range]:
    """Ranges as state and input rows hold them: dictionaries, or rows in field order."""
    return [tuple(r.values()) if isinstance(r, dict) else tuple(r) for r in rows]


def of_positions(positions: list[int], sequences: list[str]) -> list[Range]:
    """The ranges that single positions make, in any order and with repeats."""
    if not positions:
        return []
    at, first = np.unique(np.array(positions, np.int64), return_index=True)
    last = np.append(np.flatnonzero(np.diff(at) > 1), len(at) - 1)
    low = at[np.append(0, last[:-1] + 1)]
    return [(int(lo), int(at[i]), sequences[first[i]]) for lo, i in zip(low, last, strict=True)]


def merged(ranges: Iterable[Range]) -> list[Range]:
    """Disjoint ranges in order that cover the same positions."""
    out: list[Range] = []
    for low, high, sequence in sorted(ranges, key=lambda r: (r[0], r[1])):
        if out and low <= out[-1][1] + 1:
            if high > out[-1][1]:
                out[-1] = (out[-1][0], high, sequence)
        else:
            out.append((low, high, sequence))
    return out


def advance(start: int, ranges: Iterable[Range]) -> tuple[int, str | None, list[Range]]:
    """Where the run of settled positions from ``start`` ends, the sequence number of its last
    position (None if it has not moved), and the ranges that lie beyond."""
    ahead = merged(r for r in ranges if r[1] >= start)
    if not ahead or ahead[0][0] > start:
        return start, None, ahead
    _, high, sequence = ahead[0]
    return high + 1, sequence, ahead[1:]


def clipped(ranges: Iterable[Range], start: int) -> tuple[list[Range], int]:
    """What of ``ranges`` lies from ``start`` on, and how many positions lie before it."""
    kept, cut = [], 0
    for low, high, sequence in ranges:
        cut += max(0, min(high + 1, start) - low)
        if high >= start:
            kept.append((max(low, start), high, sequence))
    return kept, cut
