"""State of many keys at once: a call of a state goes to the JVM and back, and costs more than what
it brings, so keys share slots by hash and a slot keeps them in pages. Rows go to a slot, and come
from it, packed as Arrow tables."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLOTS = 4_096
PAGE = 2_048  # entries of a page, about
HELD = 64  # pages of a dict kept in memory
PORTION = 65_536  # rows packed together

PACKED = T.StructType([T.StructField("packed", T.BinaryType())])
_SIZE = T.StructType([T.StructField("pages", T.IntegerType()), T.StructField("count", T.LongType())])
_PLACE = T.StructType([T.StructField("name", T.StringType()), T.StructField("page", T.IntegerType())])


class Pages:
    """A dict in the map state of a slot. A page is read when one of its keys is asked for, and
    what a key costs does not grow with the dict: as it fills, one page is split after the other."""

    def __init__(self, state, name: str, pages: int = 0, count: int = 0) -> None:
        self._state, self._name = state, name
        self.pages, self.count, self._stored = max(pages, 1), count, pages
        self._held: dict[int, dict] = {}
        self._changed: set[int] = set()

    @property
    def size(self) -> tuple[int, int]:
        return self._stored, self.count

    def _place(self, key) -> int:
        if self.pages == 1:
            return 0
        level = 1 << (self.pages.bit_length() - 1)
        at = crc32(repr(key).encode("utf-8", "surrogatepass")) % (2 * level)
        return at if at < self.pages else at - level

    def _read(self, number: int) -> dict:
        return pickle.loads(self._state.getValue((self._name, number))[0]) if number < self._stored else {}

    def _page(self, number: int) -> dict:
        page = self._held.get(number)
        if page is None:
            if len(self._held) >= HELD:
                self.flush()
                self._held.clear()
            page = self._held[number] = self._read(number)
        return page

    def get(self, key):
        return self._page(self._place(key)).get(key)

    def put(self, key, value) -> None:
        number = self._place(key)
        page = self._page(number)
        self.count += key not in page
        page[key] = value
        self._changed.add(number)
        if self.count > PAGE * self.pages:
            self._split()

    def _split(self) -> None:
        new = self.pages
        old = new - (1 << (new.bit_length() - 1))
        page = self._page(old)
        self.pages += 1
        moved = {key: value for key, value in page.items() if self._place(key) == new}
        for key in moved:
            del page[key]
        self._held[new] = moved
        self._changed |= {old, new}

    def flush(self) -> None:
        for number in sorted(self._changed):
            self._state.updateValue((self._name, number), (pickle.dumps(self._held[number], 5),))
        if self._changed:
            self._stored = self.pages
        self._changed.clear()

    def items(self) -> Iterator[tuple]:
        for number in range(self.pages):
            held = self._held.get(number)
            yield from (self._read(number) if held is None else held).items()

    def clear(self) -> None:
        for number in range(self._stored):
            self._state.removeKey((self._name, number))
        self.__init__(self._state, self._name)


class Slot:
    """The states of a slot: one dict of entries, and further ones that have names."""

    def __init__(self, handle) -> None:
        self._size = handle.getValueState("size", _SIZE)
        self.pages = handle.getMapState("pages", _PLACE, PACKED)

    def entries(self) -> Pages:
        self._known = self._size.get() or (0, 0)
        return Pages(self.pages, "", *self._known)

    def keep(self, entries: Pages) -> None:
        entries.flush()
        if entries.size != tuple(self._known):
            self._size.update(entries.size)


class Packer:
    """Rows as packed tables, some at a time."""

    def __init__(self, schema: pa.Schema) -> None:
        self._schema, self._rows = schema, []

    def add(self, row: tuple) -> Iterator[Row]:
        self._rows.append(row)
        if len(self._rows) >= PORTION:
            yield from self.rest()

    def rest(self) -> Iterator[Row]:
        if self._rows:
            columns = [pa.array(c, f.type) for c, f in zip(zip(*self._rows, strict=True), self._schema, strict=True)]
            yield Row(packed=pack(pa.RecordBatch.from_arrays(columns, schema=self._schema)))
            self._rows = []


def pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def rows(packed: bytes) -> Iterator[tuple]:
    for batch in pa.ipc.open_stream(packed):
        yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)


def _pack_slot(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        packed = pack(batch.drop_columns(["_slot"]))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([packed], pa.binary())], names=["slot", "packed"])


def in_slots(happened: DataFrame, *keys: str) -> DataFrame:
    """The rows packed by slot: (slot, packed)."""
    slot: Column = F.pmod(F.xxhash64(*keys), F.lit(SLOTS)).cast("int")
    return happened.withColumn("_slot", slot).groupBy("_slot").applyInArrow(_pack_slot, "slot int, packed binary")


def unpacked(packed: DataFrame, schema: T.StructType) -> DataFrame:
    """The rows of packed tables."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for one in batch.column(0):
                yield from pa.ipc.open_stream(one.as_py())

    return packed.mapInArrow(unpack, schema)
