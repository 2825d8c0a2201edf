"""Texts kept as numbered words, and counts of their hashes over the whole table, dealt out as blocks of numbers.

A slice is a run of texts that one row holds. Its distinct hashes go to buckets of the range of hashes, sorted and as
differences; each bucket adds up all slices and sends every slice the counts of its own hashes, in their order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructField, StructType

from tideline.llm.arrow import release, slices, values
from tideline.llm.words import coded
from tideline.session import settle

#: Texts and bytes of text in a slice, unless one text is longer.
ROWS, BYTES = 1 << 14, 16 << 20
#: Bytes of text whose rows of numbers are made at a time, unless one text is longer: they stay near the processor.
PIECE = 1 << 18
#: Hashes that a bucket may get at most; counted once for each slice that holds them.
BUCKET = 1 << 21


def pack(numbers: np.ndarray) -> bytes:
    """Numbers byte by byte (all lowest bytes first, and so on), compressed."""
    planes = np.ascontiguousarray(numbers).view(np.uint8).reshape(len(numbers), -1).T if len(numbers) else numbers
    return len(numbers).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(planes).tobytes(), codec="zstd", asbytes=True)


def unpack(data: bytes, kind: type) -> np.ndarray:
    n, width = int.from_bytes(data[:8], "little"), np.dtype(kind).itemsize
    raw = pa.decompress(data[8:], n * width, codec="zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).reshape(-1).view(kind)


class Words:
    """Words of the texts of a slice: ``of`` hashes of the distinct ones, ``index`` all in a row, ``edge`` where each text's begin."""

    def __init__(self, row: dict):
        self.row, self.slice = row, row["slice"]
        self.of, self.index = unpack(row["of"], np.uint64), unpack(row["index"], np.uint32).astype(np.int64)
        self.size = unpack(row["sizes"], np.int64)
        self.edge = np.concatenate(([0], np.cumsum(self.size)))
        self.doc = np.repeat(np.arange(len(self.size)), self.size)


def _loaded(table: pa.Table | pa.RecordBatch, carry: list[str]) -> Iterator[Words]:
    for i in range(table.num_rows):
        row = {name: table.column(name)[i].as_py() for name in ("slice", "of", "index", "sizes")}
        yield Words(row | {name: table.column(name)[i].values for name in carry})


def keep_words(source: DataFrame, table: bytes | None, purpose: str) -> DataFrame:
    """One row for each slice of ``source``, written once: its number, ``n`` words, and an array of each column but text."""
    carry = [f for f in source.schema.fields if f.name != "text"]
    out = StructType().add("slice", "long").add("n", "long").add("of", "binary").add("index", "binary").add("sizes", "binary")
    for f in carry:
        out.add(f.name, ArrayType(f.dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", ROWS, BYTES):
                of, index, edge = coded(values(part.column("text")), table)
                # Frequent words get small numbers, which compress best; words of no text go.
                times = np.bincount(index, minlength=len(of))
                by = np.argsort(-times, kind="stable")[: np.count_nonzero(times)]
                nth = np.zeros(len(of), np.uint32)
                nth[by] = np.arange(len(by))
                packed = [pa.array([pack(x)], pa.binary()) for x in (of[by], nth[index], np.diff(edge))]
                arrays = [pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(f.name)) for f in carry]
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([len(index)]), *packed, *arrays], names=out.names)
                number += 1
        release()

    return settle(source.mapInArrow(run, out), purpose)


def each(kept: DataFrame, work: Callable[[Words], list], schema: str) -> DataFrame:
    """Columns of ``work(words)`` for each slice of ``kept``."""
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in _loaded(batch, []):
                yield pa.RecordBatch.from_arrays(work(words), names=names)
        release()

    return kept.select("slice", "of", "index", "sizes").mapInArrow(run, schema)


def beside(kept: DataFrame, other: DataFrame, work: Callable[[Words, pa.Table], list], schema: StructType) -> DataFrame:
    """Columns of ``work(words, rows)`` for each slice of ``kept`` and the rows of ``other`` with its number."""
    carry = kept.columns[5:]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        made = [pa.Table.from_arrays(work(words, right), names=schema.names) for words in _loaded(left, carry)]
        release()
        return pa.concat_tables(made) if made else pa.table([pa.array([], f.type) for f in _arrow(schema)], names=schema.names)

    return kept.groupBy("slice").cogroup(other.groupBy("slice")).applyInArrow(run, schema)


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


#: What ``dealt`` makes.
DEALT = "slice long, bucket int, h binary, n binary"


def spread(total: int) -> int:
    """Bits of the number of a bucket, for about ``total`` hashes of all slices."""
    return max(6, int(np.ceil(np.log2(max(total, 1) / BUCKET))))


def dealt(number: int, h: np.ndarray, n: np.ndarray, bits: int) -> list:
    """Columns of a slice's distinct sorted hashes ``h`` and their counts, a row for each bucket."""
    cut = np.searchsorted(h, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
    cut = np.concatenate(([0], cut, [len(h)]))
    full = np.flatnonzero(np.diff(cut))
    ranges = list(zip(cut[full], cut[full + 1]))
    apart = [pack(np.diff(h[a:b], prepend=np.uint64(0))) for a, b in ranges]
    blobs = [pa.array(x, pa.binary()) for x in (apart, [pack(n[a:b]) for a, b in ranges])]
    return [pa.array(np.full(len(full), number, np.int64)), pa.array(full.astype(np.int32)), *blobs]


def summed(rows: DataFrame) -> DataFrame:
    """Rows (slice, bucket, c): counts over all slices of the hashes that ``dealt`` dealt out, in their order."""

    def add_up(rows: pa.Table) -> pa.Table:
        parts = [np.cumsum(unpack(x, np.uint64), dtype=np.uint64) for x in values(rows.column("h"))]
        n = np.concatenate([unpack(x, np.int64) for x in values(rows.column("n"))])
        h = np.concatenate(parts)
        order = np.argsort(h, kind="stable")
        h = h[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        counts = np.empty(len(h), np.int64)
        counts[order] = np.repeat(np.add.reduceat(n[order], first), np.diff(first, append=len(h)))
        ends = np.cumsum([len(x) for x in parts])
        packed = [pack(x) for x in np.split(counts, ends[:-1])]
        del parts, n, h, order, first, counts
        release()
        return pa.Table.from_arrays([rows.column("slice"), rows.column("bucket"), pa.array(packed, pa.binary())], names=["slice", "bucket", "c"])

    return rows.groupBy("bucket").applyInArrow(add_up, "slice long, bucket int, c binary")


def own(rows: pa.Table) -> np.ndarray:
    """The counts that a slice got back, in the order of its distinct sorted hashes."""
    order, blobs = np.argsort(rows.column("bucket").to_numpy()), values(rows.column("c"))
    return np.concatenate([np.zeros(0, np.int64), *(unpack(blobs[i], np.int64) for i in order)])


def with_counts(kept: DataFrame, keys: Callable[[Words], np.ndarray], total: int, work: Callable[[Words, np.ndarray], list], schema: StructType) -> DataFrame:
    """Columns of ``work(words, counts)`` for each slice: how often each of ``keys(words)``, hashes, is met in all slices.

    ``total`` is about the number of keys of all slices; it sets the number of buckets.
    """
    bits = spread(total)

    def deal(words: Words) -> list:
        return dealt(words.slice, *np.unique(keys(words), return_counts=True), bits)

    def look_up(words: Words, rows: pa.Table) -> list:
        got = own(rows)
        h = keys(words)
        order = np.argsort(h)
        h = h[order]
        first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else order
        times = np.diff(first, append=len(h))
        del h
        counts = np.empty(len(order), np.int64)
        counts[order] = np.repeat(got, times)
        del order, got, first, times
        return work(words, counts)

    return beside(kept, summed(each(kept, deal, DEALT)), look_up, schema)


def keep_rows(source: DataFrame, carry: list[str], make: Callable[[pa.RecordBatch], tuple[np.ndarray, list]], kinds: dict[str, type], purpose: str) -> DataFrame:
    """One row for each slice of ``source``, written once: its number, ``n`` rows made, and an array of each column of ``carry``.

    ``make(part)`` gives the places in ``part`` that its rows come from and a column of numbers for each of ``kinds``;
    the rows' places and numbers are kept packed.
    """
    out = StructType().add("slice", "long").add("n", "long").add("place", "binary")
    for name in kinds:
        out.add(name, "binary")
    for name in carry:
        out.add(name, ArrayType(source.schema[name].dataType))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in slices(batch, "text", ROWS, BYTES):
                at, parts = 0, []
                for piece in slices(part, "text", ROWS, PIECE):
                    place, numbers = make(piece)
                    parts.append([place + at, *numbers])
                    at += len(piece)
                columns = [np.concatenate(x).astype(kind) for x, kind in zip(zip(*parts), (np.int32, *kinds.values()))]
                packed = [pa.array([pack(x)], pa.binary()) for x in columns]
                arrays = [pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part.column(name)) for name in carry]
                yield pa.RecordBatch.from_arrays([pa.array([number]), pa.array([len(columns[0])]), *packed, *arrays], names=out.names)
                number += 1
        release()

    return settle(source.mapInArrow(run, out), purpose)


def repeats(kept: DataFrame, key: str, kinds: dict[str, type]) -> DataFrame:
    """Rows of ``keep_rows``, with the columns carried, whose ``key`` is met more than once in all slices."""
    bits = spread(kept.agg(F.sum("n")).first()[0] or 0)
    carry = [f for f in kept.schema.fields if f.name not in ("slice", "n", "place", *kinds)]
    out = StructType([StructField(f.name, f.dataType.elementType) for f in carry])
    for name, kind in kinds.items():
        out.add(name, "long" if kind is np.int64 else "integer")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, blob in zip(values(batch.column("slice")), values(batch.column(key))):
                yield pa.RecordBatch.from_arrays(dealt(number, *np.unique(unpack(blob, np.uint64), return_counts=True), bits), names=["slice", "bucket", "h", "n"])
        release()

    def look_up(left: pa.Table, right: pa.Table) -> pa.Table:
        tables = [_arrow(out).empty_table()]
        for row in left.to_batches():
            h, back = np.unique(unpack(row.column(key)[0].as_py(), np.uint64), return_inverse=True)
            twice = np.flatnonzero((own(right) > 1)[back])
            place = pa.array(unpack(row.column("place")[0].as_py(), np.int32)[twice])
            columns = [row.column(f.name)[0].values.take(place) for f in carry]
            columns += [pa.array(unpack(row.column(name)[0].as_py(), kind)[twice]) for name, kind in kinds.items()]
            tables.append(pa.Table.from_arrays(columns, names=out.names))
        release()
        return pa.concat_tables(tables)

    counted = summed(kept.select("slice", key).mapInArrow(deal, DEALT))
    return kept.groupBy("slice").cogroup(counted.groupBy("slice")).applyInArrow(look_up, out)


def count_words(kept: DataFrame) -> int:
    return kept.agg(F.sum("n")).first()[0] or 0
