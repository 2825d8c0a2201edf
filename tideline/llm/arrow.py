"""Small helpers for functions that map Arrow batches."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: Rows turned into Python objects at a time.
ROWS = 512
#: Bytes of text turned into Python objects at a time, unless one text is longer.
BYTES = 4 << 20


def values(array: pa.Array) -> list:
    """Texts or bytes as Python objects, several times as fast as ``to_pylist``."""
    return array.to_numpy(zero_copy_only=False).tolist()


def slices(batch: pa.RecordBatch, column: str | int, rows: int = ROWS, size: int = BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose ``column`` holds a bounded number of bytes."""
    lengths = pc.binary_length(batch.column(column)).to_pylist()
    start = total = 0
    for i, n in enumerate(lengths):
        total += n or 0
        if i > start and (total > size or i - start >= rows):
            yield batch.slice(start, i - start)
            start, total = i, n or 0
    if start < len(lengths):
        yield batch.slice(start)


def release() -> None:
    """Give freed memory back to the machine: a Python worker lives on for other tasks and stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def free(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores before it as it takes to be no column of ``df``."""
    while name in df.columns:
        name = "_" + name
    return name


def widen(
    df: DataFrame,
    column: str,
    added: str,
    make: Callable[[], Callable[[list], Sequence[list]]],
    carry: Sequence[str] | None = None,
    as_bytes: bool = False,
) -> DataFrame:
    """Add the columns of the DDL ``added``, computed from ``column`` in the task that holds the row.

    ``make()`` runs once in each task and returns a function from the values of ``column`` (texts, or
    UTF-8 bytes) to one list for each added column. ``carry`` names the columns to keep (default:
    all). Columns that are already there under an added name are replaced.
    """
    new = StructType.fromDDL(added)
    names = [c for c in (carry if carry is not None else df.columns) if c not in new.names]
    kept = df.select(*names, F.col(column).cast("string").alias("input"))
    out = StructType([StructField(f.name, f.dataType, True) for f in kept.select(*names).schema.fields] + new.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(f.dataType) for f in new.fields]
        work = make()
        for batch in batches:
            for part in slices(batch, len(names)):
                texts = part.column(len(names))
                made = work(values(texts.cast(pa.binary()) if as_bytes else texts))
                arrays = [pa.array(v, t) for v, t in zip(made, types)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(names)], *arrays], names=out.names)
        del work
        release()

    return kept.mapInArrow(run, out)
