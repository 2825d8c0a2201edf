"""An append-only log of files as a stream source with offsets of its own.

A log is a folder of numbered appends, ``append=<n>/*.parquet``, each written by one Spark job and
complete once the job has left its marker. The position in it is the number of appends read; it lies in
the checkpoint of the query, so a restart goes on after the last committed micro-batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema


def as_uri(path: str) -> str:
    """A plain path counts as a file URI."""
    return path if re.match(r"[a-z0-9+.-]+:", path) else f"file://{path}"


def folder_of(number: int) -> str:
    return f"append={number:010d}"


@dataclass
class Span(InputPartition):
    """Rows [first, last) of a file."""

    file: str
    first: int
    last: int


class _Log:
    """What reading a log takes, for both the bounded and the streaming reader."""

    #: Most rows of a record batch.
    ROWS = 65_536

    def __init__(self, options: dict, schema):
        self._path = as_uri(options["path"].rstrip("/"))
        self._span = int(options.get("rowsPerPartition", "1000000"))
        self._schema = to_arrow_schema(schema)
        self._complete = 0

    def _appends(self) -> int:
        """How many appends are complete. Looks only for those after the ones seen before."""
        files, root = fs.FileSystem.from_uri(self._path)
        while files.get_file_info(f"{root}/{folder_of(self._complete)}/_SUCCESS").type == fs.FileType.File:
            self._complete += 1
        return self._complete

    def _spans(self, first: int, last: int) -> list[Span]:
        """Appends [first, last) as pieces of files, by the row counts in the footers."""
        files, root = fs.FileSystem.from_uri(self._path)
        spans = []
        for number in range(first, last):
            held = files.get_file_info(fs.FileSelector(f"{root}/{folder_of(number)}"))
            for name in sorted(i.path for i in held if i.extension == "parquet" and not i.base_name.startswith(("_", "."))):
                rows = pq.read_metadata(name, filesystem=files).num_rows
                spans += [Span(name, at, min(at + self._span, rows)) for at in range(0, rows, self._span)]
        return spans

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        """Reads only the columns asked for, of the row groups that hold the span."""
        files, _ = fs.FileSystem.from_uri(self._path)
        with files.open_input_file(partition.file) as source:
            parquet, begin, groups, at = pq.ParquetFile(source), 0, [], None
            for g in range(parquet.num_row_groups):
                size = parquet.metadata.row_group(g).num_rows
                if begin < partition.last and begin + size > partition.first:
                    groups.append(g)
                    at = begin if at is None else at
                begin += size
            for batch in parquet.iter_batches(self.ROWS, row_groups=groups, columns=self._schema.names):
                low, high = max(0, partition.first - at), min(batch.num_rows, partition.last - at)
                at += batch.num_rows
                if low < high:
                    part = pa.Table.from_batches([batch.slice(low, high - low)])
                    yield from part.cast(self._schema).combine_chunks().to_batches()


class _LogReader(_Log, DataSourceReader):
    def partitions(self) -> list[Span]:
        return self._spans(0, self._appends())


class _LogStreamReader(_Log, DataSourceStreamReader):
    """Takes what is complete at each trigger. Nothing is kept but the position, so a restart needs no more than that."""

    def initialOffset(self) -> dict:
        return {"appends": 0}

    def latestOffset(self) -> dict:
        return {"appends": self._appends()}

    def partitions(self, start: dict, end: dict) -> list[Span]:
        return self._spans(start["appends"], end["appends"])

    def commit(self, end: dict) -> None:
        """Readers of other queries may still need what this one has read: the log is kept."""


class LogSource(DataSource):
    """``format("file_log")`` with ``path`` and ``rowsPerPartition``; the schema has to be given."""

    @classmethod
    def name(cls) -> str:
        return "file_log"

    def schema(self) -> str:
        raise ValueError("a log is read with .schema(...)")

    def reader(self, schema) -> _LogReader:
        return _LogReader(self.options, schema)

    def streamReader(self, schema) -> _LogStreamReader:
        return _LogStreamReader(self.options, schema)


def append_log(df: DataFrame, path: str, number: int) -> None:
    """Write ``df`` as one append; a job that failed is run again under its number."""
    df.write.mode("overwrite").parquet(f"{path}/{folder_of(number)}")


def read_log(spark: SparkSession, path: str, schema, stream: bool = False, rows_per_partition: int = 1_000_000) -> DataFrame:
    """The log as a bounded table, or as a stream."""
    spark.dataSource.register(LogSource)
    reader = (spark.readStream if stream else spark.read).format("file_log")
    return reader.schema(schema).option("path", path).option("rowsPerPartition", str(rows_per_partition)).load()
