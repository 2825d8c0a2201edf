"""Sinks that a replayed micro-batch or a retried task cannot write twice."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery

from tideline.streaming.feed import stream_settings


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: each micro-batch owns a folder and overwrites it when it is replayed."""

    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def start_idempotent(
    rows: DataFrame, path: str, checkpoint: str, write: Callable[[DataFrame, int], None] | None = None
) -> StreamingQuery:
    with stream_settings(rows.sparkSession):
        return (
            rows.writeStream.foreachBatch(write or batch_writer(path))
            .option("checkpointLocation", checkpoint)
            .start()
        )


def read_batches(spark: SparkSession, path: str, schema, row_id: str | None = None) -> DataFrame:
    """Everything written; with ``row_id`` once per id, for a source that repeats rows itself."""
    rows = spark.read.schema(schema).option("basePath", path).parquet(f"{path}/batch_id=*")
    return rows.dropDuplicates([row_id]) if row_id else rows


@dataclass
class _Written(WriterCommitMessage):
    file: str | None
    rows: int


class _TransactionalWriter(DataSourceStreamArrowWriter):
    """Tasks write files that nobody reads; the commit of a micro-batch names those that count.

    What counts is one small file for each micro-batch below ``log``, written under another name and
    then renamed, so it is there whole or not at all. A micro-batch whose file is already there has
    been committed before: its replay changes nothing. Files of failed and repeated tasks are
    never named; `abort` removes those it hears of.
    """

    def __init__(self, path: str):
        self._path = path.rstrip("/")

    def _files(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self._path)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, root = self._files()
        files.create_dir(f"{root}/data")
        name, rows, out = f"{uuid.uuid4().hex}.parquet", 0, None
        for batch in iterator:
            if not batch.num_rows:
                continue
            out = out or pq.ParquetWriter(f"{root}/data/{name}", batch.schema, filesystem=files)
            out.write_batch(batch)
            rows += batch.num_rows
        if out:
            out.close()
        return _Written(name if out else None, rows)

    def commit(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        files, root = self._files()
        files.create_dir(f"{root}/log")
        entry = f"{root}/log/{batchId:010d}.json"
        if files.get_file_info(entry).type != fs.FileType.NotFound:
            self.abort(messages, batchId)
            return
        named = [{"batch_id": batchId, "file": m.file, "rows": m.rows} for m in messages if m and m.file]
        draft = f"{root}/log/_{uuid.uuid4().hex}"  # a leading underscore hides it from readers
        with files.open_output_stream(draft) as out:
            out.write("".join(json.dumps(n) + "\n" for n in named).encode())
        files.move(draft, entry)

    def abort(self, messages: list[WriterCommitMessage | None], batchId: int) -> None:
        files, root = self._files()
        for m in messages:
            if m and m.file:
                files.delete_file(f"{root}/data/{m.file}")


class TransactionalSink(DataSource):
    """``writeStream.format("transactional").option("path", folder)``; register it with ``spark.dataSource``."""

    @classmethod
    def name(cls) -> str:
        return "transactional"

    def streamWriter(self, schema, overwrite: bool) -> _TransactionalWriter:
        return _TransactionalWriter(self.options["path"])


def start_transactional(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """``path`` is a URI of a folder that all executors reach (a plain path counts as a file URI)."""
    spark = rows.sparkSession
    spark.dataSource.register(TransactionalSink)
    with stream_settings(spark):
        return (
            rows.writeStream.format("transactional")
            .option("path", as_uri(path))
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .start()
        )


def as_uri(path: str) -> str:
    return path if ":" in path.split("/")[0] else f"file://{path}"


def read_committed(spark: SparkSession, path: str, schema) -> DataFrame:
    """The rows of all committed micro-batches, with their batch_id.

    Which files count is looked up by a join of the log with the names of the files that rows come from.
    """
    log = spark.read.schema("batch_id bigint, file string, rows bigint").json(f"{path}/log")
    rows = spark.read.schema(schema).parquet(f"{path}/data").select("*", F.col("_metadata.file_name").alias("file"))
    return rows.join(log.select("file", "batch_id"), "file").drop("file")
