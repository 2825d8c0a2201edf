"""Offset ranges: element N stands for the work [0, N), cut into chunks before it is read."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


def split_ranges(df: DataFrame, n: str, chunk: int = 8) -> DataFrame:
    """One row per half-open chunk ``[start, stop)`` of each row's ``[0, n)``.

    A huge range is first cut into blocks and the blocks into chunks, so that no row ever builds an
    array as long as its own range.
    """
    block = chunk * 4096
    blocks = df.where(F.col(n) > 0).withColumn(
        "__block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1, F.lit(block)))
    )
    last = F.least(F.col("__block") + block, F.col(n)) - 1
    chunks = blocks.withColumn("start", F.explode(F.sequence(F.col("__block"), last, F.lit(chunk))))
    return chunks.withColumn("stop", F.least(F.col("start") + chunk, F.col(n))).drop("__block")


def read_ranges(chunks: DataFrame, spread: bool = False) -> DataFrame:
    """Emit every offset of every chunk once. ``spread`` rebalances the chunks over the cluster first,
    for inputs in which a few rows own most offsets."""
    if spread:
        chunks = chunks.hint("rebalance")
    return chunks.withColumn("offset", F.explode(F.sequence("start", F.col("stop") - 1)))


class _Chunk(InputPartition):
    def __init__(self, start: int, stop: int):
        self.start = start
        self.stop = stop


class _OffsetReader(DataSourceReader):
    """Chunks are grouped into at most ``MOST`` partitions, which are read in record batches of ``ROWS``."""

    MOST = 10_000
    ROWS = 65_536

    def __init__(self, stop: int, chunk: int):
        self._stop = stop
        self._chunk = chunk

    def partitions(self):
        chunks = -(-self._stop // self._chunk)
        size = self._chunk * max(1, -(-chunks // self.MOST))
        return [_Chunk(lo, min(lo + size, self._stop)) for lo in range(0, self._stop, size)]

    def read(self, partition):
        for lo in range(partition.start, partition.stop, self.ROWS):
            offsets = np.arange(lo, min(lo + self.ROWS, partition.stop), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(offsets)], names=["offset"])


class OffsetRangeSource(DataSource):
    """``spark.read.format("offset_range").option("stop", n).option("chunk", 8).load()``."""

    @classmethod
    def name(cls) -> str:
        return "offset_range"

    def schema(self) -> str:
        return "offset bigint"

    def reader(self, schema):
        return _OffsetReader(int(self.options["stop"]), int(self.options.get("chunk", "8")))
