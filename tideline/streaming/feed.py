"""Replay a bounded table as a stream, one arrival slice per micro-batch.

All slices are written in one job, as one folder each and with as many files as their size needs.
Releasing a slice renames its folder into the folder the stream watches, so a micro-batch sees all of
a slice or none of it (on file systems with atomic folder renames, such as HDFS).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tideline.functions.numeric import US
from tideline.session import ROCKSDB, shared_dir


class SliceFeed:
    """``rows`` need ``slice`` and the TIMESTAMP ``ts``.

    ``marker`` is a row (column values) that belongs to no real key. It is sent with every slice that
    does not itself move event time forward, two milliseconds past the newest, and twice at the end of
    input, ``horizon_s`` ahead, so that every window, session and timer closes. Rows without a slice never
    arrive; ``untimed`` is how many there are.
    """

    def __init__(self, rows: DataFrame, marker: dict[str, Any], horizon_s: int):
        self.spark: SparkSession = rows.sparkSession
        # A partition column comes last when files are read back; the stream's schema has to agree.
        rows = rows.select(*[c for c in rows.columns if c != "slice"], "slice")
        base = shared_dir(self.spark, "feed")
        self.base, self.schema = base, rows.schema
        self._staged, self._live = f"{base}/staged", f"{base}/live"
        beats = self._marker_rows(self._heartbeats(rows, horizon_s), marker)
        rows = rows.where("slice IS NOT NULL")
        # Rebalancing splits a slice that holds much of the data over several tasks and files.
        marked = rows.unionByName(beats).hint("rebalance", F.col("slice"))
        marked.write.partitionBy("slice").parquet(self._staged)
        self._fs, self._path = self._file_system(base)
        self._fs.mkdirs(self._path(self._live))
        self.slices = self.unreleased()

    @classmethod
    def reopen(cls, spark: SparkSession, base: str, schema) -> SliceFeed:
        """The feed below ``base`` after the loss of the driver: what is released stays released."""
        feed = cls.__new__(cls)
        feed.spark, feed.base, feed.schema = spark, base, schema
        feed._staged, feed._live, feed.untimed = f"{base}/staged", f"{base}/live", 0
        feed._fs, feed._path = feed._file_system(base)
        feed.slices = feed.unreleased()
        feed.rows = spark.read.schema(schema).parquet(feed._staged).count() if feed.slices else 0
        return feed

    def later(self) -> SliceFeed:
        """A feed of what is not released yet, whose stream sees nothing that has been."""
        feed = self.reopen(self.spark, self.base, self.schema)
        feed._live = f"{self.base}/live-{uuid.uuid4().hex[:12]}"
        feed._fs.mkdirs(feed._path(feed._live))
        return feed

    def unreleased(self) -> list[int]:
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(self._staged))]
        return sorted(int(n.split("=")[1]) for n in names if n.startswith("slice="))

    def _heartbeats(self, rows: DataFrame, horizon_s: int) -> list[tuple[int, int]]:
        """(slice, event time) of the markers: see the class."""
        # One short row per slice; this is control data and does not grow with the table.
        tops = (
            rows.groupBy("slice")
            .agg(F.max(F.unix_micros("ts")).alias("top"), F.count(F.lit(1)).alias("n"))
            .orderBy("slice")
            .collect()
        )
        self.untimed = sum(n for slice_no, _, n in tops if slice_no is None)
        tops = [t for t in tops if t[0] is not None]
        self.rows = sum(n for _, _, n in tops)
        newest, beats = None, []
        for slice_no, top, _ in tops:
            if top is None:  # a slice without any time moves nothing
                continue
            if newest is not None and top <= newest:
                newest += 2_000
                beats.append((slice_no, newest))
            else:
                newest = top
        if newest is None:
            return []
        return beats + [(tops[-1][0] + i, newest + (horizon_s + i) * US) for i in (1, 2)]

    def _marker_rows(self, at: list[tuple[int, int]], marker: dict[str, Any]) -> DataFrame:
        made = self.spark.createDataFrame(at, "slice bigint, us bigint")
        values = {**{k: F.lit(v) for k, v in marker.items()}, "ts": F.timestamp_micros("us")}
        return made.select(
            *[
                (F.col("slice") if f.name == "slice" else values.get(f.name, F.lit(None)).cast(f.dataType)).alias(f.name)
                for f in self.schema
            ]
        )

    def _file_system(self, base: str):
        jvm = self.spark._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path
        return path(base).getFileSystem(conf), path

    def state_partitions(self) -> int:
        """All cores of the cluster, or fewer when a slice cannot keep them busy."""
        per_slice = self.rows // max(1, len(self.slices))
        return max(2, min(self.spark.sparkContext.defaultParallelism, per_slice // 50_000))

    def stream(self) -> DataFrame:
        return self.spark.readStream.schema(self.schema).parquet(self._live)

    def release(self, slice_no: int) -> None:
        name = f"slice={slice_no}"
        if not self._fs.rename(self._path(f"{self._staged}/{name}"), self._path(f"{self._live}/{name}")):
            raise OSError(f"could not release {name}")

    def play(self, query: StreamingQuery, slices: Iterable[int] | None = None) -> None:
        """Release slices one by one, each as one micro-batch, then stop the query."""
        try:
            for s in self.slices if slices is None else slices:
                self.release(s)
                query.processAllAvailable()
        finally:
            query.stop()


@contextmanager
def stream_settings(spark: SparkSession, state_partitions: int | None = None, policy: str = "min"):
    """Settings a query takes over when it starts: RocksDB state, the number of state partitions (fixed
    in the checkpoint by the first run), which of several watermarks counts, and no empty micro-batches
    between slices. What was set before is put back."""
    wanted = {
        "spark.sql.streaming.multipleWatermarkPolicy": policy,
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism),
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
        # A micro-batch then commits its changes to the state, not a snapshot of all of it.
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def start_to_files(
    out: DataFrame, path: str, checkpoint: str, state_partitions: int | None = None, policy: str = "min"
) -> StreamingQuery:
    """Append to parquet files with the sink's own commit log: each result is written exactly once."""
    with stream_settings(out.sparkSession, state_partitions, policy):
        return (
            out.writeStream.outputMode("append")
            .format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .start()
        )


def replay(feed: SliceFeed, build: Callable[[DataFrame], DataFrame], purpose: str) -> DataFrame:
    """Run ``build`` over all slices and return what it wrote."""
    base = shared_dir(feed.spark, purpose)
    out = build(feed.stream())
    feed.play(start_to_files(out, f"{base}/out", f"{base}/checkpoint", feed.state_partitions()))
    return feed.spark.read.schema(out.schema).parquet(f"{base}/out")
