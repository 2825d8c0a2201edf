"""Windowed aggregation, deduplication and merged inputs on streams."""

from __future__ import annotations

import threading
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from tideline.operators.windows import Windowing, count_windows


def stream_count_windows(stream: DataFrame, key: str, windowing: Windowing, delay_s: int) -> DataFrame:
    """Counts per key and window, emitted once the watermark (newest event less ``delay_s``) has passed
    the window end. State is kept per open window and removed then."""
    return count_windows(stream.withWatermark("ts", f"{delay_s} seconds"), key, windowing)


def stream_distinct(stream: DataFrame, row_id: str, delay_s: int) -> DataFrame:
    """The first copy of each row; copies more than ``delay_s`` of event time apart are not remembered."""
    return stream.withWatermark("ts", f"{delay_s} seconds").dropDuplicatesWithinWatermark([row_id])


def merge_inputs(inputs: list[tuple[DataFrame, int]]) -> DataFrame:
    """Union of streams that each have their own watermark delay in seconds.

    The policy is chosen when the query starts (``stream_settings``): ``min`` waits for the slowest
    input, also while it is silent; an idle input must then send heartbeat rows. ``max`` follows the
    fastest and may drop rows of the slower ones.
    """
    return reduce(DataFrame.unionByName, [df.withWatermark("ts", f"{d} seconds") for df, d in inputs])


def idle_heartbeats(rows: DataFrame, channel: str, channels: Sequence[str]) -> DataFrame:
    """Time-only rows (``slice``, ``channel``, ``ts``) of inputs that are silent in a slice.

    Each carries the event time that the inputs heard in that slice have all reached, so that the ``min``
    policy is decided by those alone. An input is waited for until it has been heard once. Sent along
    with the rows of their input; one short row per slice and silent input.
    """
    names = range(len(channels))
    heard = rows.where(F.col("slice").isNotNull() & F.col("ts").isNotNull()).groupBy("slice").agg(
        *[F.max(F.when(F.col(channel) == c, F.col("ts"))).alias(f"__m{i}") for i, c in enumerate(channels)]
    )
    # Control data: one row per slice.
    seen = Window.partitionBy(F.lit(0)).orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    marks = heard.select("slice", *[f"__m{i}" for i in names], *[F.max(f"__m{i}").over(seen).alias(f"__w{i}") for i in names])
    reached = F.array_min(F.array(*[F.when(F.col(f"__m{i}").isNotNull(), F.col(f"__w{i}")) for i in names]))
    ready = reduce(lambda a, b: a & b, [F.col(f"__w{i}").isNotNull() for i in names])
    silent = F.array_compact(F.array(*[F.when(F.col(f"__m{i}").isNull(), F.lit(c)) for i, c in enumerate(channels)]))
    return marks.where(ready).select("slice", F.explode(silent).alias(channel), reached.alias("ts"))


class WatermarkLog(StreamingQueryListener):
    """The engine's watermark after each slice, as the session's queries report it.

    A micro-batch reports the watermark that it started with, so the one after a slice comes with the
    next micro-batch. The query has to observe ``NAME`` with the newest slice of its rows.
    """

    NAME = "slices"

    def __init__(self) -> None:
        self._batches: dict[int, tuple[int | None, str]] = {}
        self._ended = threading.Event()

    @classmethod
    def observed(cls, rows: DataFrame) -> DataFrame:
        return rows.observe(cls.NAME, F.max("slice").alias("slice"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found = progress.observedMetrics.get(self.NAME)
        # Progress without a new micro-batch repeats the number of the last one.
        if progress.numInputRows or progress.batchId not in self._batches:
            self._batches[progress.batchId] = (found["slice"] if found else None, progress.eventTime.get("watermark", ""))

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def after_slices(self, timeout_s: float = 60.0) -> list[tuple[int, int | None]]:
        """(slice, watermark in microseconds): None while an input has not been heard. The last slice needs one more micro-batch."""
        if not self._ended.wait(timeout_s):
            raise TimeoutError("the query has not reported its end")
        known = [self._batches[b] for b in sorted(self._batches)]
        return [(number, _micros(mark)) for (number, _), (_, mark) in zip(known, known[1:]) if number is not None]


def _micros(mark: str) -> int | None:
    if not mark:
        return None
    since = datetime.fromisoformat(mark.replace("Z", "+00:00")) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return since // timedelta(microseconds=1) or None
