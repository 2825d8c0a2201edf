"""Window counts whose state moves to another number of partitions.

The number of state partitions is fixed by a checkpoint. To change it, the state is read from the old
checkpoint as a table, dealt out anew by key, and handed to a new query, which goes on with the input
that the old one has not seen.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.numeric import US
from tideline.streaming.accounting import added_up


@dataclass(frozen=True)
class Moved:
    """State of a stopped query: open windows (key, win_start_us, n), and the watermark up to which it has emitted."""

    windows: DataFrame
    closed_ms: int


def moved_state(spark: SparkSession, checkpoint: str, key: str) -> Moved:
    """What a query of `stream_count_windows` over fixed windows has left below ``checkpoint``.

    State is read partition by partition, as of the last committed micro-batch; so is the watermark, from
    the log of commits, one line for each of the last hundred or so micro-batches.
    """
    state = spark.read.format("statestore").load(checkpoint)
    names = state.schema["key"].dataType.names
    counts = state.schema["value"].dataType.names
    window, own = next(n for n in names if "window" in n), next(n for n in names if "window" not in n)
    windows = state.select(
        F.col(f"key.`{own}`").alias(key),
        F.unix_micros(F.col(f"key.`{window}`.start")).alias("win_start_us"),
        F.col(f"value.`{counts[-1]}`").alias("n"),
    )
    mark = F.get_json_object("value", "$.nextBatchWatermarkMs").cast("bigint").alias("ms")
    commits = spark.read.text(f"{checkpoint}/commits").where("value LIKE '{%'")
    commits = commits.select(F.col("_metadata.file_name").cast("bigint").alias("batch"), mark)
    # A commit holds the watermark of the micro-batch after it; the last one ran with that of the commit before.
    last = commits.orderBy(F.desc("batch")).take(2)
    return Moved(windows, last[1]["ms"] if len(last) > 1 else 0)


class MovedCounts(StatefulProcessor):
    """Counts of one (key, window), from moved state and new partial counts; emitted when the watermark has passed the end."""

    def __init__(self, key: str, key_type: str, size_s: int, closed_ms: int):
        self._key, self._size_ms, self._closed = key, size_s * 1_000, closed_ms
        self.output = f"{key} {key_type}, n bigint, win_start_us bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._count = handle.getValueState("count", "n bigint")

    def _add(self, key: tuple, n: int) -> None:
        end_ms = key[1] // 1_000 + self._size_ms
        if end_ms <= self._closed:  # the old query has emitted it: later rows are late, as they were there
            return
        if not self._count.exists():
            self._handle.registerTimer(end_ms)
        self._count.update(((self._count.get()[0] if self._count.exists() else 0) + n,))

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        self._add(key, initialState["n"])

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        self._add(key, sum(r["n"] for r in rows))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self._count.exists():
            yield Row(**{self._key: key[0], "n": self._count.get()[0], "win_start_us": key[1]})
            self._count.clear()

    def close(self) -> None:
        pass


def resume_count_windows(stream: DataFrame, key: str, size_s: int, delay_s: int, moved: Moved) -> DataFrame:
    """Counts per key and fixed window from where the state was left, in any number of state partitions.

    Each task sends one row for each key and window. The delay has to cover how far rows trail, as the engine
    drops what trails by more.
    """
    start = F.unix_micros("ts") - F.pmod(F.unix_micros("ts"), F.lit(size_s * US))
    rows = stream.where(F.col("ts").isNotNull()).select(key, start.alias("win_start_us"), F.lit(1).cast("bigint").alias("n"), "ts")
    key_type = stream.schema[key].dataType.simpleString()
    cells = added_up(rows, [key, "win_start_us"]).withWatermark("ts", f"{delay_s} seconds")
    processor = MovedCounts(key, key_type, size_s, moved.closed_ms)
    counted = cells.groupBy(key, "win_start_us").transformWithState(
        processor, processor.output, "append", "eventTime", initialState=moved.windows.groupBy(key, "win_start_us")
    )
    return counted.select(key, "win_start_us", (F.col("win_start_us") + size_s * US).alias("win_end_us"), "n")
