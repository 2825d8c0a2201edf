"""Late and dropped rows of a stream: counted by status inside the query, reported as metrics of every micro-batch."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from tideline.functions.numeric import US
from tideline.operators.watermarks import window_end

STATUSES = ("EARLY", "ON_TIME", "LATE", "DROPPED")
SEEN, JUDGED = "rows_seen", "rows_judged"


class MetricTotals(StreamingQueryListener):
    """Adds up the observed metrics and the engine's dropped rows over all micro-batches of the session's queries.

    A micro-batch that is run again after a failure replaces what its first run reported.
    """

    def __init__(self) -> None:
        self._batches: dict[tuple[str, int], Counter] = {}
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        found: Counter = Counter()
        for metrics in progress.observedMetrics.values():
            found.update({k: v or 0 for k, v in metrics.asDict().items()})
        found["dropped_by_watermark"] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
        # Progress without a new micro-batch repeats the number of the last one.
        if progress.numInputRows or (str(progress.id), progress.batchId) not in self._batches:
            self._batches[str(progress.id), progress.batchId] = found

    def onQueryTerminated(self, event) -> None:
        self._ended.set()

    def totals(self, timeout_s: float = 60.0) -> Counter:
        """The sums, once the query has ended and everything it reported has come in."""
        if not self._ended.wait(timeout_s):
            raise TimeoutError("the query has not reported its end")
        return sum(self._batches.values(), Counter())


def added_up(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, n and perhaps ts) of each Arrow batch added up by the keys, before the shuffle: n, and the newest ts."""
    timed = "ts" in rows.columns
    order = [*keys, "n", "ts"] if timed else [*keys, "n"]
    rows = rows.select(order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                table = pa.Table.from_batches([batch]).group_by(keys).aggregate([("n", "sum"), ("ts", "max")] if timed else [("n", "sum")])
                yield from table.rename_columns(order).combine_chunks().to_batches()

    return rows.mapInArrow(run, rows.schema)


class StatusProcessor(StatefulProcessor):
    """Status of the rows of one window. Rows that come before its end wait for one micro-batch: whether the watermark
    that their own slice leads to has passed the end decides between ON_TIME and EARLY."""

    OUTPUT = "win_end_us bigint, status string, n bigint"

    def __init__(self, lateness_s: int, delay_s: int):
        self._lateness, self._delay = lateness_s * US, delay_s * US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._waiting = handle.getValueState("waiting", "n bigint, at_ms bigint")

    def _now(self, timerValues: Any) -> int | None:
        """The newest event time of earlier micro-batches; the engine's watermark trails it by the delay."""
        ms = timerValues.getCurrentWatermarkInMs()
        return ms * 1_000 + self._delay if ms > 0 else None

    def _decide(self, end: int, timerValues: Any) -> Iterator[Row]:
        """Rows of an earlier micro-batch: the watermark has moved since. A timer of theirs also fires for newer rows."""
        if self._waiting.exists() and self._waiting.get()[1] != timerValues.getCurrentWatermarkInMs():
            n, now = self._waiting.get()[0], self._now(timerValues)
            self._waiting.clear()
            yield Row(win_end_us=end, status="ON_TIME" if now is not None and now >= end else "EARLY", n=n)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        end, now = key[0], self._now(timerValues)
        n = sum(r["n"] for r in rows)
        yield from self._decide(end, timerValues)
        if now is not None and now >= end:
            yield Row(win_end_us=end, status="DROPPED" if now >= end + self._lateness else "LATE", n=n)
        else:
            at_ms = timerValues.getCurrentWatermarkInMs()
            more = self._waiting.get()[0] if self._waiting.exists() else 0
            self._waiting.update((n + more, at_ms))
            self._handle.registerTimer(at_ms + 1)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        yield from self._decide(key[0], timerValues)

    def close(self) -> None:
        pass


def stream_status_counts(stream: DataFrame, size_s: int, lateness_s: int, delay_s: int, counts: Column | None = None) -> DataFrame:
    """Counts by window end and status, with two observed metrics: rows seen, and rows by status.

    ``counts`` tells rows that count from those that only move event time. Each task sends one row for each
    window. Rows that the engine itself drops because they trail by more than ``delay_s`` are seen but not
    judged: the difference of the two metrics, which `late_counts` adds to DROPPED. Nothing else is dropped if
    the delay is at least window and lateness together.
    """
    if delay_s < size_s + lateness_s:
        raise ValueError("a delay below window and lateness would drop rows that are late only")
    one = F.lit(1) if counts is None else F.when(counts, 1).otherwise(0)
    rows = stream.where(F.col("ts").isNotNull()).select(window_end(F.unix_micros("ts"), size_s).alias("win_end_us"), one.cast("bigint").alias("n"), "ts")
    seen = rows.observe(SEEN, F.sum("n").alias("seen"))
    judged = (
        added_up(seen, ["win_end_us"])
        .withWatermark("ts", f"{delay_s} seconds")
        .groupBy("win_end_us")
        .transformWithState(StatusProcessor(lateness_s, delay_s), StatusProcessor.OUTPUT, "append", "eventTime")
    )
    by_status = [F.sum(F.when(F.col("status") == s, F.col("n"))).alias(s) for s in STATUSES]
    return judged.observe(JUDGED, *by_status)


def late_counts(totals: Counter, untimed: int = 0) -> dict[str, int]:
    """Rows by status, from what a listener has added up; ``untimed`` rows never reached the stream."""
    found = {s: totals[s] for s in STATUSES}
    found["DROPPED"] += totals["seen"] - sum(found.values())
    found["UNTIMED"] = untimed
    return {s: n for s, n in found.items() if n}
