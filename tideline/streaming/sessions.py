"""Keyed state and timers on streams: sessions, rate limit, join with timeout, wall-clock flush.

All processors take rows out of order. A result is final once the watermark, which trails the newest
event by the allowed delay, has passed everything that could still change it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DataType, IntegralType, LongType, StringType, StructType

from tideline.functions.numeric import US
from tideline.streaming.accounting import added_up


def _rearm(handle: StatefulProcessorHandle, armed, due_us: int | None) -> None:
    """Keep one timer per key, just past ``due_us``; setting it again overwrites it."""
    due_ms = None if due_us is None else due_us // 1_000 + 1
    old = armed.get()[0] if armed.exists() else None
    if old == due_ms:
        return
    if old is not None:
        handle.deleteTimer(old)
    if due_ms is None:
        armed.clear()
    else:
        handle.registerTimer(due_ms)
        armed.update((due_ms,))


_BLOB = "data binary"


def _packed(rows: pd.DataFrame) -> tuple[bytes]:
    """Rows as one state value, in Arrow's own format."""
    table = pa.Table.from_pandas(rows, preserve_index=False).replace_schema_metadata(None)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return (sink.getvalue().to_pybytes(),)


def _unpacked(value: tuple) -> pd.DataFrame:
    return pa.ipc.open_stream(pa.py_buffer(bytes(value[0]))).read_pandas()


def _codes(rows: pd.DataFrame) -> np.ndarray:
    """A number for each key; the missing key is one of its own."""
    return pd.factorize(rows["k"], use_na_sentinel=False)[0] * 2 + rows["no_k"].to_numpy(dtype=bool)


def plain(column: Column, dtype: DataType, name: str) -> list[Column]:
    """``column`` without NULLs and ``no_<name>``, which says where they were, so that pandas keeps large integers."""
    start = {"string": "", "binary": "", "boolean": "false", "date": "1970-01-01", "timestamp": "1970-01-01"}
    blank = F.lit(start.get(dtype.simpleString().removesuffix("_ntz"), "0")).cast(dtype)
    return [F.coalesce(column, blank).alias(name), column.isNull().alias(f"no_{name}")]


def whole(name: str, as_name: str) -> Column:
    return F.when(~F.col(f"no_{name}"), F.col(name)).alias(as_name)


def _floor_div(us: str, width_us: int) -> Column:
    return F.expr(f"({us} - pmod({us}, {width_us}L)) div {width_us}L")


def _shard(shards: int) -> Column:
    """Keys travel and are kept in ``shards`` groups: a task then works on the columns of many keys at once
    and calls the state a few times for all of them."""
    return F.pmod(F.xxhash64("k", "no_k"), F.lit(shards)).alias("shard")


def _as_pandas(rows: DataFrame, fn: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType) -> DataFrame:
    """``fn`` over each Arrow batch. Integers stay integers where some are NULL, so large ones keep all their digits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        for batch in batches:
            if batch.num_rows:
                made = fn(batch.to_pandas(integer_object_nulls=True))
                yield pa.RecordBatch.from_pandas(made, schema=arrow, preserve_index=False)

    return rows.mapInArrow(run, schema)


def _merged_sessions(rows: pd.DataFrame, gap_us: int) -> tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]:
    """Rows (k, no_k, t, id, last, n) in order, the first row of each session, its last time and its count.

    A row stands for ``n`` rows from ``t`` to ``last``, so partial sessions merge by the rule for rows."""
    ids = rows["id"].to_numpy()
    if ids.dtype == object:
        ids = pd.factorize(rows["id"], sort=True, use_na_sentinel=False)[0]
    codes = _codes(rows)
    order = np.lexsort((ids, rows["t"].to_numpy(), codes))
    rows, codes = rows.iloc[order], codes[order]
    t = rows["t"].to_numpy()
    reach = rows["last"].groupby(codes).cummax().to_numpy()
    starts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (t[1:] - reach[:-1] > gap_us)])
    stops = np.r_[starts[1:], len(rows)]
    return rows, starts, reach[stops - 1], np.add.reduceat(rows["n"].to_numpy(), starts)


def _first_of(rows: pd.DataFrame, starts: np.ndarray, last: np.ndarray, n: np.ndarray, sample: int):
    """The first ``sample`` rows of each session and the session each belongs to. Its first row stands for all of it."""
    session = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(rows)]))
    kept = np.arange(len(rows)) - starts[session] < sample
    spans, counts = rows["t"].to_numpy().copy(), np.zeros(len(rows), dtype=np.int64)
    spans[starts], counts[starts] = last, n
    return rows.assign(last=spans, n=counts)[kept], session[kept]


def _partial_sessions(gap_us: int, sample: int):
    """Fold the rows of each Arrow batch into partial sessions of at most ``sample`` rows, before the shuffle."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        merged, starts, last, n = _merged_sessions(rows.assign(last=rows["t"], n=1), gap_us)
        ends = merged["ts"].array[np.r_[starts[1:], len(merged)] - 1]
        first, session = _first_of(merged, starts, last, n, sample)
        return first.assign(ts=ends[session], text=[str(v) for v in first["value"].tolist()])

    return run


class SessionProcessor(StatefulProcessor):
    """Sessions of the keys of a shard, from partial sessions. An open session is kept as an accumulator of
    bounded size: its bounds, row count and first rows. They merge when rows close the gap between them."""

    output = "k {}, no_k boolean, events bigint, ended_us bigint, sample_values string, flag string"

    def __init__(self, gap_s: int, burst: int, sample: int = 5):
        self._gap = gap_s * US
        self._burst = burst
        self._sample = sample

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._open = handle.getValueState("open", _BLOB)
        self._armed = handle.getValueState("armed", "at_ms bigint")

    def _close(self, rows: list[pd.DataFrame], wm_us: int) -> Iterator[pd.DataFrame]:
        if self._open.exists():
            rows = [_unpacked(self._open.get()), *rows]
        if not rows:
            return
        merged, starts, last, n = _merged_sessions(pd.concat(rows, ignore_index=True), self._gap)
        first, session = _first_of(merged, starts, last, n, self._sample)
        over = last + self._gap < wm_us
        if over.all():
            self._open.clear()
        else:
            self._open.update(_packed(first[~over[session]]))
        _rearm(self._handle, self._armed, None if over.all() else int(last[~over].min()) + self._gap)
        if over.any():
            texts = first["text"].tolist()
            ends = np.cumsum(np.bincount(session, minlength=len(starts)))
            head = merged.iloc[starts[over]]
            yield pd.DataFrame(
                {
                    "k": head["k"].array,
                    "no_k": head["no_k"].array,
                    "events": n[over],
                    "ended_us": last[over],
                    "sample_values": [",".join(texts[a:b]) for a, b in zip(np.r_[0, ends[:-1]][over], ends[over])],
                    "flag": np.where(n[over] >= self._burst, "BURST", "ok"),
                }
            )

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = [r[["k", "no_k", "t", "id", "text", "last", "n"]] for r in rows]
        yield from self._close(new, timerValues.getCurrentWatermarkInMs() * 1_000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self._armed.clear()
        yield from self._close([], timerValues.getCurrentWatermarkInMs() * 1_000)

    def close(self) -> None:
        pass


def _last_id(column: Column, dtype: DataType) -> Column:
    """Ids for ordering, missing ones last."""
    if isinstance(dtype, IntegralType):
        return F.coalesce(column.cast("bigint"), F.lit((1 << 63) - 1))
    return F.coalesce(column, F.lit("\U0010ffff")) if isinstance(dtype, StringType) else column


def stream_sessions(
    stream: DataFrame,
    key: str,
    gap_s: int,
    burst: int,
    delay_s: int,
    value: str = "value",
    row_id: str = "event_id",
    shards: int = 64,
) -> DataFrame:
    """Sessions per key: row count, last event time, first five values, ``BURST`` or ``ok``.

    ``shards`` should be a few times the number of state partitions; a checkpoint fixes it. The open sessions
    of a shard are read and written once for each micro-batch that brings it rows or ends one of them.
    """
    key_type = stream.schema[key].dataType
    rows = stream.where(F.col("ts").isNotNull()).select(
        *plain(F.col(key), key_type, "k"), "ts", F.unix_micros("ts").alias("t"),
        _last_id(F.col(row_id), stream.schema[row_id].dataType).alias("id"), F.col(value).alias("value"),
    )
    fields = [f for f in rows.schema.fields if f.name != "value"]
    schema = StructType([*fields, *StructType.fromDDL("text string, last bigint, n bigint").fields])
    partial = _as_pandas(rows, _partial_sessions(gap_s * US, sample=5), schema)
    processor = SessionProcessor(gap_s, burst)
    return (
        partial.withWatermark("ts", f"{delay_s} seconds")
        .select(_shard(shards), "*")
        .groupBy("shard")
        .transformWithStateInPandas(processor, processor.output.format(key_type.simpleString()), "append", "eventTime")
        .select(whole("k", key), "events", "ended_us", "sample_values", "flag")
    )


def _first_rows(limit: int):
    """Keep what can pass a limiter: per Arrow batch the first rows of each key and period."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["arrival_us", "id"])
        return rows.groupby([_codes(rows), rows["period"]], sort=False).head(limit)

    return run


class RateLimitProcessor(StatefulProcessor):
    """Lets the first ``limit`` rows per key and period through, in arrival order. The counts of the keys of
    a shard live until the period can get no more rows."""

    output = "k {}, no_k boolean, period bigint, nth bigint, id bigint, no_id boolean"

    def __init__(self, limit: int, period_s: int):
        self._limit = limit
        self._period = period_s * US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._counts = handle.getValueState("counts", _BLOB)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat(rows, ignore_index=True).sort_values(["arrival_us", "no_id", "id"], ignore_index=True)
        period = int(key[1])
        if self._counts.exists():
            old = _unpacked(self._counts.get())
        else:
            old = new[["k", "no_k"]].iloc[:0].assign(n=np.zeros(0, dtype=np.int64))
            self._handle.registerTimer((period + 1) * self._period // 1_000)
        codes = _codes(pd.concat([old[["k", "no_k"]], new[["k", "no_k"]]], ignore_index=True) if len(old) else new)
        before = np.zeros(codes.max() + 1, dtype=np.int64)
        before[codes[: len(old)]] = old["n"].to_numpy()
        codes = codes[len(old) :]
        new = new.assign(n=before[codes] + new.groupby(codes).cumcount().to_numpy() + 1)
        passed = new[new["n"] <= self._limit]
        if len(passed):
            counts = pd.concat([old, passed[["k", "no_k", "n"]]], ignore_index=True) if len(old) else passed[["k", "no_k", "n"]]
            self._counts.update(_packed(counts.groupby(["k", "no_k"], sort=False, dropna=False, as_index=False)["n"].max()))
            yield passed[["k", "no_k", "id", "no_id"]].assign(period=period, nth=passed["n"])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self._counts.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_rate_limit(
    stream: DataFrame,
    key: str,
    limit: int,
    period_s: int,
    delay_s: int,
    row_id: str = "event_id",
    shards: int = 32,
) -> DataFrame:
    """The first ``limit`` rows of each key and period, in arrival order. A state key is a shard of keys and a period."""
    key_type = stream.schema[key].dataType
    rows = stream.where(F.col("ts").isNotNull()).withColumn("__us", F.unix_micros("ts")).select(
        *plain(F.col(key), key_type, "k"), "ts", _floor_div("__us", period_s * US).alias("period"), "arrival_us",
        *plain(F.col(row_id).cast("bigint"), LongType(), "id"),
    )
    processor = RateLimitProcessor(limit, period_s)
    return (
        _as_pandas(rows, _first_rows(limit), rows.schema)
        .withWatermark("ts", f"{delay_s} seconds")
        .select(_shard(shards), "*")
        .groupBy("shard", "period")
        .transformWithStateInPandas(processor, processor.output.format(key_type.simpleString()), "append", "eventTime")
        .select(whole("k", key), "period", "nth", whole("id", row_id))
    )


class TimeoutJoinProcessor(StatefulProcessor):
    """Each left row with the first right row in its timeout, or unmatched when the timeout is over.

    Left rows wait until then; right rows are kept while a left row, waiting or still to come, can
    need them. Rows of the keys of a shard are appended to the state as they come and read again
    when a timeout is over."""

    output = "k {}, no_k boolean, id bigint, no_id boolean, matched_us bigint, matched boolean"

    def __init__(self, timeout_s: int):
        self._timeout = timeout_s * US

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._rows = handle.getListState("rows", _BLOB)
        self._marks = handle.getValueState("marks", "first_left bigint, last_right bigint")
        self._armed = handle.getValueState("armed", "at_ms bigint")

    @staticmethod
    def _marks_of(rows: pd.DataFrame) -> tuple[int | None, int | None]:
        left, right = rows.loc[rows["is_left"], "t"], rows.loc[~rows["is_left"], "t"]
        return int(left.min()) if len(left) else None, int(right.max()) if len(right) else None

    def _mark(self, first_left: int | None, last_right: int | None) -> None:
        if first_left is None and last_right is None:
            self._marks.clear()
            _rearm(self._handle, self._armed, None)
        else:
            self._marks.update((first_left, last_right))
            _rearm(self._handle, self._armed, last_right if first_left is None else first_left + self._timeout)

    def _resolve(self, rows: pd.DataFrame, wm_us: int) -> Iterator[pd.DataFrame]:
        codes, t, is_left = _codes(rows), rows["t"].to_numpy(), rows["is_left"].to_numpy(dtype=bool)
        # At equal times a right row follows the left ones, which it matches.
        order = np.lexsort((~is_left, t, codes))
        rows, codes, t, is_left = rows.iloc[order], codes[order], t[order], is_left[order]
        places = np.where(is_left, len(rows) - 1, np.arange(len(rows)))
        following = np.minimum.accumulate(places[::-1])[::-1]
        matched = ~is_left[following] & (codes[following] == codes) & (t[following] <= t + self._timeout)
        due = is_left & (t + self._timeout < wm_us)
        waiting = is_left & ~due
        needed_from = min(wm_us, int(t[waiting].min())) if waiting.any() else wm_us
        kept = rows[waiting | (~is_left & (t >= needed_from))]
        if len(kept):
            self._rows.put([_packed(kept)])
        else:
            self._rows.clear()
        self._mark(*self._marks_of(kept))
        if due.any():
            yield rows.loc[due, ["k", "no_k", "id", "no_id"]].assign(matched_us=t[following][due], matched=matched[due])

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        new = pd.concat(rows, ignore_index=True)[["k", "no_k", "t", "id", "no_id", "is_left"]]
        wm_us = timerValues.getCurrentWatermarkInMs() * 1_000
        first_left, last_right = self._marks_of(new)
        if self._marks.exists():
            known_left, known_right = self._marks.get()
            first_left = min((m for m in (first_left, known_left) if m is not None), default=None)
            last_right = max((m for m in (last_right, known_right) if m is not None), default=None)
        if first_left is not None and first_left + self._timeout < wm_us:
            yield from self._resolve(pd.concat([*self._stored(), new], ignore_index=True), wm_us)
        else:
            self._rows.appendValue(_packed(new))
            self._mark(first_left, last_right)

    def _stored(self) -> list[pd.DataFrame]:
        return [_unpacked(r) for r in self._rows.get()] if self._rows.exists() else []

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        self._armed.clear()
        stored = self._stored()
        if stored:
            yield from self._resolve(pd.concat(stored, ignore_index=True), timerValues.getCurrentWatermarkInMs() * 1_000)

    def close(self) -> None:
        pass


def stream_join_with_timeout(
    stream: DataFrame, key: str, is_left, timeout_s: int, delay_s: int, row_id: str = "event_id", shards: int = 32
) -> DataFrame:
    """``stream`` holds both sides; ``is_left`` is a boolean column telling them apart.

    A key is spread over buckets of ``timeout_s``: a left row lies in its own, a right row goes to its
    own and the one before, which hold all left rows it can match. A state key is a shard of keys and a
    bucket, and ends with the bucket.
    """
    key_type = stream.schema[key].dataType
    bucket = _floor_div("t", timeout_s * US)
    rows = stream.where(F.col("ts").isNotNull()).select(
        *plain(F.col(key), key_type, "k"), "ts", F.unix_micros("ts").alias("t"),
        *plain(F.col(row_id).cast("bigint"), LongType(), "id"), F.coalesce(is_left, F.lit(False)).alias("is_left"),
    )
    rows = rows.select("*", F.explode(F.when(F.col("is_left"), F.array(bucket)).otherwise(F.array(bucket - 1, bucket))).alias("bucket"))
    processor = TimeoutJoinProcessor(timeout_s)
    return (
        rows.withWatermark("ts", f"{delay_s} seconds")
        .select(_shard(shards), "*")
        .groupBy("shard", "bucket")
        .transformWithStateInPandas(processor, processor.output.format(key_type.simpleString()), "append", "eventTime")
        .select(whole("k", key), whole("id", row_id), F.when(F.col("matched"), F.col("matched_us")).alias("matched_us"), "matched")
    )


class WallClockFlush(StatefulProcessor):
    """Counts rows per key and emits the count ``after_ms`` of processing time after the first row."""

    def __init__(self, key: str, key_type: str, after_ms: int):
        self._key = key
        self._after = after_ms
        self.output = f"{key} {key_type}, n bigint"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        if self._count.exists():
            n = self._count.get()[0]
        else:
            n = 0
            self._handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self._after)
        self._count.update((n + sum(r["n"] for r in rows),))
        return iter(())

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self._count.exists():
            n = self._count.get()[0]
            self._count.clear()
            yield Row(**{self._key: key[0], "n": n})

    def close(self) -> None:
        pass


def stream_flush_counts(stream: DataFrame, key: str, after_ms: int) -> DataFrame:
    """Counts per key of the rows that came since the last flush; each task sends one row for each key of a batch.

    A timer is due at the first micro-batch that begins ``after_ms`` or more after the first row of a key.
    """
    processor = WallClockFlush(key, stream.schema[key].dataType.simpleString(), after_ms)
    cells = added_up(stream.select(key, F.lit(1).cast("bigint").alias("n")), [key])
    return cells.groupBy(key).transformWithState(processor, processor.output, "append", "processingTime")
