"""Panes on a stream: one stateful processor per (key, window).

Spark has one watermark delay, which would both postpone firing and limit lateness. The delay is set
to window size plus allowed lateness, so the engine never drops a row whose window is alive, and the
processor works with the undelayed watermark. Rows of a micro-batch wait until the next one shows how
far the watermark has moved, because that decides between an early and the on-time pane.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StructField, StructType

from tideline.functions.numeric import US
from tideline.operators.panes import Early, units
from tideline.operators.watermarks import window_end
from tideline.streaming.sessions import plain, whole

_STATE = "total bigint, held bigint, held_n bigint, next_index bigint, fired boolean, counting boolean, early_panes bigint, wm bigint"


class PaneProcessor(StatefulProcessor):
    """State: what is in the window so far (``window``) and the rows of the last micro-batch
    (``waiting``). Amounts are whole units (``units``). Rows travel and wait as blocks of the columns
    arrival, id, amount, and the panes they fire are found by position in their order."""

    output = "k {}, no_k boolean, win_end_us bigint, pane_index bigint, timing string, amount bigint"

    def __init__(self, size_s: int, lateness_s: int, early: Early | None, late: str, accumulating: bool):
        self._delay_us = (size_s + lateness_s) * US
        self._lateness_us = lateness_s * US
        self._early = early
        self._late = late
        self._accumulating = accumulating

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._window = handle.getValueState("window", _STATE)
        self._waiting = handle.getListState("waiting", "data binary")

    def _load(self) -> dict[str, Any]:
        names = [c.split()[0] for c in _STATE.split(", ")]
        values = self._window.get() if self._window.exists() else (0, 0, 0, 0, False, True, 0, None)
        return dict(zip(names, values))

    def _now(self, timers) -> int | None:
        """Undelayed watermark in microseconds; None before the first rows have moved it."""
        ms = timers.getCurrentWatermarkInMs()
        return ms * 1_000 + self._delay_us if ms > 0 else None

    def _panes(self, key: tuple, st: dict[str, Any], timing: str, deltas: np.ndarray) -> pd.DataFrame:
        """One pane for each delta, in this order."""
        totals = st["total"] + np.cumsum(deltas)
        indexes = np.arange(st["next_index"], st["next_index"] + len(deltas))
        st["total"], st["next_index"] = int(totals[-1]), int(indexes[-1]) + 1
        return pd.DataFrame(
            {
                "k": [key[0]] * len(deltas),
                "no_k": bool(key[1]),
                "win_end_us": key[2],
                "pane_index": indexes,
                "timing": timing,
                "amount": totals if self._accumulating else deltas,
            }
        )

    def _early_deltas(self, st: dict[str, Any], amounts: np.ndarray) -> np.ndarray:
        """What the early panes add that the rows of one slice fire, which are certainly early."""
        how, m = self._early, len(amounts)
        sums = st["held"] + np.cumsum(amounts)
        left = m if how is None or how.repeat else max(0, (2 if how.kind == "each" else 1) - st["early_panes"])
        # Rows after which the trigger fires, counted from 0.
        at = np.zeros(0, dtype=np.int64)
        if how is not None and (how.kind in ("count", "any") or (how.kind == "each" and st["counting"])):
            at = np.arange(max(how.n - st["held_n"], 1) - 1, m, how.n)[: min(left, 1) if how.kind == "each" else left]
            st["counting"] = st["counting"] and not len(at)
        held_n = m - 1 - int(at[-1]) if len(at) else st["held_n"] + m
        if how is not None and held_n and (how.repeat or len(at) < left):
            tick = how.kind in ("slice", "any") or (how.kind == "all" and held_n >= how.n)
            if tick or (how.kind == "each" and not st["counting"]):
                st["counting"] = True
                at, held_n = np.r_[at, m - 1], 0
        st["early_panes"] += len(at)
        st["held"], st["held_n"] = int(sums[-1]) - (int(sums[at[-1]]) if len(at) else 0), held_n
        return np.diff(sums[at], prepend=0)

    def _advance(self, key: tuple, st: dict[str, Any], now: int | None) -> Iterator[pd.DataFrame]:
        """What the watermark reached by the last micro-batch makes due."""
        if now is None or now == st["wm"]:
            return
        amounts = _in_order([r[0] for r in self._waiting.get()] if self._waiting.exists() else [])
        self._waiting.clear()
        if now < key[2]:
            if len(amounts):
                deltas = self._early_deltas(st, amounts)
                if len(deltas):
                    yield self._panes(key, st, "EARLY", deltas)
            return
        if not st["fired"] and st["wm"] is not None:
            delta = st["held"] + int(amounts.sum())
            st["held"], st["held_n"], st["fired"] = 0, 0, True
            yield self._panes(key, st, "ON_TIME", np.array([delta], dtype=np.int64))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        st, now = self._load(), self._now(timerValues)
        yield from self._advance(key, st, now)
        end = key[2]
        blocks = [block for frame in rows for block in frame["block"]]
        if now is not None and now >= end + self._lateness_us:
            # The timer that ends the window comes next and must not fire its panes again.
            if self._window.exists():
                self._save(st)
            return
        if now is not None and now >= end:
            amounts = _in_order(blocks)
            late = amounts.sum(keepdims=True) if self._late == "per_slice" else amounts
            yield self._panes(key, st, "LATE", late)
            self._save(st)
        else:
            self._waiting.appendList([(bytes(block),) for block in blocks])
            st["wm"] = now if now is not None else -1
            self._save(st)
            spark_ms = timerValues.getCurrentWatermarkInMs()
            self._handle.registerTimer(spark_ms + 1)
            self._handle.registerTimer((end - self._delay_us) // 1_000)
        self._handle.registerTimer((end + self._lateness_us - self._delay_us) // 1_000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        if not self._window.exists():
            return
        st, now = self._load(), self._now(timerValues)
        yield from self._advance(key, st, now)
        if now is not None and now >= key[2] + self._lateness_us:
            self._window.clear()
            self._waiting.clear()
        else:
            self._save(st)

    def _save(self, st: dict[str, Any]) -> None:
        self._window.update(tuple(st.values()))

    def close(self) -> None:
        pass


def _in_order(blocks: list[bytes]) -> np.ndarray:
    """The amounts of the rows in ``blocks`` in order of arrival and id."""
    rows = np.concatenate([np.zeros((3, 0), dtype="<i8"), *(np.frombuffer(b, dtype="<i8").reshape(3, -1) for b in blocks)], axis=1)
    arrival, ids, amounts = rows
    return amounts[np.lexsort((amounts, ids, arrival))]


_KEYS = ["k", "no_k", "win_end_us"]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each key and window of an Arrow batch, with its newest time and its rows as one block.

    The engine drops rows by that time. What it would have dropped among older rows the processor drops as
    well, since the delay covers window and lateness.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        numbers = pa.array(np.arange(table.num_rows))
        groups = table.append_column("row", numbers).group_by(_KEYS).aggregate([("ts", "max"), ("row", "list")])
        columns = [table.column(c).fill_null(0).to_numpy() for c in ("arrival_us", "id", "amount")]
        matrix = np.stack(columns).astype("<i8")
        lists = groups.column("row_list").combine_chunks()
        places, ends = lists.flatten().to_numpy(), np.cumsum(lists.value_lengths().to_numpy())
        made = [np.ascontiguousarray(matrix[:, places[a:b]]).tobytes() for a, b in zip(np.r_[0, ends[:-1]], ends)]
        out = groups.select([*_KEYS, "ts_max"]).rename_columns([*_KEYS, "ts"]).append_column("block", pa.array(made, pa.binary()))
        yield from out.combine_chunks().to_batches()


def _combine_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the rows of each (key, window) inside an Arrow batch, before the shuffle."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        summed = table.group_by(_KEYS).aggregate(
            [("ts", "max"), ("arrival_us", "max"), ("id", "max"), ("amount", "sum")]
        )
        yield from summed.select([*_KEYS, "ts_max", "arrival_us_max", "id_max", "amount_sum"]).rename_columns(
            table.column_names
        ).combine_chunks().to_batches()


def stream_panes(
    stream: DataFrame,
    key: str,
    value: str,
    size_s: int,
    lateness_s: int,
    early: Early | None = None,
    late: str = "per_element",
    accumulating: bool = True,
    row_id: str = "event_id",
    digits: int = 6,
) -> DataFrame:
    """Panes of a stream of arrival slices; columns as in the batch form but for ``is_first/is_last``.

    When no trigger looks at single rows, rows are added up in each task first, so a hot key sends the
    processor one row per task. Otherwise all rows of a key and window go through one task, in order, as
    blocks of numbers of one Arrow batch each.
    Event times must be later than 1970 by more than ``size_s + lateness_s``, since a Spark watermark is
    never negative.
    """
    key_type = stream.schema[key].dataType
    rows = stream.where(F.col("ts").isNotNull()).select(
        *plain(F.col(key), key_type, "k"),
        window_end(F.unix_micros("ts"), size_s).alias("win_end_us"),
        "ts",
        "arrival_us",
        F.col(row_id).cast("bigint").alias("id"),
        units(F.col(value), digits).alias("amount"),
    )
    if late == "per_slice" and (early is None or early.kind == "slice"):
        rows = rows.mapInArrow(_combine_rows, rows.schema)
    shape = StructType([*[rows.schema[c] for c in (*_KEYS, "ts")], StructField("block", BinaryType())])
    processor = PaneProcessor(size_s, lateness_s, early, late, accumulating)
    fired = (
        rows.mapInArrow(_blocks, shape)
        .withWatermark("ts", f"{size_s + lateness_s} seconds")
        .groupBy(*_KEYS)
        .transformWithStateInPandas(processor, processor.output.format(key_type.simpleString()), "append", "eventTime")
    )
    return fired.select(
        whole("k", key), "win_end_us", "pane_index", "timing", (F.col("amount") / F.lit(10.0**digits)).alias("value")
    )
