"""Event-time windows: one counting and summing pipeline for every window kind."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions import numeric
from tideline.functions.numeric import US


@dataclass(frozen=True)
class Windowing:
    """How to assign windows. Sizes in seconds; see the constructors below."""

    kind: str
    size_s: int = 0
    period_s: int = 0
    strict: bool = False

    def column(self, ts: str = "ts") -> Column | None:
        """The grouping expression, or None for the global window."""
        if self.kind == "fixed":
            return F.window(ts, f"{self.size_s} seconds")
        if self.kind == "sliding":
            return F.window(ts, f"{self.size_s} seconds", f"{self.period_s} seconds")
        if self.kind == "session":
            # Timestamps are whole microseconds, so "next < end" is "next <= end - 1 microsecond".
            gap_us = self.size_s * US - (1 if self.strict else 0)
            return F.session_window(ts, f"{gap_us} microseconds")
        return None

    def bounds(self) -> dict[str, Column]:
        """Start and end in epoch microseconds of the grouped window column ``w``."""
        if self.kind == "global":
            return {c: F.lit(None).cast("bigint") for c in ("win_start_us", "win_end_us")}
        end = F.unix_micros("w.end") + (1 if self.strict else 0)
        return {"win_start_us": F.unix_micros("w.start"), "win_end_us": end}


def fixed(size_s: int) -> Windowing:
    return Windowing("fixed", size_s)


def sliding(size_s: int, period_s: int) -> Windowing:
    return Windowing("sliding", size_s, period_s)


def session(gap_s: int, strict: bool = False) -> Windowing:
    """Sessions end after ``gap_s`` without events. An event exactly at the gap joins, or with
    ``strict`` opens the next session."""
    return Windowing("session", gap_s, strict=strict)


def global_window() -> Windowing:
    return Windowing("global")


def aggregate_windows(df: DataFrame, key: str, windowing: Windowing, **aggregates: Column) -> DataFrame:
    """Aggregate per key and window. Works on static frames and on streams with a watermark."""
    window = windowing.column()
    grouping = [F.col(key)] if window is None else [F.col(key), window.alias("w")]
    grouped = df.groupBy(*grouping).agg(*[e.alias(n) for n, e in aggregates.items()])
    bounds = windowing.bounds()
    return grouped.select(key, *[e.alias(n) for n, e in bounds.items()], *aggregates)


def count_windows(df: DataFrame, key: str, windowing: Windowing) -> DataFrame:
    return aggregate_windows(df, key, windowing, n=F.count(F.lit(1)))


def sum_windows(df: DataFrame, key: str, windowing: Windowing, value: str) -> DataFrame:
    return aggregate_windows(df, key, windowing, total=numeric.total(F.col(value)))
