"""Watermarks over arrival slices.

A slice stands for a micro-batch. The watermark a row meets is the highest event time of all earlier
slices, less the allowed disorder; it is kept in a table with one row per slice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.numeric import US
from tideline.operators.scan import prefix_scan, range_buckets
from tideline.session import broadcast_if_small, settle


def window_end(ts_us: Column, size_s: int) -> Column:
    """End, in epoch microseconds, of the fixed window that holds the time."""
    size = size_s * US
    return ts_us - F.pmod(ts_us, F.lit(size)) + size


def slice_watermarks(df: DataFrame, disorder_s: int = 0) -> DataFrame:
    """Per slice: watermark before and after it, its first event time and its last arrival.

    Computed once and written; marked for broadcast if its row count allows.
    """
    spans = df.groupBy("slice").agg(
        F.max("ts_us").alias("max_ts_us"),
        F.min("ts_us").alias("min_ts_us"),
        F.max("arrival_us").alias("last_arrival_us"),
    )
    # The table has one row per slice, so this one-partition window stays small at any data size.
    seen = Window.partitionBy(F.lit(0)).orderBy("slice")
    lag = disorder_s * US
    before = F.max("max_ts_us").over(seen.rowsBetween(Window.unboundedPreceding, -1)) - lag
    after = F.max("max_ts_us").over(seen.rowsBetween(Window.unboundedPreceding, 0)) - lag
    table = spans.select(
        "slice",
        "min_ts_us",
        "last_arrival_us",
        before.alias("wm_before_us"),
        after.alias("wm_after_us"),
    )
    return broadcast_if_small(settle(table, "slices"))


def with_watermark(rows: DataFrame, slices: DataFrame) -> DataFrame:
    """Rows without an arrival slice stay, with no watermark."""
    return rows.join(slices.select("slice", "wm_before_us", "wm_after_us"), "slice", "left")


def with_status(rows: DataFrame, lateness_s: int, end: str = "win_end_us") -> DataFrame:
    """EARLY, ON_TIME, LATE or DROPPED, from the watermark the row meets; UNTIMED without a time or a slice."""
    end_us, before = F.col(end), F.col("wm_before_us")
    status = (
        F.when(end_us.isNull() | F.col("slice").isNull(), "UNTIMED")
        .when(before >= end_us + lateness_s * US, "DROPPED")
        .when(before >= end_us, "LATE")
        .when(F.col("wm_after_us") >= end_us, "ON_TIME")
        .otherwise("EARLY")
    )
    return rows.withColumn("status", status)


def fire_slices(slices: DataFrame, size_s: int) -> DataFrame:
    """For each window end the slice that moved the watermark past it, and that slice's last arrival.

    Each slice lists the window ends between its two watermarks, which makes the lookup an equi-join.
    """
    size = size_s * US
    first = F.coalesce(
        F.col("wm_before_us") - F.pmod("wm_before_us", F.lit(size)) + size,
        window_end(F.col("min_ts_us"), size_s),
    )
    last = F.col("wm_after_us") - F.pmod("wm_after_us", F.lit(size))
    return (
        slices.where(last >= first)
        .select(
            F.explode(F.sequence(first, last, F.lit(size))).alias("win_end_us"),
            F.col("slice").alias("fired_slice"),
            F.col("last_arrival_us").alias("fired_arrival_us"),
        )
    )


def closed_windows(df: DataFrame, key: str, size_s: int, slices: DataFrame) -> DataFrame:
    """Count per key and window under the default trigger: one result when the watermark passes the
    window end, late rows dropped. Windows still open at the end of input close there, with a NULL
    firing slice."""
    cells = (
        df.withColumn("win_end_us", window_end(F.col("ts_us"), size_s))
        .groupBy(key, "win_end_us", "slice")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    kept = with_status(with_watermark(cells, slices), lateness_s=0).where(
        F.col("status").isin("EARLY", "ON_TIME")
    )
    counts = kept.groupBy(key, "win_end_us").agg(F.sum("rows").alias("n"))
    return counts.join(fire_slices(slices, size_s), "win_end_us", "left")


def firing_trail(closed: DataFrame) -> DataFrame:
    """Seconds between the window end and the arrival that fired the window."""
    return closed.withColumn(
        "trail_s", F.floor((F.col("fired_arrival_us") - F.col("win_end_us")) / US).cast("bigint")
    )


def merged_watermark(
    df: DataFrame, channel: str, channels: Sequence[str], idle_aware: bool = False
) -> DataFrame:
    """Watermark (event-time microseconds) of an operator with several inputs, per slice.

    It is the minimum over the channels and waits (NULL) until every channel has been heard.
    A silent channel holds it back. With ``idle_aware`` a channel without rows in a slice is left
    out of that minimum; the result never moves back.
    """
    heard = df.groupBy("slice").agg(
        *[F.max(F.when(F.col(channel) == c, F.col("ts_us"))).alias(f"__m{i}") for i, c in enumerate(channels)]
    )
    seen = Window.partitionBy(F.lit(0)).orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    marks = heard.select(
        "slice",
        *[F.max(f"__m{i}").over(seen).alias(f"__w{i}") for i in range(len(channels))],
        *[f"__m{i}" for i in range(len(channels))],
    )
    ready = F.lit(True)
    for i in range(len(channels)):
        ready = ready & F.col(f"__w{i}").isNotNull()
    if idle_aware:
        parts = [F.when(F.col(f"__m{i}").isNotNull(), F.col(f"__w{i}")) for i in range(len(channels))]
        merged = F.max(F.when(ready, F.array_min(F.array(*parts)))).over(seen)
    else:
        merged = F.when(ready, F.array_min(F.array(*[F.col(f"__w{i}") for i in range(len(channels))])))
    return marks.select("slice", merged.alias("wm_us"))


def event_skew(df: DataFrame, row_id: str = "event_id", rows: int = 1 << 17) -> DataFrame:
    """``skew_us`` (arrival minus event time) and whether the row arrived behind a newer event.

    Rows are scanned in arrival order, in tasks of about ``rows`` rows."""
    order = ["arrival_us", row_id]
    scanned = prefix_scan(
        range_buckets(df, order, "__range", rows), keys=[], buckets=["__range"], order=order, peaks={"newest_us": F.col("ts_us")}
    )
    return scanned.withColumns(
        {
            "skew_us": F.col("arrival_us") - F.col("ts_us"),
            "out_of_order": F.coalesce(F.col("ts_us") < F.col("newest_us"), F.lit(False)),
        }
    ).drop("newest_us", "__range")
