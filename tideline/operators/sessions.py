"""Bounded twins of the stateful operators: sessions, first-seen, rate limit, join with timeout."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tideline.functions.numeric import US
from tideline.operators.scan import bucket_hot_keys, prefix_scan


def _time_bucket(width_s: int):
    return F.floor(F.col("ts_us") / (width_s * US)).cast("bigint")


def session_summaries(
    df: DataFrame,
    key: str,
    gap_s: int,
    burst: int,
    value: str = "value",
    row_id: str = "event_id",
    sample: int = 5,
    bucket_s: int = 300,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Per session: row count, last event time, the first ``sample`` values, and ``BURST`` or ``ok``.

    A row within ``gap_s`` of the previous one (an exact gap included) belongs to its session. Keys with
    more than ``hot_rows`` rows are scanned in buckets of ``bucket_s`` seconds.
    """
    rows = df.select(key, "ts_us", F.col(row_id).alias("__id"), F.col(value).alias("__v"))
    rows = bucket_hot_keys(rows, key, _time_bucket(bucket_s), "__b", hot_rows)
    order = ["ts_us", "__id"]
    numbered = prefix_scan(
        rows, [key], ["__b"], order, sums={"__n": F.lit(1).cast("bigint")}, peaks={"__prev": F.col("ts_us")}
    )
    opens = F.col("__prev").isNull() | (F.col("ts_us") - F.col("__prev") > gap_s * US)
    marked = numbered.withColumns(
        {"__open_us": F.when(opens, F.col("ts_us")), "__open_n": F.when(opens, F.col("__n"))}
    )
    # Both openings only ever grow along a key, so the latest one is the highest one.
    placed = prefix_scan(
        marked, [key], ["__b"], order,
        peaks={"__since_us": F.col("__open_us"), "__since_n": F.col("__open_n")},
    ).withColumn("start_us", F.coalesce("__open_us", "__since_us"))
    place = F.col("__n") - F.coalesce("__open_n", "__since_n")
    # One maximum per place instead of a collected list keeps the aggregate in generated code.
    firsts = [F.max(F.when(place == i, F.col("__v"))).alias(f"__s{i}") for i in range(sample)]
    grouped = placed.groupBy(key, "start_us").agg(
        F.count(F.lit(1)).alias("events"), F.max("ts_us").alias("ended_us"), *firsts
    )
    taken = F.slice(F.array(*[f"__s{i}" for i in range(sample)]), F.lit(1), F.least(F.col("events"), F.lit(sample)).cast("int"))
    return grouped.select(
        key,
        "start_us",
        "events",
        "ended_us",
        taken.alias("sample_values"),
        F.when(F.col("events") >= burst, "BURST").otherwise("ok").alias("flag"),
    )


def first_seen(df: DataFrame, keys: list[str], row_id: str = "event_id") -> DataFrame:
    """The first row to arrive for each key combination."""
    return df.groupBy(*keys).agg(F.min(F.struct("arrival_us", row_id)).alias("__f")).select(
        *keys, F.col(f"__f.{row_id}").alias(row_id), F.col("__f.arrival_us").alias("arrival_us")
    )


def rate_limit(df: DataFrame, key: str, limit: int, period_s: int, row_id: str = "event_id") -> DataFrame:
    """The rows a limiter lets through: per key and period the first ``limit`` in event order."""
    period = F.floor(F.col("ts_us") / (period_s * US)).cast("bigint")
    ranked = Window.partitionBy(key, "period").orderBy("ts_us", row_id)
    return (
        df.withColumn("period", period)
        .withColumn("nth", F.row_number().over(ranked).cast("bigint"))
        .where(F.col("nth") <= limit)
    )


def join_with_timeout(
    left: DataFrame,
    right: DataFrame,
    key: str,
    timeout_s: int,
    row_id: str = "event_id",
    bucket_s: int = 300,
    hot_rows: int = 1_000_000,
) -> DataFrame:
    """Each left row with the first right row of its key in the ``timeout_s`` seconds from it on,
    or unmatched.

    Both sides are scanned together backwards in time, so pairs are never formed: the next right
    time is the running minimum over later rows. At equal times a right row counts as "from it on".
    """
    sides = left.select(key, "ts_us", row_id, F.lit(1).alias("__side")).unionByName(
        right.select(key, "ts_us", row_id, F.lit(0).alias("__side"))
    )
    back = bucket_hot_keys(
        sides.withColumn("__back", -F.col("ts_us")), key, -_time_bucket(bucket_s), "__b", hot_rows
    )
    scanned = prefix_scan(
        back, [key], ["__b"], ["__back", "__side", row_id],
        peaks={"__next": F.when(F.col("__side") == 0, -F.col("ts_us"))},
    )
    matched_us = F.when(-F.col("__next") - F.col("ts_us") <= timeout_s * US, -F.col("__next"))
    return scanned.where(F.col("__side") == 1).select(
        key, row_id, "ts_us", matched_us.alias("matched_us"), matched_us.isNotNull().alias("matched")
    )
