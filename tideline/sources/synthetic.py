"""Synthetic sensor events derived from clock ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events_from_ticks(ticks: DataFrame, cardinality: int = 3, lag_s: float = 0.0, secs: str = "secs") -> DataFrame:
    """Turn tick times (``secs``: epoch seconds, DOUBLE) into keyed, event-timed records."""
    seq = F.floor(F.col(secs)).cast("bigint")
    return ticks.select(
        F.concat(F.lit("sensor-"), (seq % cardinality).cast("string")).alias("key"),
        (seq % 100 + 1).alias("value"),
        (F.col(secs) - lag_s).alias("event_time"),
        seq.alias("seq"),
    )


def synthetic_batch(
    spark: SparkSession,
    start_s: float,
    events_per_s: float = 5.0,
    duration_s: float = 120.0,
    cardinality: int = 3,
    lag_s: float = 0.0,
) -> DataFrame:
    """The bounded form: one tick every ``1/events_per_s`` seconds for ``duration_s`` seconds."""
    ticks = spark.range(int(round(events_per_s * duration_s))).select(
        (F.lit(float(start_s)) + F.col("id") / F.lit(float(events_per_s))).alias("secs")
    )
    return events_from_ticks(ticks, cardinality, lag_s)


def synthetic_stream(
    spark: SparkSession, events_per_s: int = 5, cardinality: int = 3, lag_s: float = 0.0
) -> DataFrame:
    """The unbounded form over Spark's ``rate`` source, with ``ts`` ready for a watermark."""
    ticks = (
        spark.readStream.format("rate")
        .option("rowsPerSecond", events_per_s)
        .load()
        .select((F.unix_micros("timestamp") / 1e6).alias("secs"))
    )
    events = events_from_ticks(ticks, cardinality, lag_s)
    return events.withColumn("ts", F.timestamp_micros((F.col("event_time") * 1e6).cast("bigint")))
