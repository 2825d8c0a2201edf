"""Processing time as data: when each row arrives and in which slice.

Batch and streaming queries then see the same arrival order and give the same answer on every run.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.numeric import US
from tideline.operators.scan import prefix_scan, range_buckets


@dataclass(frozen=True)
class ArrivalModel:
    """Delay per row id, in seconds: a few stuck rows, some slow ones, a small spread for the rest."""

    slice_s: int = 21_600
    stuck_every: int = 97
    stuck_s: int = 259_200
    slow_every: int = 13
    slow_s: int = 32_400
    spread: int = 11
    step_s: int = 600

    def delay_s(self, row_id: Column) -> Column:
        return (
            F.when(row_id % self.stuck_every == 0, self.stuck_s)
            .when(row_id % self.slow_every == 0, self.slow_s)
            .otherwise((row_id * 31 % self.spread) * self.step_s)
            .cast("bigint")
        )


# Slices of six hours for the batch queries.
SIX_HOURLY = ArrivalModel()
# Slices of three days for the streaming ones, which make one micro-batch of each.
COARSE = ArrivalModel(slice_s=259_200)
# The same with delays long enough to miss three-day windows: late by 90 hours, lost by 12 days.
TARDY = ArrivalModel(slice_s=259_200, stuck_s=1_036_800, slow_s=324_000)


def with_event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Event time as TIMESTAMP and as epoch microseconds (``ts_us``)."""
    df = df.withColumn(ts, F.col(ts).cast("timestamp"))
    return df.withColumn("ts_us", F.unix_micros(ts))


def with_arrival(df: DataFrame, model: ArrivalModel = SIX_HOURLY, row_id: str = "event_id") -> DataFrame:
    """Add ``arrival_us`` and ``slice``; needs ``ts_us``."""
    df = df.withColumn("arrival_us", F.col("ts_us") + model.delay_s(F.col(row_id)) * US)
    return df.withColumn("slice", F.floor(F.col("arrival_us") / (model.slice_s * US)).cast("bigint"))


def with_arrival_minute(df: DataFrame) -> DataFrame:
    """``arrival_min``: the bucket that keeps ordered scans inside a slice small."""
    return df.withColumn("arrival_min", F.floor(F.col("arrival_us") / (60 * US)).cast("bigint"))


def replay_order(df: DataFrame, row_id: str = "event_id", rows: int = 1 << 17) -> DataFrame:
    """Number the rows in arrival order from 0 (``arrival_seq``), in tasks of about ``rows`` rows."""
    order = ["arrival_us", row_id]
    scanned = prefix_scan(
        range_buckets(df, order, "__range", rows), keys=[], buckets=["__range"], order=order, sums={"arrival_seq": F.lit(1).cast("bigint")}
    )
    return scanned.withColumn("arrival_seq", F.col("arrival_seq") - 1).drop("__range")
