"""Reading the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideline.session import prepare
from tideline.sources.arrivals import ArrivalModel, SIX_HOURLY, with_arrival, with_event_time


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def events(spark: SparkSession, folder: str) -> DataFrame:
    """``events`` with event time as TIMESTAMP ``ts`` and as ``ts_us``."""
    return with_event_time(table(spark, folder, "events"))


def arriving(spark: SparkSession, folder: str, model: ArrivalModel = SIX_HOURLY) -> DataFrame:
    """``events`` with their arrival time and slice."""
    return with_arrival(events(spark, folder), model)
