"""Validation, tagged outputs, partitioning and the dead-letter sink."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.operators.joins import lookup


# The messages of the three checks, which results have to match word by word.
MISSING = "missing field (region/amount)"
UNKNOWN = "unknown region '%s'"
NOT_POSITIVE = "non-positive amount %s"


def validate(rows: DataFrame, regions: DataFrame, code: str = "code", name: str = "name") -> DataFrame:
    """Check ``region`` and ``amount``; the first failing check names the ``_error``.

    Valid rows have a NULL error and their ``region_name``.
    """
    joined = lookup(rows, regions, "region", code, name, "__name")
    region, amount = F.col("region"), F.col("amount")
    error = (
        F.when(region.isNull() | amount.isNull(), F.lit(MISSING))
        .when(F.col("__name").isNull(), F.format_string(UNKNOWN, region))
        .when(amount <= 0, F.format_string(NOT_POSITIVE, amount.cast("string")))
    )
    return joined.withColumn("_error", error).withColumn(
        "region_name", F.when(F.col("_error").isNull(), F.col("__name"))
    ).drop("__name")


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("_error").isNull()).drop("_error")


def dead_letters(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("_error").isNotNull()).drop("region_name")


VALID, DEAD_LETTER = "valid", "dead_letter"


def with_tag(validated: DataFrame) -> DataFrame:
    """Name the output each row belongs to."""
    return validated.withColumn("tag", F.when(F.col("_error").isNull(), VALID).otherwise(DEAD_LETTER))


def write_tagged(tagged: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """All outputs in one pass over the rows, one folder per tag. Also fit for ``foreachBatch``."""
    tagged.write.mode(mode).partitionBy("tag").parquet(path)
    return path


def read_tagged(spark: SparkSession, path: str, schema, tag: str) -> DataFrame:
    """One output; only its folder is read."""
    return spark.read.schema(schema).parquet(path).where(F.col("tag") == tag).drop("tag")


def tier(value: Column, bounds: Sequence[float]) -> Column:
    """Index of the first bound above the value, ``len(bounds)`` if there is none."""
    index = F.lit(len(bounds))
    for i in range(len(bounds) - 1, -1, -1):
        index = F.when(value < bounds[i], F.lit(i)).otherwise(index)
    return index


def split(rows: DataFrame, part: Column, n: int) -> list[DataFrame]:
    """Exactly ``n`` frames, frame ``i`` holding the rows whose ``part`` is ``i``."""
    return [rows.where(part == i) for i in range(n)]


def write_dead_letters(validated: DataFrame, path: str) -> str:
    dead_letters(validated).write.mode("errorifexists").json(path)
    return path


def read_dead_letters(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Read them back for a replay; the schema is declared, never inferred."""
    return spark.read.schema(schema).json(path)
