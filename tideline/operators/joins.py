"""Co-grouping, enrichment, unions and side inputs."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.operators.aggregate import dealt_lists
from tideline.session import broadcast_if_small


def cogroup_lists(
    sides: Mapping[str, tuple[DataFrame, str, str, str]], key: str, chunk: int = 10_000
) -> DataFrame:
    """Per key one list per tagged input, next to ``<tag>_total``: 0 only if that input lacks the key.

    ``sides[tag] = (frame, key column, value column, unique row id)``. A key with more than ``chunk``
    values on one side continues in further rows (``part`` of ``parts``), as in ``group_values``; a
    list can then be empty in one part while its total is not 0. A NULL key is one group of all sides.
    """
    tagged = [
        df.select(F.col(k).alias(key), F.xxhash64(row_id).alias("__deal"), F.struct(F.col(v).alias("v")).alias(tag))
        for tag, (df, k, v, row_id) in sides.items()
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    return dealt_lists(rows, key, list(sides), chunk)


def left_enrich(
    rows: DataFrame, dimension: DataFrame, key: str, first_by: str, defaults: Mapping[str, Any]
) -> DataFrame:
    """Every row once, with the attributes of its key's first dimension row, or the defaults.

    ``defaults`` names the attributes taken over; "first" is the lowest ``first_by``.
    """
    picked = dimension.groupBy(key).agg(
        F.min_by(F.struct(*defaults), first_by).alias("__dim"),
    )
    joined = rows.join(picked, key, "left")
    return joined.withColumns(
        {c: F.coalesce(F.col(f"__dim.{c}"), F.lit(d)) for c, d in defaults.items()}
    ).drop("__dim")


def union_all(*frames: DataFrame) -> DataFrame:
    """Concatenate frames of one type; duplicates stay, nothing is shuffled."""
    return reduce(DataFrame.unionByName, frames)


def lookup(rows: DataFrame, table: DataFrame, key: str, table_key: str, value: str, out: str) -> DataFrame:
    """Side input as dictionary: ``table[key]`` per row, NULL where the key is unknown.

    The table must have unique keys, and is broadcast only below a checked size.
    """
    repeated = table.groupBy(table_key).count().where("count > 1").limit(1)
    if not repeated.isEmpty():
        raise ValueError(f"{table_key} is not unique in the lookup table")
    side = broadcast_if_small(table.select(F.col(table_key).alias("__k"), F.col(value).alias(out)))
    return rows.join(side, F.col(key) == F.col("__k"), "left").drop("__k")


def singleton(table: DataFrame) -> Column:
    """Side input of one value: the single cell of a one-row frame, as a scalar subquery."""
    return table.scalar()


def keep_listed(rows: DataFrame, listed: DataFrame, key: str, keep: bool = True) -> DataFrame:
    """Side input as list: rows whose key is (or with ``keep=False`` is not) in ``listed``."""
    side = broadcast_if_small(listed.select(key))
    return rows.join(side, key, "left_semi" if keep else "left_anti")
