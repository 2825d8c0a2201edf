"""Line-oriented text in and out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``line``."""
    return spark.read.text(path).withColumnRenamed("value", "line")


def stream_lines(spark: SparkSession, path: str) -> DataFrame:
    """The same as an unbounded source: lines of every new file under ``path``."""
    return spark.readStream.text(path).withColumnRenamed("value", "line")


def write_lines(lines: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Write a single string column as sharded text files; returns the folder."""
    lines.write.mode(mode).text(path)
    return path


def parse_records(lines: DataFrame, columns: Mapping[str, str], line: str = "line") -> DataFrame:
    """Header-less comma-separated lines to typed columns.

    Blank lines and lines starting with ``#`` are skipped, cells are trimmed, cells beyond the
    declared columns are dropped and missing ones are NULL. ``event_time`` is always DOUBLE; the
    other types are declared (SQL names), since a column has one type. Cells that do not fit their
    type become NULL and the column is listed in ``_unparsed``.
    """
    body = F.trim(F.col(line))
    cells = F.split(body, ",", -1)
    rows = lines.where((body != "") & ~body.startswith("#")).select(cells.alias("__cells"))
    types = {name: "double" if name == "event_time" else kind for name, kind in columns.items()}

    def cell(i: int) -> Column:
        return F.trim(F.get(F.col("__cells"), F.lit(i)))

    typed = [cell(i).try_cast(kind).alias(name) for i, (name, kind) in enumerate(types.items())]
    unparsed = F.filter(
        F.array(
            *[
                F.when(cell(i).isNotNull() & cell(i).try_cast(kind).isNull(), F.lit(name))
                for i, (name, kind) in enumerate(types.items())
            ]
        ),
        lambda name: name.isNotNull(),
    )
    return rows.select(*typed, unparsed.alias("_unparsed"))


def format_records(df: DataFrame, columns: list[str], line: str = "line") -> DataFrame:
    """The inverse for clean cells: one comma-separated line per row."""
    return df.select(F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias(line))
