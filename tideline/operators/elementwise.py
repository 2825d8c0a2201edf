"""Element-wise operators: map, flat-map, filter, batched enrichment, element metadata."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tideline.functions.numeric import US
from tideline.functions.text import words


def split_words(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per word token."""
    return df.select(F.explode(words(F.col(text))).alias("word"))


def score_and_keep(threshold: int, name: str = "city", qty: str = "qty") -> Callable[[DataFrame], DataFrame]:
    """Composite for ``df.transform``: add ``score = length(name) * qty``, keep scores from ``threshold``."""

    def apply(df: DataFrame) -> DataFrame:
        return df.withColumn("score", F.length(name) * F.col(qty)).where(F.col("score") >= threshold)

    return apply


def enrich_in_batches(
    df: DataFrame,
    open_client: Callable[[], object],
    enrich: Callable[[object, pa.RecordBatch], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """Enrich with a resource opened once per task and closed at its end.

    An Arrow batch is the unit of work. ``enrich`` must give the same output when a task is retried;
    writes to the outside belong into a sink keyed by row id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = open_client()
        try:
            for batch in batches:
                yield enrich(client, batch)
        finally:
            close = getattr(client, "close", None)
            if close is not None:
                close()

    return df.mapInArrow(run, schema)


def element_anatomy(df: DataFrame, window_s: int | None = None) -> DataFrame:
    """Expose what travels with each element: event time, window bounds (epoch seconds) and pane.

    Without ``window_s`` the element sits in the global window, which has no bounds. A pane is
    UNKNOWN, first and last as long as no trigger has fired.
    """
    ts_s = F.floor(F.col("ts_us") / US).cast("bigint")
    if window_s is None:
        start = end = F.lit(None).cast("bigint")
    else:
        start = ts_s - F.pmod(ts_s, F.lit(window_s))
        end = start + window_s
    return df.withColumns(
        {
            "event_s": ts_s,
            "window_start_s": start,
            "window_end_s": end,
            "timing": F.lit("UNKNOWN"),
            "pane_index": F.lit(0).cast("bigint"),
        }
    )
