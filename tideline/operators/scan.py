"""Running aggregates over ordered groups of any size.

A plain ``Window.partitionBy(key).orderBy(ts)`` puts a whole key into one task. Here each key is cut
into order-respecting buckets (for example arrival slice, then minute). Rows are scanned inside
their bucket; what came before the bucket is read from a table of bucket totals, which is aggregated
map-side and scanned level by level. No task sees more rows than one bucket, or than the sub-buckets
of one bucket.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.session import broadcast_if_small, settle


def prefix_scan(
    df: DataFrame,
    keys: Sequence[str],
    buckets: Sequence[str],
    order: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    peaks: Mapping[str, Column] | None = None,
    totals: Mapping[str, str] | None = None,
) -> DataFrame:
    """Add running columns to every row of ``df``, per ``keys`` and in bucket-then-``order`` order.

    ``sums[name]``: sum of the expression up to and including the row.
    ``peaks[name]``: maximum of the expression over the rows before it (NULL if none).
    ``totals[name]``: the final value of the named running sum for the whole key.
    ``buckets`` sort the same way as ``order`` (NULL first, as a bucket of its own) and go from coarse to fine.
    """
    sums, peaks, totals = dict(sums or {}), dict(peaks or {}), dict(totals or {})
    keys, buckets = list(keys), list(buckets)
    cells = {**sums, **peaks}
    # One struct stands for the key. It is never NULL, also if its fields are, so offsets are joined by
    # plain equality and the rows stay in the partitions the window has put them into.
    key = F.struct(*keys) if keys else F.lit(0)
    # The same holds for a bucket.
    held = {f"__b{i}": F.struct(b) for i, b in enumerate(buckets)}
    df = df.withColumns({"__k": key, **held, **{f"__c_{n}": e for n, e in cells.items()}})
    buckets = list(held)

    def total(name: str) -> Column:
        fold = F.sum if name in sums else F.max
        return fold(f"__c_{name}").alias(f"__c_{name}")

    def merge(name: str, a: Column, b: Column) -> Column:
        if name in sums:
            return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
        return F.greatest(a, b)

    level = df.groupBy("__k", *buckets).agg(*[total(n) for n in cells])
    offsets = None
    for depth in range(len(buckets) - 1, -1, -1):
        upper = ["__k", *buckets[:depth]]
        ahead = (
            Window.partitionBy(*upper)
            .orderBy(buckets[depth])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        here = level.select(
            *upper,
            buckets[depth],
            *[
                (F.sum if n in sums else F.max)(f"__c_{n}").over(ahead).alias(f"__o{depth}_{n}")
                for n in cells
            ],
            *[
                F.sum(f"__c_{n}").over(Window.partitionBy("__k")).alias(out)
                for out, n in totals.items()
                if depth == 0
            ],
        )
        if offsets is None:
            offsets = here
        else:
            offsets = offsets.join(here, [*upper, buckets[depth]])
        if depth:
            level = level.groupBy(*upper).agg(*[total(n) for n in cells])
    for name in cells:
        merged = F.col(f"__o0_{name}")
        for depth in range(1, len(buckets)):
            merged = merge(name, merged, F.col(f"__o{depth}_{name}"))
        offsets = offsets.withColumn(f"__p_{name}", merged)
    offsets = offsets.select("__k", *buckets, *totals, *[f"__p_{n}" for n in cells])

    inside = Window.partitionBy("__k", *buckets).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    local = df.withColumns(
        {
            f"__l_{n}": F.sum(f"__c_{n}").over(upto) if n in sums else F.max(f"__c_{n}").over(before)
            for n in cells
        }
    )
    joined = local.join(offsets, ["__k", *buckets])
    joined = joined.withColumns({n: merge(n, F.col(f"__p_{n}"), F.col(f"__l_{n}")) for n in cells})
    return joined.drop("__k", *buckets, *[f"__{tag}_{n}" for n in cells for tag in ("c", "l", "p")])


def range_buckets(df: DataFrame, order: Sequence[str], out: str, rows: int = 1 << 17, most: int = 20_000) -> DataFrame:
    """Add the scan bucket ``out``: ranges of ``order`` that hold about ``rows`` rows each, however dense the order is.

    There are as many as the rows need, at most ``most`` (they grow beyond ``rows`` then). Spark samples the
    bounds; the rows are written once, so that everything that reads them, a restarted task too, finds the same
    bucket. ``order`` should tell rows apart: equal ones share a bucket. Rows of a small table get bucket 0 unwritten.
    """
    parts = min(most, -(-df.count() // rows))
    if parts <= 1:
        return df.withColumn(out, F.lit(0))
    ranged = df.repartitionByRange(parts, *order)
    return settle(ranged.withColumn(out, F.spark_partition_id()), "ranges")


def bucket_hot_keys(df: DataFrame, key: str, bucket: Column, out: str, hot_rows: int) -> DataFrame:
    """Add the scan bucket ``out``: ``bucket`` for keys with more than ``hot_rows`` rows, 0 for all others.

    Ordinary keys then cost one plain window and no bucket totals. The hot keys, at most one per
    ``hot_rows`` rows of the table, are found by one count that combines before the shuffle.
    """
    counted = df.groupBy(F.col(key).alias("__hot")).agg(F.count(F.lit(1)).alias("__rows"))
    hot = settle(counted.where(F.col("__rows") > hot_rows), "hot")
    joined = df.join(broadcast_if_small(hot), F.col(key).eqNullSafe(F.col("__hot")), "left")
    chosen = F.when(F.col("__rows").isNotNull(), bucket).otherwise(F.lit(0).cast("bigint"))
    return joined.withColumn(out, chosen).drop("__hot", "__rows")
