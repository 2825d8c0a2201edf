"""Keyed and global aggregation."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tideline.functions import numeric
from tideline.session import broadcast_if_small, settle


def count_per_key(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def sum_per_key(df: DataFrame, value: str, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(numeric.total(F.col(value)).alias("total"))


def group_values(df: DataFrame, key: str, value: str, split_by: str, chunk: int = 10_000) -> DataFrame:
    """All values of each key, NULLs too, sorted, in lists of about ``chunk`` values.

    Columns: key, part, parts, ``total`` (values of the whole key) and ``values``. A key with up to
    ``chunk`` values is part 0 of 1. A larger one is dealt over ``ceil(total / chunk)`` rows by a
    hash of ``split_by`` (unique per row), so no single task or row holds a hot key; a part that gets
    no value has no row. The union of the parts is the whole group.
    """
    side = df.select(F.col(key), F.xxhash64(split_by).alias("__deal"), F.struct(F.col(value).alias("v")).alias("values"))
    return dealt_lists(side, key, ["values"], chunk).withColumnRenamed("values_total", "total")


def dealt_lists(rows: DataFrame, key: str, tags: list[str], chunk: int) -> DataFrame:
    """One list for each tag and part of a key, and ``<tag>_total`` over all its parts.

    A row has ``key``, the hash ``__deal`` and a struct of the value ``v`` under the tag it belongs to, NULL
    under all others. A NULL key is a key.
    """
    counts = rows.groupBy(F.col(key).alias("__key")).agg(*[F.count(t).alias(f"__n_{t}") for t in tags])
    most = F.greatest(*[f"__n_{t}" for t in tags]) if len(tags) > 1 else F.col(f"__n_{tags[0]}")
    counts = counts.withColumn("__parts", F.ceil(most / chunk).cast("bigint"))
    # Only keys above one chunk, at most one for every ``chunk`` rows; written once, so that beyond the
    # size of a broadcast the join has a plain shuffle on both sides, which AQE can split.
    large = settle(counts.where(F.col("__parts") > 1), "large-keys")
    joined = rows.join(broadcast_if_small(large), F.col(key).eqNullSafe(F.col("__key")), "left")
    parts = F.coalesce("__parts", F.lit(1).cast("bigint"))
    lists = [F.sort_array(F.collect_list(t)).alias(t) for t in tags]
    sizes = [F.max(f"__n_{t}").alias(f"__n_{t}") for t in tags]
    grouped = joined.groupBy(key, F.pmod("__deal", parts).alias("part"), parts.alias("parts")).agg(*lists, *sizes)
    totals = [F.coalesce(f"__n_{t}", F.size(t).cast("bigint")).alias(f"{t}_total") for t in tags]
    return grouped.select(key, "part", "parts", *totals, *[F.transform(t, lambda x: x["v"]).alias(t) for t in tags])


class MeanFn:
    """A mean as (sum, count): the smallest accumulator that merges in any order. NULLs are left out."""

    def create(self) -> tuple[float, int]:
        return 0.0, 0

    def add(self, acc: tuple[float, int], values: pa.Array) -> tuple[float, int]:
        return acc[0] + (pc.sum(values).as_py() or 0.0), acc[1] + len(values) - values.null_count

    def merge(self, accs: list[tuple[float, int]]) -> tuple[float, int]:
        return sum(a[0] for a in accs), sum(a[1] for a in accs)

    def extract(self, acc: tuple[float, int]) -> float | None:
        return acc[0] / acc[1] if acc[1] else None


def combine_per_key(
    df: DataFrame, key: str, value: str, fn: Any, out: str, out_type: str, max_keys: int = 100_000
) -> DataFrame:
    """Combine with any Python accumulator (``create / add / merge / extract``), in two phases.

    Each task folds its rows into at most about ``max_keys`` accumulators and emits them whenever
    that bound is reached, so the shuffle carries accumulators and not rows. ``add`` gets the values
    of one key in one Arrow batch as an Arrow array of any type (a struct for several columns), NULLs
    included. A NULL key is a key. The accumulator and the result (``out_type``, which may be
    composite) can be any value that pickles or that Arrow converts.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    one = df.schema[key].dataType
    packed = StructType([StructField(key, one), StructField("acc", BinaryType())])
    result = StructType([StructField(key, one)]).add(StructType.fromDDL(f"{out} {out_type}")[0])

    def batch_of(schema: StructType, *columns: list) -> pa.RecordBatch:
        arrow = to_arrow_schema(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        accs: dict[Any, Any] = {}

        def flush() -> pa.RecordBatch:
            done = batch_of(packed, list(accs), [pickle.dumps(a) for a in accs.values()])
            accs.clear()
            return done

        for batch in batches:
            coded = pc.dictionary_encode(batch.column(0), null_encoding="encode")
            found = coded.dictionary.to_pylist()
            order = pc.sort_indices(coded.indices)
            codes, values = coded.indices.take(order), batch.column(1).take(order)
            runs = pc.run_end_encode(codes) if len(codes) else None
            start = 0
            for code, stop in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()) if runs is not None else ():
                k = found[code]
                accs[k] = fn.add(accs[k] if k in accs else fn.create(), values.slice(start, stop - start))
                start = stop
            if len(accs) >= max_keys:
                yield flush()
        if accs:
            yield flush()

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Partials of a key follow each other, so one accumulator is held at a time.
        current, acc, started = None, None, False
        for batch in batches:
            keys, results = [], []
            for k, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = pickle.loads(raw)
                if started and (k == current or k != k and current != current):  # NaN is one key
                    acc = fn.merge([acc, part])
                    continue
                if started:
                    keys.append(current)
                    results.append(fn.extract(acc))
                current, acc, started = k, part, True
            if keys:
                yield batch_of(result, keys, results)
        if started:
            yield batch_of(result, [current], [fn.extract(acc)])

    return (
        df.select(key, value)
        .mapInArrow(partials, packed)
        .repartition(key)
        .sortWithinPartitions(key)
        .mapInArrow(final, result)
    )


def mean_per_key(df: DataFrame, value: str, *keys: str, digits: int = 4) -> DataFrame:
    """Mean from an explicit (sum, count) pair; Catalyst combines both before the shuffle."""
    return df.groupBy(*keys).agg(F.round(numeric.mean(F.col(value)), digits).alias("mean"))


def mean_per_key_builtin(df: DataFrame, value: str, *keys: str, digits: int = 4) -> DataFrame:
    return df.groupBy(*keys).agg(F.round(F.avg(value), digits).alias("mean"))


def top_n(df: DataFrame, n: int, by: str, tie: str) -> DataFrame:
    """The ``n`` largest rows; each task keeps only its own best ``n``."""
    return df.orderBy(F.desc(by), F.asc(tie)).limit(n)


def top_n_per_key(df: DataFrame, n: int, key: str, by: str, tie: str) -> DataFrame:
    """The ``n`` largest rows per key with their rank; Spark limits each group before the shuffle."""
    ranked = Window.partitionBy(key).orderBy(F.desc(by), F.asc(tie))
    return df.withColumn("rank", F.row_number().over(ranked).cast("bigint")).where(F.col("rank") <= n)


def sample_fixed_size(df: DataFrame, n: int, row_id: str, seed: str = "") -> DataFrame:
    """Exactly ``n`` rows (or all), chosen by a seeded hash of the id: repeatable, top-k cost."""
    mark: Column = F.md5(F.concat(F.col(row_id).cast("string"), F.lit(seed)))
    return df.withColumn("__mark", mark).orderBy("__mark", row_id).limit(n).drop("__mark")


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(*columns).dropDuplicates()
