from __future__ import annotations

import math

import pytest
from conftest import rows
from fixtures import CLICKS, MORE_CLICKS, READINGS
from pyspark.sql import functions as F

from tideline.operators import aggregate as agg
from tideline.operators import joins


@pytest.fixture(scope="module")
def readings(spark):
    data = [(i, *r) for i, r in enumerate(READINGS)]
    return spark.createDataFrame(data, "id bigint, sensor string, reading double")


MEANS = [("sensor-a", 23.0), ("sensor-b", 15.0), ("sensor-c", 100.0)]


def test_means_agree(readings):
    assert rows(agg.mean_per_key(readings, "reading", "sensor")) == MEANS
    assert rows(agg.mean_per_key_builtin(readings, "reading", "sensor")) == MEANS


@pytest.mark.parametrize("partitions", [1, 3, 9])
def test_custom_accumulator_does_not_depend_on_partitions(readings, partitions):
    out = agg.combine_per_key(
        readings.repartition(partitions), "sensor", "reading", agg.MeanFn(), "mean", "double", max_keys=2
    )
    assert rows(out) == MEANS


def test_custom_accumulator_with_null_keys_and_one_hot_key(spark):
    df = spark.range(3_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 7).cast("double").alias("v"),
    )
    got = dict(rows(agg.combine_per_key(df, "k", "v", agg.MeanFn(), "m", "double", max_keys=5)))
    want = dict(rows(df.groupBy("k").agg(F.avg("v"))))
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k]) for k in want)


def test_empty_mean_is_nan(readings):
    (only,) = rows(agg.mean_per_key(readings.where("false"), "reading"))
    assert math.isnan(only[0])


def test_count_top_sample_distinct(readings):
    assert rows(agg.count_per_key(readings)) == [(9,)]
    top = agg.top_n(readings, 3, by="reading", tie="id")
    assert [r["reading"] for r in top.collect()] == [102.0, 100.0, 100.0]
    per_key = agg.top_n_per_key(readings, 1, "sensor", by="reading", tie="id")
    assert rows(per_key, "sensor", "reading") == [("sensor-a", 25.0), ("sensor-b", 20.0), ("sensor-c", 102.0)]
    sample = agg.sample_fixed_size(readings, 4, "id", "x")
    assert sample.count() == 4
    assert rows(sample) == rows(agg.sample_fixed_size(readings.repartition(5), 4, "id", "x"))
    assert agg.sample_fixed_size(readings, 100, "id").count() == 9
    assert agg.distinct_rows(readings, "sensor").count() == 3


def test_group_values(spark):
    data = [(i, *r) for i, r in enumerate(CLICKS + MORE_CLICKS)]
    clicks = spark.createDataFrame(data, "id bigint, user string, path string")
    assert rows(agg.group_values(clicks, "user", "path", "id"), "user", "values") == [
        ("u1", ["/checkout", "/home", "/pricing"]),
        ("u2", ["/checkout", "/home"]),
        ("u3", ["/blog", "/docs/ch05"]),
        ("u4", ["/home"]),
    ]


def test_group_values_splits_a_hot_key_and_loses_nothing(spark):
    df = spark.range(1_000).select("id", F.when(F.col("id") < 600, "hot").otherwise("cold").alias("k"))
    parts = agg.group_values(df, "k", "id", "id", chunk=50)
    assert parts.agg(F.max(F.size("values"))).first()[0] <= 100
    assert {r[0] for r in parts.where("k = 'hot'").select("parts").collect()} == {12}
    assert {r[0] for r in parts.where("k = 'hot'").select("total").collect()} == {600}
    assert rows(parts.select("k", F.explode("values"))) == rows(df, "k", "id")


def test_union_keeps_duplicates(spark):
    df = spark.createDataFrame([("a",)], "x string")
    assert joins.union_all(df, df, df).count() == 3


def test_group_values_splits_null_keys_and_ids_in_step_with_the_parts(spark):
    df = spark.range(1_000).select((F.col("id") * 10).alias("id"), F.lit(None).cast("string").alias("k"), F.when(F.col("id") > 4, F.col("id")).alias("v"))
    parts = agg.group_values(df, "k", "v", "id", chunk=100)
    assert parts.count() == 10 and parts.agg(F.max(F.size("values"))).first()[0] <= 200
    assert rows(parts.select(F.explode("values"))) == rows(df, "v")  # NULL values too


def test_cogroup_of_a_split_key_never_looks_absent(spark):
    clicks = spark.createDataFrame([(i, "u", f"/{i}") for i in range(6)] + [(9, None, "/n")], "id bigint, user string, path string")
    profiles = spark.createDataFrame([(1, "u", "Ada"), (2, None, "Nil"), (3, "w", "Bo")], "id bigint, user string, name string")
    out = joins.cogroup_lists({"c": (clicks, "user", "path", "id"), "p": (profiles, "user", "name", "id")}, "k", chunk=2).collect()
    assert {(r.k, r.parts, r.c_total, r.p_total) for r in out} == {("u", 3, 6, 1), (None, 1, 1, 1), ("w", 1, 0, 1)}
    assert sorted(v for r in out if r.k == "u" for v in r.c) == [f"/{i}" for i in range(6)]
    assert [v for r in out if r.k == "u" for v in r.p] == ["Ada"]
    (null,) = [r for r in out if r.k is None]
    assert (null.c, null.p) == (["/n"], ["Nil"])


def test_custom_accumulators_on_arrow(spark):
    class Span:
        """Smallest and largest of a struct's fields: a composite input and output."""

        def create(self):
            return None

        def add(self, acc, values):
            return self.merge([acc, *[(v["a"], v["b"]) for v in values.to_pylist() if v]])

        def merge(self, accs):
            some = [a for a in accs if a]
            return (min(a for a, _ in some), max(b for _, b in some)) if some else None

        def extract(self, acc):
            return acc and {"low": acc[0], "high": acc[1]}

    keys = [2**53, 2**53 + 1, None]
    df = spark.createDataFrame([(k, {"a": i, "b": -i}) for i, k in enumerate(keys * 3)], "k bigint, s struct<a: bigint, b: bigint>")
    got = agg.combine_per_key(df, "k", "s", Span(), "span", "struct<low: bigint, high: bigint>").collect()
    assert {(r.k, r.span.low, r.span.high) for r in got} == {(2**53, 0, 0), (2**53 + 1, 1, -1), (None, 2, -2)}
    one = spark.createDataFrame([("x", 1.0), ("x", None), ("x", 0.004)], "k string, v double").repartition(3)
    (mean,) = rows(agg.combine_per_key(one, "k", "v", agg.MeanFn(), "m", "double"))
    assert mean == ("x", 0.502) and rows(agg.mean_per_key(one, "v", "k")) == [mean]
    assert rows(agg.sum_per_key(one, "v", "k")) == [("x", 1.004)]
