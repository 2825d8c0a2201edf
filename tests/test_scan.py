from __future__ import annotations

from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from tideline.operators.scan import prefix_scan, range_buckets
from tideline.operators.watermarks import event_skew
from tideline.sources.arrivals import replay_order


def test_scan_equals_a_plain_window_also_for_a_hot_key(spark):
    df = spark.range(2_000).select(
        "id",
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.concat(F.lit("k"), F.col("id") % 10)).alias("k"),
        (F.col("id") * 7919 % 1000).alias("t"),
        (F.col("id") * 31 % 17 - 5).alias("v"),
    )
    bucketed = df.withColumns({"b1": F.floor(F.col("t") / 100), "b2": F.floor(F.col("t") / 10)})
    got = prefix_scan(
        bucketed, ["k"], ["b1", "b2"], ["t", "id"],
        sums={"s": F.col("v"), "n": F.lit(1)}, peaks={"p": F.col("v")}, totals={"all": "n"},
    ).select("id", "s", "n", "p", "all")
    w = Window.partitionBy("k").orderBy("t", "id")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    want = df.select(
        "id",
        F.sum("v").over(upto),
        F.count("*").over(upto),
        F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1)),
        F.count("*").over(Window.partitionBy("k")),
    )
    assert rows(got) == rows(want)


def test_scan_over_everything_has_no_window_over_all_rows(spark):
    df = spark.range(500).withColumns({"b": F.floor(F.col("id") / 20), "c": F.floor(F.col("id") / 5)})
    got = prefix_scan(df, [], ["b", "c"], ["id"], sums={"n": F.lit(1)})
    assert all(n == i + 1 for i, n in rows(got, "id", "n"))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    # Row-level windows are partitioned by both buckets; only bucket totals are scanned globally.
    assert any("__b0#" in w and "__b1#" in w for w in windows)


def test_rows_without_a_bucket_stay(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 1, 2), ("a", 2, 3), (None, None, 4), (None, 1, 5)], "k string, b long, id long")
    got = prefix_scan(df, ["k"], ["b"], ["b", "id"], sums={"n": F.lit(1)}, peaks={"before": F.col("id")})
    assert rows(got, "id", "n", "before") == [(1, 1, None), (2, 2, 1), (3, 3, 2), (4, 1, None), (5, 2, 4)]


def test_ranges_are_even_and_order_holds_also_within_one_microsecond(spark):
    # Two thirds of all rows arrive in one microsecond, some have no time.
    arrival = F.when(F.col("id") % 50 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.col("id") * 7919 % 1_000).otherwise(500)
    df = spark.range(6_000).select(F.col("id").alias("event_id"), arrival.cast("bigint").alias("arrival_us"), (F.col("id") * 31 % 977).alias("ts_us"))
    sizes = [n for (n,) in range_buckets(df, ["arrival_us", "event_id"], "b", 500).groupBy("b").count().select("count").collect()]
    assert len(sizes) >= 10 and max(sizes) <= 1_000 and sum(sizes) == 6_000
    w = Window.orderBy("arrival_us", "event_id")
    known = df.select("event_id", "ts_us", (F.row_number().over(w) - 1).alias("nth"), F.max("ts_us").over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("top"))
    want = {r["event_id"]: (r["nth"], r["top"] is not None and r["ts_us"] < r["top"]) for r in known.collect()}
    for size in (500, 1 << 17):
        late = event_skew(df, rows=size).select("event_id", "out_of_order")
        got = replay_order(df, rows=size).join(late, "event_id")
        assert {r["event_id"]: (r["arrival_seq"], r["out_of_order"]) for r in got.collect()} == want
