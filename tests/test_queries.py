"""Every query against its SQL at the smallest scale."""

from __future__ import annotations

import re
from pathlib import Path

import __spark_entry__ as entry
import pytest
from check import compare, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES, SQL = dict(entry.QUERIES), dict(entry.ORACLES)


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


# The other streams take long and are compared by tests/check.py and on small stories in test_streaming.py.
STREAMED = ("stream_panes_accumulating", "stream_rate_limit", "kafka_shape_counts", "stream_late_counts", "rescale_counts", "restart_after_failure", "transactional_sink_counts", "stream_offset_range", "stream_flush_counts", "stream_watermark_min", "stream_watermark_min_idle")


@pytest.mark.parametrize("name", [n for n in QUERIES if QUERIES[n].__module__.endswith("batch") or n in STREAMED])
def test_query_equals_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES[name], SQL[name]) is None


def test_every_query_has_sql():
    assert QUERIES.keys() == SQL.keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_only_needed_columns_are_read(spark):
    plan = plan_of(QUERIES["combine_mean_custom"](spark, FOLDER))
    assert "ReadSchema: struct<l_suppkey:bigint,l_extendedprice:double>" in plan


def test_filters_reach_the_scan(spark):
    assert "PushedFilters: [IsNotNull(event_type), Not(EqualTo(event_type,error))]" in plan_of(
        QUERIES["batched_enrich"](spark, FOLDER)
    )


def test_top_n_is_not_a_global_sort(spark):
    for name in ("top_n_global", "sample_fixed_size"):
        assert "TakeOrderedAndProject" in plan_of(QUERIES[name](spark, FOLDER))


def test_groups_are_limited_before_the_shuffle(spark):
    for name in ("top_n_per_key", "rate_limit"):
        assert "WindowGroupLimit" in plan_of(QUERIES[name](spark, FOLDER))


def test_sums_combine_before_the_shuffle(spark):
    assert "partial_sum" in plan_of(QUERIES["window_fixed_sum"](spark, FOLDER))


def test_library_does_not_collect_or_cross_join():
    # The feed's slice totals are the only rows that reach the driver.
    for path in (Path(entry.__file__).parent / "tideline").rglob("*.py"):
        if "llm" in path.parts:  # optional, has its own tests
            continue
        source = path.read_text()
        assert not re.search(r"toPandas|localCheckpoint|crossJoin|\.rdd\b|mapPartitions", source), path
        assert source.count(".collect()") == (1 if path.name == "feed.py" else 0), path
