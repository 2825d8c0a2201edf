from __future__ import annotations

import pytest
from conftest import rows
from fixtures import CLICKS, MORE_CLICKS, ORDERS, PROFILES, REGIONS
from pyspark.sql import functions as F

from tideline.operators import joins, routing
from tideline.session import broadcast_if_small, shared_dir


@pytest.fixture(scope="module")
def clicks(spark):
    data = [(i, *r) for i, r in enumerate(CLICKS + MORE_CLICKS)]
    return spark.createDataFrame(data, "id bigint, user_id string, path string")


@pytest.fixture(scope="module")
def profiles(spark):
    data = [(i, *r) for i, r in enumerate(PROFILES)]
    return spark.createDataFrame(data, "id bigint, user_id string, name string, plan string")


@pytest.fixture(scope="module")
def validated(spark):
    orders = spark.createDataFrame(ORDERS, "id string, region string, amount double")
    return routing.validate(orders, spark.createDataFrame(REGIONS, "code string, name string"))


def test_cogroup(clicks, profiles):
    grouped = joins.cogroup_lists(
        {"clicks": (clicks, "user_id", "path", "id"), "profile": (profiles, "user_id", "name", "id")}, "user"
    )
    assert rows(grouped, "user", "clicks", "profile") == [
        ("u1", ["/checkout", "/home", "/pricing"], ["Ada"]),
        ("u2", ["/checkout", "/home"], ["Linus"]),
        ("u3", ["/blog", "/docs/ch05"], ["Grace"]),
        ("u4", ["/home"], []),
    ]


def test_left_enrich_takes_the_first_profile(spark, clicks, profiles):
    second = spark.createDataFrame([(9, "u1", "Zoe", "free"), (10, "u9", "Nobody", "pro")], profiles.schema)
    out = joins.left_enrich(
        clicks, profiles.unionByName(second), "user_id", "id", {"name": "<unknown>", "plan": "n/a"}
    )
    assert out.count() == 8
    assert rows(out.groupBy("user_id", "name", "plan").count()) == [
        ("u1", "Ada", "pro", 3), ("u2", "Linus", "free", 2), ("u3", "Grace", "pro", 2), ("u4", "<unknown>", "n/a", 1),
    ]


def test_side_inputs(spark, clicks):
    mean = joins.singleton(clicks.agg(F.avg("id")))
    assert rows(clicks.where(F.col("id") > mean), "id") == [(4,), (5,), (6,), (7,)]
    listed = spark.createDataFrame([("u1",), ("u1",), ("u4",)], "user_id string")
    assert joins.keep_listed(clicks, listed, "user_id").count() == 4
    assert joins.keep_listed(clicks, listed, "user_id", keep=False).count() == 4


def test_lookup_needs_unique_keys(spark, clicks):
    table = spark.createDataFrame([("u1", "a"), ("u1", "b")], "k string, v string")
    with pytest.raises(ValueError):
        joins.lookup(clicks, table, "user_id", "k", "v", "out")


def test_validate(validated):
    assert rows(routing.valid_rows(validated), "id", "region_name") == [
        ("o1", "US East"), ("o2", "EU Central"), ("o3", "AP South"), ("o6", "US East"), ("o8", "US West"),
    ]
    assert rows(routing.dead_letters(validated), "id", "_error") == [
        ("o4", "unknown region 'ZZ'"), ("o5", "non-positive amount -5.0"), ("o7", "missing field (region/amount)"),
    ]


def test_partition_by_tier(spark, validated):
    part = routing.tier(F.col("amount"), [50, 250])
    small, medium, large = routing.split(routing.valid_rows(validated), part, 3)
    assert [rows(p, "id") for p in (small, medium, large)] == [[("o1",), ("o8",)], [("o2",), ("o3",)], [("o6",)]]
    edges = spark.createDataFrame([(50.0,), (250.0,)], "amount double").select(part)
    assert rows(edges) == [(1,), (2,)]


def test_dead_letters_can_be_read_back(spark, validated):
    path = routing.write_dead_letters(validated, shared_dir(spark, "dead"))
    back = routing.read_dead_letters(spark, path, "id string, region string, amount double, _error string")
    assert rows(back) == rows(routing.dead_letters(validated), "id", "region", "amount", "_error")


def test_lookup_is_broadcast_and_a_large_side_is_not_forced(spark, validated):
    assert "BroadcastHashJoin" in validated._jdf.queryExecution().executedPlan().toString()
    assert "hint" not in broadcast_if_small(spark.range(10), max_rows=5)._jdf.queryExecution().logical().toString()
