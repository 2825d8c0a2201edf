from __future__ import annotations

import random

import pytest
from conftest import rows
from fixtures import LATE_STORY, TRIGGER_TRACE, US, story
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tideline.operators import panes as pn


def trace(df, **how):
    out = pn.panes(df, "key", "value", **how).where("key = 'k' and win_start_us = 0")
    return [(r["pane_index"], r["timing"], r["value"]) for r in out.orderBy("pane_index").collect()]


def test_late_data_story(spark):
    df = story(spark, LATE_STORY)
    how = {"size_s": 60, "lateness_s": 30}
    assert trace(df, **how) == [(0, "ON_TIME", 15.0), (1, "LATE", 115.0)]
    assert trace(df, accumulating=False, **how) == [(0, "ON_TIME", 15.0), (1, "LATE", 100.0)]
    statuses = pn.row_status(df, 60, 30).where("key = 'k'")
    assert rows(statuses.groupBy("status").count()) == [("DROPPED", 1), ("EARLY", 3), ("LATE", 1)]


def test_late_and_dropped_counters(spark):
    seen = Observation("late")
    pn.observe_late(pn.row_status(story(spark, LATE_STORY), 60, 30), seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"late_elements": 1, "dropped_elements": 1}
    assert dict(rows(pn.status_counts(story(spark, LATE_STORY), 60, 30)))["DROPPED"] == 1


def test_trigger_trace(spark):
    df = story(spark, TRIGGER_TRACE)
    how = {"size_s": 30, "lateness_s": 60, "early": pn.per_slice()}
    assert trace(df, **how) == [(0, "EARLY", 7.0), (1, "EARLY", 12.0), (2, "ON_TIME", 14.0), (3, "LATE", 20.0)]
    assert trace(df, accumulating=False, **how) == [
        (0, "EARLY", 7.0), (1, "EARLY", 5.0), (2, "ON_TIME", 2.0), (3, "LATE", 6.0),
    ]
    out = pn.panes(df, "key", "value", **how).where("key = 'k'").orderBy("pane_index").collect()
    assert [r["is_first"] for r in out] == [True, False, False, False]
    assert [r["is_last"] for r in out] == [False, False, False, True]


def slices_of(*sizes):
    """Slices with that many rows of value 1 in window [0, 1000)."""
    return [(b, b * 50 + i, 1) for b, n in enumerate(sizes) for i in range(n)]


@pytest.mark.parametrize(
    "early, deltas",
    [
        (pn.after_count(4), [4, 4]),
        (pn.any_of(4), [3, 4, 1, 2]),
        (pn.all_of(4), [8]),
        (pn.all_of(3), [3, 5]),
        (pn.each_of(4), [4, 4]),
        (pn.each_of(2), [2, 1, 2, 3, 2]),
        (pn.once(pn.after_count(4)), [4]),
        (pn.once(pn.each_of(4)), [4, 4]),
        (pn.once(pn.per_slice()), [3]),
    ],
)
def test_early_triggers(spark, early, deltas):
    # 3, 5 and 2 rows; the window closes at the end of input.
    got = trace(story(spark, slices_of(3, 5, 2)), size_s=1_000, early=early, accumulating=False)
    fired = [v for _, timing, v in got if timing == "EARLY"]
    assert fired == deltas
    assert got[-1] == (len(deltas), "ON_TIME", 10.0 - sum(deltas))


def brute_force(data, size, lateness, early_n, per_element):
    """The pane rules, row by row, in plain Python. ``data``: (slice, arrival, id, second, key, value)."""
    tops = {}
    for b, _, _, s, _, _ in data:
        tops[b] = max(tops.get(b, s), s)
    before, after, top = {}, {}, None
    for b in sorted(tops):
        before[b] = top
        top = tops[b] if top is None else max(top, tops[b])
        after[b] = top
    windows = {}
    for r in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        windows.setdefault((r[4], r[3] - r[3] % size + size), []).append(r)
    out = []
    for (key, end), members in windows.items():
        early, on_time, late, had = [], 0, [], False
        for b, _, _, _, _, v in members:
            if before[b] is not None and before[b] >= end + lateness:
                continue
            if before[b] is not None and before[b] >= end:
                late.append((b, v))
            elif after[b] >= end:
                had, on_time = True, on_time + v
            else:
                had = True
                early.append(v)
        fired = [sum(early[i : i + early_n]) for i in range(0, len(early) - early_n + 1, early_n)]
        on_time += sum(early[len(fired) * early_n :])
        deltas = [("EARLY", d) for d in fired] + ([("ON_TIME", on_time)] if had else [])
        if per_element:
            deltas += [("LATE", v) for _, v in late]
        else:
            deltas += [("LATE", sum(v for c, v in late if c == b)) for b in sorted({b for b, _ in late})]
        out += [(key, end, i, t, float(d)) for i, (t, d) in enumerate(deltas)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("per_element", [True, False])
def test_random_arrivals_match_brute_force(spark, per_element):
    rng = random.Random(7)
    data = []
    for i in range(600):
        s = rng.randrange(600)
        at = s + rng.choice([0, 5, 20, 70, 300])
        data.append((at // 40, at * US + i, i, s, "hot" if rng.random() < 0.6 else rng.choice("ab"), rng.randrange(9)))
    df = spark.createDataFrame(
        data, "slice bigint, arrival_us bigint, event_id bigint, s bigint, key string, value bigint"
    ).withColumn("ts_us", F.col("s") * US)
    late = "per_element" if per_element else "per_slice"
    args = {"size_s": 60, "lateness_s": 50, "early": pn.after_count(3), "late": late}
    got = pn.panes(df, "key", "value", accumulating=False, **args)
    shaped = sorted(
        [(r["key"], r["win_end_us"] // US, r["pane_index"], r["timing"], r["value"]) for r in got.collect()], key=repr
    )
    assert shaped == brute_force(data, 60, 50, 3, per_element)
    both = pn.final_values(pn.panes(df, "key", "value", **args), got, "key")
    assert both.where("not agree or agree is null").count() == 0


def test_window_with_only_late_rows_has_no_on_time_pane(spark):
    df = story(spark, [(0, 100, 1), (1, 5, 2)])
    assert trace(df, size_s=60, lateness_s=600) == [(0, "LATE", 2.0)]


