from __future__ import annotations

import time

import pytest
from conftest import rows
from fixtures import LATE_STORY, LATER, TRIGGER_TRACE, US, WINDOW_EVENTS, story, timed
from pyspark.sql import functions as F

from tideline.operators import panes as pn
from tideline.operators import sessions as batch_sessions
from tideline.operators import windows as win
from tideline.session import shared_dir
from tideline.streaming import panes as sp
from tideline.streaming import sessions as ss
from tideline.streaming import sinks
from tideline.streaming import windows as sw
from tideline.streaming.feed import SliceFeed, replay, start_to_files

MARK = {"key": "__end__", "event_id": -1, "arrival_us": 0, "value": 0.0}


def pane_trace(spark, data, size_s, lateness_s, **how):
    feed = SliceFeed(story(spark, data, LATER).drop("ts_us", "s"), MARK, horizon_s=100_000)
    out = replay(feed, lambda s: sp.stream_panes(s, "key", "value", size_s, lateness_s, **how), "panes")
    kept = out.where(f"key = 'k' and win_end_us = {(LATER + size_s) * US}").orderBy("pane_index").collect()
    return [(r["pane_index"], r["timing"], r["value"]) for r in kept]


def test_late_data_story_on_a_stream(spark):
    assert pane_trace(spark, LATE_STORY, 60, 30) == [(0, "ON_TIME", 15.0), (1, "LATE", 115.0)]


@pytest.mark.parametrize(
    "accumulating, late, want", [(True, "per_element", [7, 12, 14, 20]), (False, "per_slice", [7, 5, 2, 6])]
)
def test_trigger_trace_on_a_stream(spark, accumulating, late, want):
    got = pane_trace(spark, TRIGGER_TRACE, 30, 60, early=pn.per_slice(), late=late, accumulating=accumulating)
    assert got == [(i, t, float(v)) for i, (t, v) in enumerate(zip(("EARLY", "EARLY", "ON_TIME", "LATE"), want))]


@pytest.mark.parametrize("early", [pn.after_count(4), pn.all_of(4), pn.each_of(2), pn.once(pn.each_of(4))])
def test_early_triggers_equal_their_batch_form(spark, early):
    data = [(b, b * 50 + i, 1 + i) for b, n in enumerate((3, 5, 2)) for i in range(n)]
    batch = pn.panes(story(spark, data), "key", "value", 1_000, early=early).orderBy("pane_index").collect()
    want = [(r["pane_index"], r["timing"], r["value"]) for r in batch]
    assert pane_trace(spark, data, 1_000, 0, early=early) == want


def test_sessions_match_their_batch_form(spark):
    out_of_order = [(0, 1, "A"), (0, 3, "B"), (1, 4, "A"), (1, 2, "A"), (2, 5, "A"), (2, 11, "B")]
    df = timed(spark, [(sl, s, u, s * 1.5) for sl, s, u in out_of_order], "slice bigint, s bigint, key string, value double")
    want = [("A", 4, 5 * US, "BURST"), ("B", 1, 11 * US, "ok"), ("B", 1, 3 * US, "ok")]
    for hot_rows in (0, 3, 100):
        twin = batch_sessions.session_summaries(df, "key", gap_s=5, burst=4, bucket_s=2, hot_rows=hot_rows)
        assert rows(twin, "key", "events", "ended_us", "flag") == want
    assert rows(twin, "key", "events", "ended_us", "flag") == want
    assert twin.where("key = 'A'").first()["sample_values"] == [1.5, 3.0, 6.0, 7.5]
    feed = SliceFeed(df.drop("ts_us", "s"), MARK, horizon_s=1_000)
    out = replay(feed, lambda s: ss.stream_sessions(s, "key", 5, 4, delay_s=10), "sessions")
    kept = out.where("key <> '__end__'")
    assert rows(kept, "key", "events", "ended_us", "flag") == want
    assert kept.where("key = 'A'").first()["sample_values"] == "1.5,3.0,6.0,7.5"


def test_two_bursts_in_one_slice_stay_two_sessions(spark):
    times = [("A", 1), ("A", 2), ("A", 3), ("A", 4), ("A", 31), ("B", 2), ("B", 30)]
    df = timed(spark, [(0, s, u, 1.0) for u, s in times], "slice bigint, s bigint, key string, value double")
    feed = SliceFeed(df.drop("ts_us", "s"), MARK, horizon_s=1_000)
    out = replay(feed, lambda s: ss.stream_sessions(s, "key", 8, 4, delay_s=0), "bursts").where("key <> '__end__'")
    assert rows(out, "key", "events", "flag") == [("A", 1, "ok"), ("A", 4, "BURST"), ("B", 1, "ok"), ("B", 1, "ok")]


def windows_feed(spark):
    data = [(i // 4, *r, 1.0) for i, r in enumerate(WINDOW_EVENTS)]
    df = timed(spark, data, "slice bigint, s bigint, key string, value double")
    return df, SliceFeed(df.drop("ts_us", "s"), MARK, horizon_s=10_000)


def test_restart_with_other_partitions_does_not_count_twice(spark):
    df, feed = windows_feed(spark)
    base = shared_dir(spark, "restart")
    for slices, partitions in ((feed.slices[:2], 2), (feed.slices[2:], 5)):
        out = sw.stream_count_windows(feed.stream(), "key", win.session(45), 0)
        feed.play(start_to_files(out, f"{base}/out", f"{base}/checkpoint", partitions), slices)
        feed = SliceFeed.reopen(spark, feed.base, feed.schema)
    assert feed.slices == []
    got = spark.read.schema(out.schema).parquet(f"{base}/out").where("key <> '__end__'")
    assert rows(got) == rows(win.count_windows(df, "key", win.session(45)))


def test_state_can_be_inspected(spark):
    _, feed = windows_feed(spark)
    base = shared_dir(spark, "state")
    out = sw.stream_count_windows(feed.stream(), "key", win.fixed(60), 1_000)
    feed.play(start_to_files(out, f"{base}/out", f"{base}/checkpoint", 3), feed.slices[:3])
    state = spark.read.format("statestore").load(f"{base}/checkpoint")
    assert state.select("partition_id").distinct().count() <= 3
    assert state.count() > 0


def test_a_replayed_batch_overwrites_itself(spark):
    df, feed = windows_feed(spark)
    base = shared_dir(spark, "sink")
    write = sinks.batch_writer(f"{base}/out")

    def twice(batch, batch_id):
        write(batch, batch_id)
        write(batch, batch_id)

    stream = feed.stream().where("key <> '__end__'").select("event_id", "key")
    feed.play(sinks.start_idempotent(stream, f"{base}/out", f"{base}/checkpoint", twice))
    back = sinks.read_batches(spark, f"{base}/out", stream.schema, "event_id").select("event_id", "key")
    assert rows(back) == rows(df, "event_id", "key")


def test_merged_inputs_wait_for_the_slower_one(spark):
    fast = timed(spark, [(0, 400, "a", 1.0)], "slice bigint, s bigint, key string, value double").drop("ts_us", "s")
    slow = timed(spark, [(0, 9, "b", 1.0)], "slice bigint, s bigint, key string, value double").drop("ts_us", "s")
    feeds = [SliceFeed(df, MARK, horizon_s=1_000) for df in (fast, slow)]
    merged = sw.merge_inputs([(f.stream(), 0) for f in feeds])
    base = shared_dir(spark, "merged")
    query = start_to_files(win.count_windows(merged, "key", win.fixed(10)), f"{base}/out", f"{base}/checkpoint", 2)
    try:
        for f in feeds:
            f.release(0)
        query.processAllAvailable()
        feeds[0].release(feeds[0].slices[1])
        query.processAllAvailable()
        assert query.lastProgress["eventTime"]["watermark"].startswith("1970-01-01T00:00:09")
    finally:
        query.stop()


def test_processing_time_timer_fires_without_new_rows(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 0)], "key string, slice bigint")
    path = shared_dir(spark, "clock")
    df.write.parquet(path)
    stream = spark.readStream.schema(df.schema).parquet(path)
    out = ss.stream_flush_counts(stream, "key", after_ms=500)
    query = (
        out.writeStream.format("memory").queryName("flushed").outputMode("append")
        .trigger(processingTime="200 milliseconds")
        .option("checkpointLocation", shared_dir(spark, "clock-checkpoint")).start()
    )
    try:
        stop = time.time() + 60
        while spark.table("flushed").count() < 2 and time.time() < stop:
            time.sleep(0.3)
        assert rows(spark.table("flushed")) == [("a", 2), ("b", 1)]
    finally:
        query.stop()


def test_timeout_join_brute_force(spark):
    import random

    rng = random.Random(3)
    events = [(i // 20, rng.randrange(300), rng.choice("ab"), rng.random() < 0.5) for i in range(120)]
    df = timed(spark, events, "slice bigint, s bigint, key string, click boolean")
    left, right = df.where("click"), df.where("not click")
    got = batch_sessions.join_with_timeout(left, right, "key", timeout_s=15, bucket_s=20, hot_rows=0)
    whole = batch_sessions.join_with_timeout(left, right, "key", timeout_s=15)
    assert rows(whole) == rows(got)
    want = []
    for i, (_, s, k, click) in enumerate(events):
        if click:
            hits = [t for _, t, k2, c in events if not c and k2 == k and s <= t <= s + 15]
            want.append((k, i, min(hits) * US if hits else None))
    assert rows(got, "key", "event_id", "matched_us") == sorted(want, key=repr)
    marker = {"key": "__end__", "event_id": -1, "click": True}
    feed = SliceFeed(df.drop("ts_us", "s"), marker, horizon_s=10_000)
    out = replay(feed, lambda s: ss.stream_join_with_timeout(s, "key", F.col("click"), 15, delay_s=400), "joined")
    assert rows(out.where("key <> '__end__'"), "key", "event_id", "matched_us") == sorted(want, key=repr)


def test_rate_limit_and_first_seen(spark):
    df = timed(spark, [(s, k, 10 * i) for i, (s, k) in enumerate([(1, "a"), (2, "a"), (3, "a"), (70, "a"), (5, "b")])],
               "s bigint, key string, arrival_us bigint")
    assert rows(batch_sessions.rate_limit(df, "key", 2, 60), "key", "period", "nth", "event_id") == [
        ("a", 0, 1, 0), ("a", 0, 2, 1), ("a", 1, 1, 3), ("b", 0, 1, 4),
    ]
    assert rows(batch_sessions.first_seen(df, ["key"])) == [("a", 0, 0), ("b", 4, 40)]


def test_large_keys_next_to_missing_ones_stay_apart(spark):
    big = 1 << 53
    events = [(0, 1, None), (0, 2, big), (0, 3, big + 1), (0, 4, None), (1, 5, big + 1), (1, 30, big), (1, 31, None), (0, None, big)]
    df = spark.createDataFrame([(sl, s, k, i) for i, (sl, s, k) in enumerate(events)], "slice bigint, s bigint, user bigint, event_id bigint")
    df = df.withColumns({"ts": F.timestamp_seconds("s"), "value": F.lit(1.0), "arrival_us": F.col("slice") * 100 * US + F.col("event_id")})
    mark = {"user": -1, "event_id": -1, "arrival_us": 0, "value": 0.0}
    want = [(None, 1, 31 * US), (None, 2, 4 * US), (big, 1, 2 * US), (big, 1, 30 * US), (big + 1, 2, 5 * US)]
    feed = SliceFeed(df.drop("s").repartition(1), mark, horizon_s=1_000)
    found = replay(feed, lambda s: ss.stream_sessions(s, "user", 5, 4, delay_s=10), "sessions").where("not (user <=> -1)")
    assert sorted(map(tuple, found.select("user", "events", "ended_us").collect()), key=repr) == sorted(want, key=repr)
    feed = SliceFeed(df.drop("s").repartition(1), mark, horizon_s=1_000)
    passed = replay(feed, lambda s: ss.stream_rate_limit(s, "user", 1, 20, delay_s=10), "limited").where("not (user <=> -1)")
    got = sorted(map(tuple, passed.select("user", "period", "event_id").collect()), key=repr)
    assert got == sorted([(None, 0, 0), (big, 0, 1), (big + 1, 0, 2), (big, 1, 5), (None, 1, 6)], key=repr)


@pytest.mark.parametrize("idle_aware, want", [(False, [None, 10, 10, 10, 25, 30]), (True, [None, 10, 40, 40, 40, 40])])
def test_watermark_of_two_inputs_waits_for_the_silent_one_unless_it_is_idle(spark, idle_aware, want):
    from tideline.plans.stream import watermarks_of_two

    # a alone; both; b silent; a silent and b behind what was reached; b again; both
    data = [(0, 20, "a"), (1, 10, "b"), (1, 22, "a"), (2, 40, "a"), (3, 10, "b"), (4, 25, "b"), (5, 30, "b"), (5, 35, "a")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(data)], "event_id bigint, slice bigint, s bigint, channel string")
    found = watermarks_of_two(spark, df.withColumn("ts", F.timestamp_seconds("s")), idle_aware).orderBy("slice")
    assert [r["wm_us"] and r["wm_us"] // US for r in found.collect()] == want


def timers_of_400_keys(spark, build):
    """How many timers the first slice sets."""
    df = spark.range(400).select(
        F.col("id").alias("event_id"), F.lit(0).cast("bigint").alias("slice"), F.timestamp_seconds(LATER + F.col("id") % 50).alias("ts"),
        F.concat(F.lit("k"), "id").alias("key"), F.lit(1.0).alias("value"), F.col("id").alias("arrival_us"), (F.col("id") % 2 == 0).alias("click"),
    )
    feed = SliceFeed(df, {**MARK, "click": True}, horizon_s=10_000)
    base = shared_dir(spark, "shards")
    query = start_to_files(build(feed.stream()), f"{base}/out", f"{base}/checkpoint", 2)
    feed.play(query, feed.slices[:1])
    return sum(o.customMetrics["numRegisteredTimers"] for p in query.recentProgress for o in p.stateOperators)


def test_timeout_join_calls_the_state_for_shards_of_keys(spark):
    assert 0 < timers_of_400_keys(spark, lambda s: ss.stream_join_with_timeout(s, "key", F.col("click"), 1_000, 10)) <= 64


def test_sessions_call_the_state_for_shards_of_keys(spark):
    assert 0 < timers_of_400_keys(spark, lambda s: ss.stream_sessions(s, "key", 5, 4, 10)) <= 64


def test_rate_limit_calls_the_state_for_shards_of_keys(spark):
    assert 0 < timers_of_400_keys(spark, lambda s: ss.stream_rate_limit(s, "key", 2, 1_000, 10)) <= 32


def test_rows_of_a_window_wait_as_blocks(spark):
    data = [(0, i % 50, 1) for i in range(400)] + [(1, 55, 1)]
    feed = SliceFeed(story(spark, data, LATER).drop("ts_us", "s").coalesce(1), MARK, horizon_s=100_000)
    base = shared_dir(spark, "blocks")
    out = sp.stream_panes(feed.stream(), "key", "value", 60, 30, early=pn.any_of(7))
    feed.play(start_to_files(out, f"{base}/out", f"{base}/checkpoint", 2), feed.slices[:1])
    waiting = spark.read.format("statestore").option("stateVarName", "waiting").load(f"{base}/checkpoint")
    assert 0 < waiting.count() <= 4


def test_a_dropped_row_after_a_jump_of_time_does_not_fire_the_window_again(spark):
    data = [(0, 5, 5), (1, 200, None), (2, 8, 100), (3, 300, None)]
    assert pane_trace(spark, data, 60, 30) == [(0, "ON_TIME", 5.0)]
