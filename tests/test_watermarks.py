from __future__ import annotations

from conftest import rows
from fixtures import US, story, timed, LATE_STORY
from pyspark.sql import functions as F

from tideline.operators import watermarks as wm
from tideline.sources.arrivals import replay_order


def test_skew_and_arrival_order(spark):
    arrivals = [(20, 0, "C"), (0, 1, "A"), (40, 2, "E"), (10, 3, "B"), (30, 4, "D")]
    df = timed(spark, arrivals, "s bigint, at bigint, name string").withColumns(
        {"arrival_us": (F.col("at") * 60 + 100) * US, "slice": F.floor(F.col("at") / 2)}
    )
    skewed = wm.event_skew(df)
    assert [r["name"] for r in skewed.where("out_of_order").orderBy("name").collect()] == ["A", "B", "D"]
    assert rows(skewed.where("name = 'B'"), "skew_us") == [((3 * 60 + 100 - 10) * US,)]
    assert [r["name"] for r in replay_order(df).orderBy("arrival_seq").collect()] == ["C", "A", "E", "B", "D"]


STEPS = [
    (8, 5, False), (20, 14, False), (34, 22, False), (48, 30, False), (62, 30, True), (78, 30, True),
    (90, 30, True), (90, 72, False), (95, 88, False),
]


def test_minimum_over_inputs(spark):
    data = []
    for step, (a, b, idle_b) in enumerate(STEPS):
        data.append((step, a, "a"))
        if not idle_b:
            data.append((step, b, "b"))
    df = timed(spark, data, "slice bigint, s bigint, input string")

    def seconds(**how):
        out = wm.merged_watermark(df, "input", ["a", "b"], **how).orderBy("slice").collect()
        return [r["wm_us"] // US for r in out]

    assert seconds() == [5, 14, 22, 30, 30, 30, 30, 72, 88]
    assert seconds(idle_aware=True) == [5, 14, 22, 30, 62, 78, 90, 90, 90]


def test_merged_watermark_waits_for_every_input(spark):
    df = timed(spark, [(0, 5, "a"), (1, 9, "a"), (1, 3, "b")], "slice bigint, s bigint, input string")
    assert rows(wm.merged_watermark(df, "input", ["a", "b"])) == [(0, None), (1, 3 * US)]


def test_closed_windows_and_trail(spark):
    df = story(spark, LATE_STORY)
    closed = wm.closed_windows(df, "key", 60, wm.slice_watermarks(df))
    (first,) = rows(closed.where("key = 'k'"), "n", "fired_slice")
    assert first == (3, 1)
    assert rows(wm.firing_trail(closed).where("key = 'k'"), "trail_s") == [(1_000 - 60,)]
    # The last window of the other key is never passed and closes at the end of input.
    assert rows(closed.where("key = 'other' and win_end_us = 120000000"), "fired_slice") == [(None,)]
