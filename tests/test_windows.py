from __future__ import annotations

import random

import pytest
from conftest import rows
from fixtures import EMISSION, US, WINDOW_EVENTS, timed

from tideline.operators import windows as win

FIXED = [
    ("sensor-0", 0, 60, 4), ("sensor-0", 60, 120, 2), ("sensor-0", 180, 240, 2),
    ("sensor-1", 0, 60, 2), ("sensor-1", 60, 120, 2), ("sensor-1", 240, 300, 1),
]
SLIDING = [
    ("sensor-0", -30, 30, 2), ("sensor-0", 0, 60, 4), ("sensor-0", 30, 90, 3), ("sensor-0", 60, 120, 2),
    ("sensor-0", 90, 150, 1), ("sensor-0", 150, 210, 1), ("sensor-0", 180, 240, 2), ("sensor-0", 210, 270, 1),
    ("sensor-1", -30, 30, 1), ("sensor-1", 0, 60, 2), ("sensor-1", 30, 90, 2), ("sensor-1", 60, 120, 2),
    ("sensor-1", 90, 150, 1), ("sensor-1", 210, 270, 1), ("sensor-1", 240, 300, 1),
]
SESSIONS = [("sensor-0", 5, 140, 6), ("sensor-0", 200, 260, 2), ("sensor-1", 12, 163, 4), ("sensor-1", 240, 285, 1)]
GLOBAL = [("sensor-0", None, None, 8), ("sensor-1", None, None, 5)]


def counted(spark, data, windowing):
    df = timed(spark, data, "s bigint, key string").repartition(3)
    out = rows(win.count_windows(df, "key", windowing))
    return sorted([(k, a and a // US, b and b // US, n) for k, a, b, n in out], key=repr)


@pytest.mark.parametrize("order", [None, EMISSION, "random"])
@pytest.mark.parametrize(
    "windowing, want",
    [(win.fixed(60), FIXED), (win.sliding(60, 30), SLIDING), (win.session(45), SESSIONS), (win.global_window(), GLOBAL)],
)
def test_windows_do_not_depend_on_arrival(spark, order, windowing, want):
    data = WINDOW_EVENTS if order is None else [WINDOW_EVENTS[i] for i in EMISSION]
    if order == "random":
        data = random.Random(1).sample(WINDOW_EVENTS, len(WINDOW_EVENTS))
    got = counted(spark, data, windowing)
    # sliding starts before zero keep their sign
    want = sorted([(k, a, b, n) for k, a, b, n in want], key=repr)
    assert got == want


def test_a_gap_of_exactly_the_session_gap(spark):
    data = [(0, "a"), (45, "a"), (91, "a")]
    assert counted(spark, data, win.session(45)) == [("a", 0, 90, 2), ("a", 91, 136, 1)]
    assert counted(spark, data, win.session(45, strict=True)) == [("a", 0, 45, 1), ("a", 45, 90, 1), ("a", 91, 136, 1)]
