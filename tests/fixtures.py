"""Small inputs with known answers (see FIXTURES.md). Fixed values."""

from __future__ import annotations

from pyspark.sql import functions as F

US = 1_000_000

LINES = [
    "The tide comes in, and the tide goes out.",
    "A slow tide doesn't wait; a fast tide DOESN'T either!",
    "",
    "42 boats - 7 out, 35 in.",
    "Out of the harbour and into the bay",
    "in\tthe bay: the-end",
]
CITIES = [("Oslo", 7), ("Lisbon", 2), ("Reykjavik", 4), ("Bern", 9), ("Copenhagen", 1)]
CLICKS = [("u1", "/home"), ("u1", "/pricing"), ("u2", "/home"), ("u3", "/docs/ch05"), ("u2", "/checkout"), ("u1", "/checkout")]
MORE_CLICKS = [("u3", "/blog"), ("u4", "/home")]
PROFILES = [("u1", "Ada", "pro"), ("u2", "Linus", "free"), ("u3", "Grace", "pro")]
READINGS = [
    ("sensor-a", 21.0), ("sensor-a", 23.0), ("sensor-a", 25.0), ("sensor-b", 10.0), ("sensor-b", 20.0),
    ("sensor-c", 100.0), ("sensor-c", 102.0), ("sensor-c", 98.0), ("sensor-c", 100.0),
]
REGIONS = [("us-east", "US East"), ("us-west", "US West"), ("eu-central", "EU Central"), ("ap-south", "AP South")]
ORDERS = [
    ("o1", "us-east", 12.5), ("o2", "eu-central", 240.0), ("o3", "ap-south", 75.25), ("o4", "ZZ", 30.0),
    ("o5", "us-west", -5.0), ("o6", "us-east", 999.99), ("o7", "eu-central", None), ("o8", "us-west", 49.0),
]
WINDOW_EVENTS = [
    (5, "sensor-0"), (12, "sensor-1"), (20, "sensor-0"), (35, "sensor-0"), (48, "sensor-1"), (55, "sensor-0"),
    (70, "sensor-0"), (82, "sensor-1"), (95, "sensor-0"), (118, "sensor-1"), (200, "sensor-0"), (215, "sensor-0"),
    (240, "sensor-1"),
]
EMISSION = [3, 0, 7, 1, 10, 2, 5, 11, 4, 8, 6, 12, 9]
# (slice, event second, value); value None is a row of another key that only moves event time.
LATE_STORY = [
    (0, 5, 5), (0, 10, 7), (0, 15, 3), (1, 60, None), (2, 12, 100), (3, 90, None), (4, 91, None), (5, 8, 999),
]
# The window of this trace is [10, 40); all times are moved back by 10 to fit [0, 30).
TRIGGER_TRACE = [(0, 4, 3), (0, 8, 4), (1, 16, 5), (2, 23, 2), (2, 31, None), (3, 12, 6)]


def timed(spark, data, schema, seconds="s"):
    """Add ``ts``, ``ts_us`` and ``event_id`` to rows that carry their event second."""
    numbered = [(i, *r) for i, r in enumerate(data)]
    df = spark.createDataFrame(numbered, "event_id bigint, " + schema)
    us = (F.col(seconds) * US).cast("bigint")
    return df.withColumns({"ts_us": us, "ts": F.timestamp_micros(us)})


# A Spark watermark cannot lie before 1970, so stories told to a stream happen later.
LATER = 600_000_000


def story(spark, data, base=0):
    """Arrival slices of a story as events of key ``k`` (and ``other`` for pure time)."""
    shaped = [(sl, s + base, "k" if v is not None else "other", float(v or 0)) for sl, s, v in data]
    df = timed(spark, shaped, "slice bigint, s bigint, key string, value double")
    return df.withColumn("arrival_us", F.col("slice") * 1_000 * US + F.col("event_id"))
