"""Queries that run as streams over arrival slices and return what the stream has written."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.numeric import DAY_S, US
from tideline.operators import panes as pn, windows as win
from tideline.plans.batch import BURST, GAP_S, channelled, query
from tideline.plans.tables import arriving
from tideline.session import shared_dir
from tideline.sources import kafka, log
from tideline.sources.arrivals import COARSE, TARDY, ArrivalModel
from tideline.streaming import accounting, panes as sp, rescale, sessions as ss, sinks, windows as sw
from tideline.streaming.feed import SliceFeed, replay, start_to_files

# No row is ever more than three days behind in the coarse model.
DELAY_S = 4 * DAY_S
HORIZON_S = 60 * DAY_S
# No real row has these keys: a control character, and the smallest number of its type.
MARKER = {"event_type": "\x00__end__", "user_id": -(1 << 63), "event_id": -1, "arrival_us": 0, "value": 0.0}
COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "arrival_us", "slice")


def feed_of(spark: SparkSession, folder: str, model: ArrivalModel = COARSE) -> SliceFeed:
    return SliceFeed(arriving(spark, folder, model).select(*COLUMNS), MARKER, HORIZON_S)


def no_marker(rows: DataFrame) -> DataFrame:
    """Drop the feed's marker rows. To be used on results: inside a streaming aggregation Catalyst would
    push the filter below the watermark, which the markers are there to move."""
    for column in ("event_type", "user_id"):
        if column in rows.columns:
            rows = rows.where(~F.col(column).eqNullSafe(F.lit(MARKER[column])))
    return rows


def _windows(spark: SparkSession, folder: str, key: str, windowing: win.Windowing) -> DataFrame:
    counted = replay(
        feed_of(spark, folder),
        lambda stream: sw.stream_count_windows(stream, key, windowing, DELAY_S),
        "windows",
    )
    return no_marker(counted)


@query
def stream_window_fixed(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder, "event_type", win.fixed(DAY_S))


@query
def stream_window_sliding(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder, "event_type", win.sliding(DAY_S, DAY_S // 2))


@query
def stream_window_session(spark: SparkSession, folder: str) -> DataFrame:
    return _windows(spark, folder, "user_id", win.session(GAP_S))


def _panes(spark: SparkSession, folder: str, **how) -> DataFrame:
    fired = replay(
        feed_of(spark, folder, TARDY),
        lambda stream: sp.stream_panes(stream, "event_type", "value", 3 * DAY_S, 3 * DAY_S, **how),
        "panes",
    )
    return no_marker(fired)


@query
def stream_panes_accumulating(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.per_slice())


@query
def stream_panes_discarding(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.per_slice(), late="per_slice", accumulating=False)


@query
def stream_panes_after_any(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.any_of(7))


@query
def stream_panes_early_count(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.after_count(10))


@query
def stream_panes_after_all(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.all_of(25))


@query
def stream_panes_after_each(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.each_of(20))


@query
def stream_panes_once(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.once(pn.after_count(5)))


@query
def stream_state_sessions(spark: SparkSession, folder: str) -> DataFrame:
    found = replay(
        feed_of(spark, folder),
        lambda stream: ss.stream_sessions(stream, "user_id", GAP_S, BURST, DELAY_S),
        "sessions",
    )
    return no_marker(found)


@query
def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives twice, the copy one slice later; each must come out once."""
    rows = arriving(spark, folder, COARSE).select(*COLUMNS)
    copies = rows.withColumns(
        {"slice": F.col("slice") + 1, "arrival_us": F.col("arrival_us") + COARSE.slice_s * US}
    )
    feed = SliceFeed(rows.unionByName(copies), MARKER, HORIZON_S)
    once = replay(
        feed,
        lambda stream: sw.stream_distinct(stream, "event_id", 3 * DELAY_S).select("event_id", "user_id", "event_type"),
        "distinct",
    )
    return no_marker(once)


@query
def stream_rate_limit(spark: SparkSession, folder: str) -> DataFrame:
    passed = replay(
        feed_of(spark, folder),
        lambda stream: ss.stream_rate_limit(stream, "user_id", 2, DAY_S, DELAY_S),
        "limited",
    )
    return no_marker(passed)


@query
def stream_join_with_timeout(spark: SparkSession, folder: str) -> DataFrame:
    def build(stream: DataFrame) -> DataFrame:
        sides = stream.where(F.col("event_type").isin("click", "purchase", MARKER["event_type"]))
        is_left = F.col("event_type") != "purchase"
        return ss.stream_join_with_timeout(sides, "user_id", is_left, DAY_S, DELAY_S)

    return no_marker(replay(feed_of(spark, folder), build, "joined"))


# --- recovery ---------------------------------------------------------------------------------


@query
def restart_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Stop after half of the slices and resume from the checkpoint."""
    feed = feed_of(spark, folder)
    base = shared_dir(spark, "restart")
    half = len(feed.slices) // 2
    for slices in (feed.slices[:half], feed.slices[half:]):
        out = sw.stream_count_windows(feed.stream(), "event_type", win.fixed(DAY_S), DELAY_S)
        feed.play(start_to_files(out, f"{base}/out", f"{base}/checkpoint", 2), slices)
    return no_marker(spark.read.schema(out.schema).parquet(f"{base}/out"))


@query
def rescale_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the slices in three state partitions; then their state, and the other half alone, in five."""
    feed = feed_of(spark, folder)
    base = shared_dir(spark, "rescale")
    half = len(feed.slices) // 2
    out = sw.stream_count_windows(feed.stream(), "event_type", win.fixed(DAY_S), DELAY_S)
    feed.play(start_to_files(out, f"{base}/before", f"{base}/old", 3), feed.slices[:half])
    moved = rescale.moved_state(spark, f"{base}/old", "event_type")
    rest = feed.later()
    out = rescale.resume_count_windows(rest.stream(), "event_type", DAY_S, DELAY_S, moved)
    rest.play(start_to_files(out, f"{base}/after", f"{base}/new", 5))
    both = [spark.read.schema(out.schema).parquet(f"{base}/{part}") for part in ("before", "after")]
    return no_marker(both[0].unionByName(both[1]))


@query
def idempotent_sink_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Every micro-batch is written twice, as after a failure between write and commit, and counted as it
    lies in the sink."""
    feed = feed_of(spark, folder)
    base = shared_dir(spark, "sink")
    write = sinks.batch_writer(f"{base}/out")

    def twice(rows: DataFrame, batch_id: int) -> None:
        write(rows, batch_id)
        write(rows, batch_id)

    rows = no_marker(feed.stream()).select("event_id", "ts", "event_type")
    feed.play(sinks.start_idempotent(rows, f"{base}/out", f"{base}/checkpoint", twice))
    kept = sinks.read_batches(spark, f"{base}/out", rows.schema)
    return win.count_windows(kept, "event_type", win.fixed(DAY_S))


@query
def restart_after_failure(spark: SparkSession, folder: str) -> DataFrame:
    """The driver's code dies after a micro-batch is written and before it is committed; the restart runs it again."""
    counts, _ = failed_once(spark, folder)
    return counts


def failed_once(spark: SparkSession, folder: str) -> tuple[DataFrame, list[int]]:
    """What the sink holds after the failure and the restart, and the micro-batches in the order they ran."""
    feed = feed_of(spark, folder)
    base = shared_dir(spark, "failure")
    write, ran = sinks.batch_writer(f"{base}/out"), []
    fatal = len(feed.slices) // 2

    def fragile(rows: DataFrame, batch_id: int) -> None:
        write(rows, batch_id)
        ran.append(batch_id)
        if batch_id == fatal and ran.count(fatal) == 1:
            raise RuntimeError("lost between write and commit")

    rows = no_marker(feed.stream()).select("event_id", "ts", "event_type")
    try:
        feed.play(sinks.start_idempotent(rows, f"{base}/out", f"{base}/checkpoint", fragile))
    except StreamingQueryException as e:
        if "lost between write and commit" not in str(e):
            raise
    # What is released stays released: the new query finds the lost micro-batch in the checkpoint's offsets.
    feed.play(sinks.start_idempotent(rows, f"{base}/out", f"{base}/checkpoint", fragile), feed.unreleased())
    kept = sinks.read_batches(spark, f"{base}/out", rows.schema)
    return win.count_windows(kept, "event_type", win.fixed(DAY_S)), ran


@query
def transactional_sink_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows through a sink with a commit of its own, counted from what is committed."""
    feed = feed_of(spark, folder)
    base = shared_dir(spark, "transactional")
    rows = no_marker(feed.stream()).select("event_id", "ts", "event_type")
    feed.play(sinks.start_transactional(rows, f"{base}/out", f"{base}/checkpoint"))
    kept = sinks.read_committed(spark, f"{base}/out", rows.schema)
    return win.count_windows(kept, "event_type", win.fixed(DAY_S))


@query
def stream_offset_range(spark: SparkSession, folder: str) -> DataFrame:
    """Events from a log that grows while it is read, by a query that is stopped and started again halfway."""
    rows = arriving(spark, folder, COARSE).select("event_id", "ts", "event_type", "slice")
    base = shared_dir(spark, "log")
    first, last = rows.agg(F.min("slice"), F.max("slice")).first()
    appends = 4
    share = F.least(F.floor((F.coalesce("slice", F.lit(first)) - first) * appends / (last - first + 1)), F.lit(appends - 1))
    for number in range(appends):
        log.append_log(rows.where(share == number).drop("slice"), f"{base}/log", number)
        if number % 2:  # the query finds two appends at each start, and stops
            read = log.read_log(spark, f"{base}/log", rows.drop("slice").schema, stream=True)
            running = start_to_files(read, f"{base}/out", f"{base}/checkpoint")
            running.processAllAvailable()
            running.stop()
    kept = spark.read.schema(read.schema).parquet(f"{base}/out")
    return win.count_windows(kept, "event_type", win.fixed(DAY_S))


@query
def stream_flush_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts flushed by processing-time timers. When they fire is up to the clock; what they add up to is not."""
    flushed = replay(feed_of(spark, folder), lambda stream: ss.stream_flush_counts(stream, "event_type", after_ms=1), "flushed")
    return no_marker(flushed).groupBy("event_type").agg(F.sum("n").alias("n"))


# --- two inputs -------------------------------------------------------------------------------


def watermarks_of_two(spark: SparkSession, rows: DataFrame, idle_aware: bool) -> DataFrame:
    """The engine's watermark after each slice of a stream with inputs a and b, each with a watermark of its own."""
    rows = rows.select("event_id", "ts", "channel", "slice")
    if idle_aware:
        beats = sw.idle_heartbeats(rows, "channel", ["a", "b"])
        rows = rows.unionByName(beats.withColumn("event_id", F.lit(MARKER["event_id"]).cast(rows.schema["event_id"].dataType)))
    # The feed's own markers belong to neither input.
    feed = SliceFeed(rows, {"event_id": MARKER["event_id"], "channel": None}, HORIZON_S)
    base = shared_dir(spark, "inputs")
    marks = sw.WatermarkLog()
    spark.streams.addListener(marks)
    try:
        # Both inputs read one source, so a slice of both is one micro-batch.
        stream = feed.stream()
        both = sw.merge_inputs([(stream.where(F.col("channel") == c), 0) for c in ("a", "b")])
        out = win.count_windows(sw.WatermarkLog.observed(both), "channel", win.fixed(DAY_S))
        feed.play(start_to_files(out, f"{base}/out", f"{base}/checkpoint", feed.state_partitions()))
        found = marks.after_slices()
    finally:
        spark.streams.removeListener(marks)
    return spark.createDataFrame(found, "slice bigint, wm_us bigint")


@query
def stream_watermark_min(spark: SparkSession, folder: str) -> DataFrame:
    return watermarks_of_two(spark, channelled(spark, folder, COARSE), idle_aware=False)


@query
def stream_watermark_min_idle(spark: SparkSession, folder: str) -> DataFrame:
    return watermarks_of_two(spark, channelled(spark, folder, COARSE), idle_aware=True)


# --- late data --------------------------------------------------------------------------------


@query
def stream_late_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows by status, folded from the metrics that the query reports with each micro-batch."""
    feed = feed_of(spark, folder, TARDY)
    base = shared_dir(spark, "late")
    totals = accounting.MetricTotals()
    spark.streams.addListener(totals)
    try:
        real = ~F.col("event_id").eqNullSafe(F.lit(MARKER["event_id"]))
        out = accounting.stream_status_counts(feed.stream(), 3 * DAY_S, 3 * DAY_S, 6 * DAY_S, real)
        feed.play(start_to_files(out, f"{base}/out", f"{base}/checkpoint", feed.state_partitions()))
        found = accounting.late_counts(totals.totals(), feed.untimed)
    finally:
        spark.streams.removeListener(totals)
    return spark.createDataFrame(list(found.items()), "status string, n bigint")


# --- message log ------------------------------------------------------------------------------


@query
def kafka_shape_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Events as key and value bytes, some keys missing or empty, counted per user and day, and sent on
    as bytes; decoded again here."""
    rows = arriving(spark, folder, COARSE)
    key = (
        F.when(F.col("event_id") % 41 == 0, F.lit(None))
        .when(F.col("event_id") % 43 == 0, F.lit(""))
        .otherwise(F.concat(F.lit("user-"), F.col("user_id").cast("string")))
    )
    messages = rows.select(
        F.encode(key, "UTF-8").alias("key"), F.encode("event_type", "UTF-8").alias("value"), "ts", "slice"
    )
    feed = SliceFeed(messages, {"key": bytearray(b"__end__"), "value": bytearray(b"")}, HORIZON_S)

    def build(stream: DataFrame) -> DataFrame:
        counted = sw.stream_count_windows(kafka.decode_user(stream), "user", win.fixed(DAY_S), DELAY_S)
        return kafka.encode_counts(counted)

    sent = replay(feed, build, "messages")
    received = sent.select(
        F.decode("key", "UTF-8").alias("user"),
        F.decode("value", "UTF-8").cast("bigint").alias("n"),
        "win_start_us",
    )
    return received.where(~F.col("user").eqNullSafe(F.lit("__end__")))
