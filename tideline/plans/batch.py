"""Queries that run as one batch job."""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.functions.numeric import DAY_S, US
from tideline.functions.text import clock
from tideline.operators import aggregate as agg
from tideline.operators import elementwise as el
from tideline.operators import joins, panes as pn, routing, sessions, watermarks as wm, windows as win
from tideline.plans.tables import arriving, events, table
from tideline.session import broadcast_if_small, shared_dir
from tideline.sources import offsets, synthetic, text
from tideline.sources.arrivals import ArrivalModel, replay_order

HOUR_S = 3_600
LATENESS_S = 6 * HOUR_S
GAP_S = 6 * HOUR_S
BURST = 4

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- sources and sinks -------------------------------------------------------------------------


@query
def wordcount(spark: SparkSession, folder: str) -> DataFrame:
    return agg.count_per_key(el.split_words(table(spark, folder, "documents")), "word")


@query
def text_sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    counted = wordcount(spark, folder)
    lines = counted.select(F.format_string("%s: %d", "word", "n").alias("line"))
    return text.read_lines(spark, text.write_lines(lines, shared_dir(spark, "words")))


@query
def create_inline(spark: SparkSession, folder: str) -> DataFrame:
    weights = spark.createDataFrame(
        [("click", 1), ("view", 2), ("signup", 3), ("purchase", 5), ("error", 0)],
        "event_type string, weight bigint",
    )
    # An event of a type that is not listed counts, with no weight.
    weighted = events(spark, folder).join(broadcast_if_small(weights), "event_type", "left")
    return weighted.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.coalesce("weight", F.lit(0))).alias("weight")
    )


@query
def csv_parse_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Events as messy text: padded cells, comments, blank lines and extra cells, then parsed."""
    ev = events(spark, folder).select(
        F.floor(F.col("ts_us") / US).cast("bigint").alias("event_time"), "event_type", "user_id", "event_id", "value"
    )
    cells = F.concat_ws(
        " , ", *[F.col(c).cast("string") for c in ("event_time", "event_type", "user_id", "event_id", "value")]
    )
    noise = (
        F.when(F.col("event_id") % 3 == 0, F.array(F.concat(F.lit("  # after "), "event_id"), F.lit("   ")))
        .otherwise(F.array().cast("array<string>"))
    )
    record = F.when(F.col("event_id") % 5 == 0, F.concat(cells, F.lit(", extra"))).otherwise(cells)
    messy = ev.select(F.explode(F.concat(F.array(record), noise)).alias("line"))
    lines = text.read_lines(spark, text.write_lines(messy, shared_dir(spark, "records")))
    columns = {"event_time": "double", "key": "string", "user_id": "bigint", "id": "bigint", "value": "double"}
    return text.parse_records(lines, columns).drop("_unparsed")


@query
def replay_arrival_order(spark: SparkSession, folder: str) -> DataFrame:
    return replay_order(arriving(spark, folder)).select("event_id", "slice", "arrival_us", "arrival_seq")


@query
def synthetic_events(spark: SparkSession, folder: str) -> DataFrame:
    ticks = events(spark, folder).select((F.col("ts_us") / 1e6).alias("secs"))
    made = synthetic.events_from_ticks(ticks, cardinality=3, lag_s=8.0)
    return made.select("key", "value", "seq", F.floor("event_time").cast("bigint").alias("event_s"))


@query
def offset_range_by_digit(spark: SparkSession, folder: str) -> DataFrame:
    """Each line item's quantity N is the work [0, N); offsets counted and summed by last digit."""
    chunks = offsets.split_ranges(
        table(spark, folder, "lineitem").select(F.col("l_quantity").cast("bigint").alias("n")), "n"
    )
    read = offsets.read_ranges(chunks)
    return read.groupBy((F.col("offset") % 10).alias("digit")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("offset").alias("total"), F.max("offset").alias("last")
    )


# --- element-wise ------------------------------------------------------------------------------


@query
def score_and_keep(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer").select("c_custkey", "c_name", "c_nationkey")
    return customers.transform(el.score_and_keep(200, "c_name", "c_nationkey"))


@query
def batched_enrich(spark: SparkSession, folder: str) -> DataFrame:
    """Read the counter inside ``props`` with a pattern compiled once per task."""
    ev = table(spark, folder, "events").where(F.col("event_type") != "error").select("event_id", "event_type", "props")

    def enrich(pattern: re.Pattern, batch: pa.RecordBatch) -> pa.RecordBatch:
        found = pc.extract_regex(batch.column("props"), pattern=pattern.pattern)
        k = pc.cast(pc.struct_field(found, [0]), pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch.column("event_id"), batch.column("event_type"), k], names=["event_id", "event_type", "k"]
        )

    return el.enrich_in_batches(
        ev, lambda: re.compile(r'"k": (?P<k>\d+)'), enrich, "event_id bigint, event_type string, k bigint"
    )


@query
def element_anatomy(spark: SparkSession, folder: str) -> DataFrame:
    shown = el.element_anatomy(events(spark, folder), DAY_S)
    return shown.select(
        "event_id", "event_s", "window_start_s", "window_end_s", "timing", "pane_index", clock(F.col("ts")).alias("clock")
    )


@query
def event_skew(spark: SparkSession, folder: str) -> DataFrame:
    return wm.event_skew(arriving(spark, folder)).select("event_id", "skew_us", "out_of_order")


# --- aggregation -------------------------------------------------------------------------------


def _as_text(values: str):
    return F.array_join(F.transform(values, lambda v: v.cast("string")), ",")


@query
def group_values(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of each customer in lists of about eight; what the lists hold, whatever part it lies in."""
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    lists = agg.group_values(orders, "o_custkey", "o_orderkey", split_by="o_orderkey", chunk=8)
    return lists.select("o_custkey", "parts", "total", F.explode("values").alias("o_orderkey"))


@query
def combine_mean_custom(spark: SparkSession, folder: str) -> DataFrame:
    return agg.mean_per_key(table(spark, folder, "lineitem"), "l_extendedprice", "l_suppkey")


@query
def combine_two_phase(spark: SparkSession, folder: str) -> DataFrame:
    means = agg.combine_per_key(
        table(spark, folder, "lineitem"), "l_suppkey", "l_extendedprice", agg.MeanFn(), "mean", "double"
    )
    return means.withColumn("mean", F.round("mean", 4))


@query
def combine_mean_builtin(spark: SparkSession, folder: str) -> DataFrame:
    return agg.mean_per_key_builtin(table(spark, folder, "lineitem"), "l_extendedprice", "l_suppkey")


@query
def mean_global(spark: SparkSession, folder: str) -> DataFrame:
    return agg.mean_per_key(table(spark, folder, "events"), "value")


@query
def count_all(spark: SparkSession, folder: str) -> DataFrame:
    return agg.count_per_key(table(spark, folder, "lineitem").select("l_quantity"))


@query
def top_n_global(spark: SparkSession, folder: str) -> DataFrame:
    return agg.top_n(table(spark, folder, "events").select("event_id", "value"), 3, by="value", tie="event_id")


@query
def top_n_per_key(spark: SparkSession, folder: str) -> DataFrame:
    ev = table(spark, folder, "events").select("user_id", "event_id", "value")
    return agg.top_n_per_key(ev, 3, "user_id", by="value", tie="event_id")


@query
def sample_fixed_size(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return agg.sample_fixed_size(orders, 100, "o_orderkey", seed="-7")


@query
def distinct_pairs(spark: SparkSession, folder: str) -> DataFrame:
    return agg.distinct_rows(table(spark, folder, "events"), "user_id", "event_type")


# --- joins and unions --------------------------------------------------------------------------


@query
def cogroup_lists(spark: SparkSession, folder: str) -> DataFrame:
    """Events and orders of the same customer side by side, about twenty of each per row; what the lists hold."""
    sides = {
        "events": (table(spark, folder, "events"), "user_id", "event_id", "event_id"),
        "orders": (table(spark, folder, "orders"), "o_custkey", "o_orderkey", "o_orderkey"),
    }
    grouped = joins.cogroup_lists(sides, "customer", chunk=20)
    both = [
        grouped.select("customer", "parts", "events_total", "orders_total", F.lit(tag).alias("side"), F.explode(tag).alias("id"))
        for tag in sides
    ]
    return joins.union_all(*both)


@query
def left_enrich(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with their label; most documents have none."""
    docs = table(spark, folder, "documents").select("doc_id", "lang", "source")
    labels = table(spark, folder, "labels")
    return joins.left_enrich(docs, labels, "doc_id", first_by="quality", defaults={"quality": -1, "toxic": -1})


@query
def union_all(spark: SparkSession, folder: str) -> DataFrame:
    ev = table(spark, folder, "events").select(F.col("user_id").alias("customer"), F.lit("event").alias("kind"))
    orders = table(spark, folder, "orders").select(F.col("o_custkey").alias("customer"), F.lit("order").alias("kind"))
    return agg.count_per_key(joins.union_all(ev, orders), "customer", "kind")


def raw_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as unchecked records: the region is the customer's, and some are spoilt on purpose."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    # An order without a customer or nation stays, and fails the check for its region.
    placed = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").join(
        broadcast_if_small(nations), F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    k, price = F.col("o_orderkey"), F.col("o_totalprice")
    return placed.select(
        k.alias("id"),
        F.when(k % 37 == 0, "ZZ").otherwise(F.col("n_regionkey").cast("string")).alias("region"),
        F.when(k % 31 != 0, F.when(k % 41 == 0, -price).otherwise(price)).alias("amount"),
        F.col("o_orderdate").cast("timestamp").alias("ts"),
    )


def validated_orders(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region").select(F.col("r_regionkey").cast("string").alias("code"), F.col("r_name").alias("name"))
    return routing.validate(raw_orders(spark, folder), regions)


@query
def validate_tagged(spark: SparkSession, folder: str) -> DataFrame:
    return validated_orders(spark, folder).select("id", "region", "amount", "region_name", F.col("_error").alias("error"))


@query
def side_singleton(spark: SparkSession, folder: str) -> DataFrame:
    """Orders above the mean price, the mean being one value computed on the side."""
    orders = table(spark, folder, "orders")
    mean = joins.singleton(orders.agg(F.avg("o_totalprice").alias("m")))
    return orders.where(F.col("o_totalprice") > mean).select("o_orderkey", "o_totalprice")


@query
def side_list_semi(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of customers who have bought something, by the customer's list of purchases."""
    buyers = (
        table(spark, folder, "events")
        .where(F.col("event_type") == "purchase")
        .select(F.col("user_id").alias("o_custkey"))
        .dropDuplicates()
    )
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey")
    kept = joins.keep_listed(orders, buyers, "o_custkey").withColumn("side", F.lit("listed"))
    rest = joins.keep_listed(orders, buyers, "o_custkey", keep=False).withColumn("side", F.lit("unlisted"))
    return joins.union_all(kept, rest)


# --- routing -----------------------------------------------------------------------------------


@query
def dead_letter(spark: SparkSession, folder: str) -> DataFrame:
    dead = routing.dead_letters(validated_orders(spark, folder))
    return dead.select("id", "region", "amount", F.col("_error").alias("error"))


@query
def tagged_outputs(spark: SparkSession, folder: str) -> DataFrame:
    """Valid and dead rows written in one pass, read back output by output and counted."""
    tagged = routing.with_tag(validated_orders(spark, folder).drop("ts"))
    path = routing.write_tagged(tagged, shared_dir(spark, "tagged"))
    outputs = [
        routing.read_tagged(spark, path, tagged.schema, tag)
        .groupBy("region")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(tag).alias("output"), "region", "n")
        for tag in (routing.VALID, routing.DEAD_LETTER)
    ]
    return joins.union_all(*outputs)


@query
def partition_by_tier(spark: SparkSession, folder: str) -> DataFrame:
    valid = routing.valid_rows(validated_orders(spark, folder))
    tiered = valid.withColumn("part", routing.tier(F.col("amount"), [50_000, 250_000]))
    return tiered.groupBy("part", "region_name").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("amount"), 2).alias("total")
    )


@query
def dead_letter_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = routing.write_dead_letters(validated_orders(spark, folder).drop("ts"), shared_dir(spark, "dead"))
    dead = routing.read_dead_letters(spark, path, "id bigint, region string, amount double, _error string")
    return dead.select("id", "region", "amount", F.col("_error").alias("error"))


# --- windows and watermarks --------------------------------------------------------------------


@query
def window_fixed_count(spark: SparkSession, folder: str) -> DataFrame:
    return win.count_windows(events(spark, folder), "event_type", win.fixed(DAY_S))


@query
def window_fixed_sum(spark: SparkSession, folder: str) -> DataFrame:
    return win.sum_windows(events(spark, folder), "event_type", win.fixed(DAY_S), "value").withColumn("total", F.round("total", 2))


@query
def window_sliding_count(spark: SparkSession, folder: str) -> DataFrame:
    return win.count_windows(events(spark, folder), "event_type", win.sliding(DAY_S, DAY_S // 2))


@query
def window_session_count(spark: SparkSession, folder: str) -> DataFrame:
    return win.count_windows(events(spark, folder), "user_id", win.session(GAP_S))


@query
def window_session_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Whole-second event times, so that gaps of exactly one hour can occur."""
    ev = events(spark, folder).withColumn("ts", F.timestamp_seconds(F.floor(F.col("ts_us") / US)))
    return win.count_windows(ev, "user_id", win.session(HOUR_S, strict=True))


@query
def window_global_count(spark: SparkSession, folder: str) -> DataFrame:
    return win.count_windows(events(spark, folder), "user_id", win.global_window()).select("user_id", "n")


@query
def window_family(spark: SparkSession, folder: str) -> DataFrame:
    """The same count under four kinds of window."""
    kinds = {
        "fixed": win.fixed(DAY_S),
        "sliding": win.sliding(DAY_S, DAY_S // 2),
        "session": win.session(GAP_S),
        "global": win.global_window(),
    }
    ev = events(spark, folder)
    counted = [
        win.count_windows(ev, "user_id", w).select(F.lit(label).alias("label"), "*") for label, w in kinds.items()
    ]
    return joins.union_all(*counted)


@query
def watermark_closed_windows(spark: SparkSession, folder: str) -> DataFrame:
    ev = arriving(spark, folder)
    closed = wm.closed_windows(ev, "event_type", DAY_S, wm.slice_watermarks(ev))
    return closed.select("event_type", "win_end_us", "n", "fired_slice")


@query
def watermark_trail(spark: SparkSession, folder: str) -> DataFrame:
    ev = arriving(spark, folder)
    closed = wm.closed_windows(ev, "event_type", DAY_S, wm.slice_watermarks(ev))
    return wm.firing_trail(closed).select("event_type", "win_end_us", "trail_s")


def channelled(spark: SparkSession, folder: str, *model: ArrivalModel) -> DataFrame:
    """Two inputs: even users are on input b, except that b is silent for three slices in eight."""
    silent = (F.col("slice") % 8).isin(4, 5, 6)
    channel = F.when((F.col("user_id") % 2 == 0) & ~silent, "b").otherwise("a")
    return arriving(spark, folder, *model).withColumn("channel", channel)


@query
def watermark_min_inputs(spark: SparkSession, folder: str) -> DataFrame:
    return wm.merged_watermark(channelled(spark, folder), "channel", ["a", "b"])


@query
def watermark_min_idle(spark: SparkSession, folder: str) -> DataFrame:
    return wm.merged_watermark(channelled(spark, folder), "channel", ["a", "b"], idle_aware=True)


# --- panes and late data -----------------------------------------------------------------------


def _panes(spark: SparkSession, folder: str, **how) -> DataFrame:
    return pn.panes(arriving(spark, folder), "event_type", "value", DAY_S, LATENESS_S, **how)


@query
def panes_accumulating(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.per_slice())


@query
def panes_discarding(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.per_slice(), accumulating=False)


@query
def panes_early_count(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.after_count(10))


@query
def panes_late_per_slice(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, late="per_slice")


@query
def panes_after_any(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.any_of(7), accumulating=False)


@query
def panes_after_all(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.all_of(25))


@query
def panes_after_each(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.each_of(20))


@query
def panes_once(spark: SparkSession, folder: str) -> DataFrame:
    return _panes(spark, folder, early=pn.once(pn.after_count(5)))


@query
def panes_final_equivalence(spark: SparkSession, folder: str) -> DataFrame:
    ev = arriving(spark, folder)
    slices = wm.slice_watermarks(ev)
    both = [
        pn.panes(ev, "event_type", "value", DAY_S, LATENESS_S, early=pn.per_slice(), accumulating=acc, slices=slices)
        for acc in (True, False)
    ]
    return pn.final_values(*both, key="event_type")


@query
def late_lifecycle(spark: SparkSession, folder: str) -> DataFrame:
    rows = pn.row_status(arriving(spark, folder), DAY_S, LATENESS_S)
    return rows.select("event_id", "event_type", "win_end_us", "status")


@query
def late_dropped_counts(spark: SparkSession, folder: str) -> DataFrame:
    return pn.status_counts(arriving(spark, folder), DAY_S, LATENESS_S)


# --- state ------------------------------------------------------------------------------------


@query
def state_sessions(spark: SparkSession, folder: str) -> DataFrame:
    found = sessions.session_summaries(events(spark, folder), "user_id", GAP_S, BURST)
    return found.select("user_id", "events", "ended_us", _as_text("sample_values").alias("sample_values"), "flag")


@query
def state_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return sessions.first_seen(arriving(spark, folder), ["user_id", "event_type"])


@query
def rate_limit(spark: SparkSession, folder: str) -> DataFrame:
    passed = sessions.rate_limit(events(spark, folder), "user_id", limit=2, period_s=DAY_S)
    return passed.select("user_id", "period", "nth", "event_id")


@query
def join_with_timeout(spark: SparkSession, folder: str) -> DataFrame:
    ev = events(spark, folder).select("user_id", "ts_us", "event_id", "event_type")
    clicks = ev.where(F.col("event_type") == "click")
    purchases = ev.where(F.col("event_type") == "purchase")
    return sessions.join_with_timeout(clicks, purchases, "user_id", DAY_S).select(
        "user_id", "event_id", "matched_us", "matched"
    )


# --- the flagship -----------------------------------------------------------------------------


@query
def valid_revenue_by_region(spark: SparkSession, folder: str) -> DataFrame:
    """Validated orders, priced per region and thirty-day window."""
    valid = routing.valid_rows(validated_orders(spark, folder))
    return win.aggregate_windows(
        valid, "region_name", win.fixed(30 * DAY_S), n=F.count(F.lit(1)), total=F.round(F.sum("amount"), 2)
    )
