"""Plain SQL for every query, over the same tables. Written row by row from the definitions, without
the pre-aggregation and bucketing of the Spark plans."""

from __future__ import annotations

from tideline.sources.arrivals import COARSE, SIX_HOURLY, TARDY, ArrivalModel

S = 1_000_000
DAY = 86_400 * S
HOUR = 3_600 * S
LATENESS = 6 * HOUR
GAP = 6 * HOUR

ORACLES: dict[str, str] = {}


def arrival_cte(m: ArrivalModel = SIX_HOURLY) -> str:
    return f"""
    timed AS (
        SELECT *, epoch_us(ts) AS ts_us,
            epoch_us(ts) + {S} * CASE WHEN event_id % {m.stuck_every} = 0 THEN {m.stuck_s}
                WHEN event_id % {m.slow_every} = 0 THEN {m.slow_s}
                ELSE (event_id * 31 % {m.spread}) * {m.step_s} END AS arrival_us
        FROM events),
    arr AS (SELECT *, arrival_us // {m.slice_s * S} AS slice FROM timed)"""


def status_cte(m: ArrivalModel = SIX_HOURLY, lateness: int = LATENESS, size: int = DAY) -> str:
    """``st``: every row with its window end ``e`` and status."""
    return f"""{arrival_cte(m)},
    maxima AS (SELECT slice, max(ts_us) AS top, max(arrival_us) AS last_arrival FROM arr GROUP BY slice),
    wm AS (
        SELECT slice, last_arrival,
            max(top) OVER (ORDER BY slice ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b,
            max(top) OVER (ORDER BY slice) AS a
        FROM maxima),
    st AS (
        SELECT arr.event_type, arr.event_id, arr.slice, arr.arrival_us, arr.value::DECIMAL(24,6) AS v,
            ts_us - ts_us % {size} + {size} AS e,
            CASE WHEN b >= e + {lateness} THEN 'DROPPED' WHEN b >= e THEN 'LATE'
                WHEN a >= e THEN 'ON_TIME' ELSE 'EARLY' END AS status
        FROM arr JOIN wm USING (slice))"""


def panes_sql(
    early: str | None,
    n: int = 1,
    late: str = "per_element",
    accumulating: bool = True,
    once: bool = False,
    m: ArrivalModel = SIX_HOURLY,
    lateness: int = LATENESS,
    size: int = DAY,
    columns: str = "event_type, e - {d} AS win_start_us, e AS win_end_us, pane_index, timing, is_first, is_last, value",
) -> str:
    cells = """
    cells AS (
        SELECT event_type, e, slice, count(*) AS c,
            row_number() OVER (PARTITION BY event_type, e ORDER BY slice) AS i
        FROM st WHERE status = 'EARLY' GROUP BY event_type, e, slice)"""
    ranks = """
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY event_type, e ORDER BY arrival_us, event_id) AS r,
            count(*) OVER (PARTITION BY event_type, e) AS total,
            row_number() OVER (PARTITION BY event_type, e, slice ORDER BY arrival_us, event_id) AS rs
        FROM st WHERE status = 'EARLY')"""
    if early is None:
        pane = "pane AS (SELECT event_type, e, 0 AS p1, 0 AS p2, v FROM st WHERE false)"
    elif early == "slice":
        pane = "pane AS (SELECT event_type, e, slice AS p1, 0 AS p2, v FROM st WHERE status = 'EARLY')"
    elif early == "count":
        limit = "AND r <= {n}" if once else ""
        pane = f"""{ranks},
        pane AS (SELECT event_type, e, (r - 1) // {n} AS p1, 0 AS p2, v FROM ranked
            WHERE ((r - 1) // {n} + 1) * {n} <= total {limit.format(n=n)})"""
    elif early == "any":
        pane = f"{ranks}, pane AS (SELECT event_type, e, slice AS p1, (rs - 1) // {n} AS p2, v FROM ranked)"
    elif early == "all":
        pane = f"""{cells},
        fold AS (
            SELECT event_type, e, slice, i, 0::BIGINT AS p, c >= {n} AS fires, c AS held FROM cells WHERE i = 1
            UNION ALL
            SELECT k.event_type, k.e, k.slice, k.i, f.p + f.fires::INT,
                k.c + CASE WHEN f.fires THEN 0 ELSE f.held END >= {n},
                k.c + CASE WHEN f.fires THEN 0 ELSE f.held END
            FROM fold f JOIN cells k ON k.event_type = f.event_type AND k.e = f.e AND k.i = f.i + 1),
        done AS (SELECT event_type, e, p FROM fold WHERE fires),
        pane AS (SELECT st.event_type, st.e, f.p AS p1, 0 AS p2, v
            FROM st JOIN fold f USING (event_type, e, slice) JOIN done d
                ON d.event_type = st.event_type AND d.e = st.e AND d.p = f.p WHERE status = 'EARLY')"""
    else:
        # State after each slice: pane number, whether rows are being counted, rows counted so far.
        pane = f"""{cells}, {ranks},
        fold AS (
            SELECT event_type, e, slice, i, 0::BIGINT AS p, CASE WHEN c >= {n} THEN {n} ELSE c END AS cut,
                ((c >= {n})::INT + (c > {n})::INT)::BIGINT AS fired,
                NOT (c = {n}) AS counting, CASE WHEN c < {n} THEN c ELSE 0 END AS held
            FROM cells WHERE i = 1
            UNION ALL
            SELECT k.event_type, k.e, k.slice, k.i, f.p + f.fired,
                CASE WHEN f.counting AND k.c >= {n} - f.held THEN {n} - f.held ELSE k.c END,
                CASE WHEN NOT f.counting THEN 1
                    ELSE (k.c >= {n} - f.held)::INT + (k.c > {n} - f.held)::INT END,
                NOT f.counting OR k.c <> {n} - f.held,
                CASE WHEN f.counting AND k.c < {n} - f.held THEN f.held + k.c ELSE 0 END
            FROM fold f JOIN cells k ON k.event_type = f.event_type AND k.e = f.e AND k.i = f.i + 1),
        last AS (SELECT event_type, e, max(p + fired) AS panes FROM fold GROUP BY event_type, e),
        placed AS (SELECT r.event_type, r.e, f.p + (r.rs > f.cut)::INT AS p1, 0 AS p2, v
            FROM ranked r JOIN fold f USING (event_type, e, slice)),
        pane AS (SELECT placed.* FROM placed JOIN last USING (event_type, e) WHERE p1 < panes)"""
    if late == "per_element":
        late_f = "SELECT event_type, e, 2 AS phase, arrival_us AS p1, event_id AS p2, v AS d FROM st WHERE status = 'LATE'"
    else:
        late_f = "SELECT event_type, e, 2, slice, 0, sum(v) FROM st WHERE status = 'LATE' GROUP BY event_type, e, slice"
    value = "sum(d) OVER w" if accumulating else "d"
    recursive = "RECURSIVE" if early in ("all", "each") else ""
    return f"""
    WITH {recursive} {status_cte(m, lateness, size)},
    {pane},
    early_f AS (SELECT event_type, e, 0 AS phase, p1::BIGINT AS p1, p2::BIGINT AS p2, sum(v) AS d FROM pane GROUP BY event_type, e, p1, p2),
    on_time AS (
        SELECT s.event_type, s.e, 1 AS phase, 0 AS p1, 0 AS p2, s.d - coalesce(p.d, 0) AS d
        FROM (SELECT event_type, e, sum(v) AS d FROM st WHERE status IN ('EARLY', 'ON_TIME') GROUP BY event_type, e) s
        LEFT JOIN (SELECT event_type, e, sum(v) AS d FROM pane GROUP BY event_type, e) p
            ON p.event_type = s.event_type AND p.e = s.e),
    firing AS (SELECT * FROM early_f UNION ALL SELECT * FROM on_time UNION ALL {late_f}),
    numbered AS (
        SELECT event_type, e, row_number() OVER w - 1 AS pane_index,
            CASE phase WHEN 0 THEN 'EARLY' WHEN 1 THEN 'ON_TIME' ELSE 'LATE' END AS timing,
            row_number() OVER w = 1 AS is_first,
            row_number() OVER w = count(*) OVER (PARTITION BY event_type, e) AS is_last,
            ({value})::DOUBLE AS value
        FROM firing
        WINDOW w AS (PARTITION BY event_type, e ORDER BY phase, p1, p2))
    SELECT {columns.format(d=size)} FROM numbered"""


WORDS = """
    SELECT word, count(*) AS n
    FROM (SELECT unnest(regexp_extract_all(lower(text), '[A-Za-z'']+')) AS word FROM documents)
    GROUP BY word"""

VALIDATED = """
    WITH raw AS (
        SELECT o_orderkey AS id,
            CASE WHEN o_orderkey % 37 = 0 THEN 'ZZ' ELSE n_regionkey::VARCHAR END AS region,
            CASE WHEN o_orderkey % 31 = 0 THEN NULL
                WHEN o_orderkey % 41 = 0 THEN -o_totalprice ELSE o_totalprice END AS amount,
            o_orderdate
        FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey),
    checked AS (
        SELECT id, region, amount, o_orderdate, r_name,
            CASE WHEN amount IS NULL OR region IS NULL THEN 'missing field (region/amount)'
                WHEN r_name IS NULL THEN 'unknown region ''' || region || ''''
                WHEN amount <= 0 THEN 'non-positive amount ' || amount::VARCHAR END AS error
        FROM raw LEFT JOIN region ON r_regionkey::VARCHAR = region)"""


def sessions_cte(source: str, gap: int, strict: bool = False) -> str:
    """``ses``: rows with the number of their session per user; ``source`` has user_id, ts_us."""
    test = ">=" if strict else ">"
    return f"""
    lagged AS (SELECT *, lag(ts_us) OVER (PARTITION BY user_id ORDER BY ts_us, event_id) AS prev FROM {source}),
    ses AS (
        SELECT *, sum(CASE WHEN prev IS NULL OR ts_us - prev {test} {gap} THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY ts_us, event_id) AS s
        FROM lagged)"""


EV_US = "src AS (SELECT *, epoch_us(ts) AS ts_us FROM events)"


def fixed_sql(key: str, select: str, size: int = DAY) -> str:
    return f"""SELECT {key}, ts_us - ts_us % {size} AS win_start_us, ts_us - ts_us % {size} + {size} AS win_end_us,
        {select} FROM (SELECT *, epoch_us(ts) AS ts_us FROM events) GROUP BY ALL"""


def sliding_sql(key: str) -> str:
    return f"""SELECT {key}, start AS win_start_us, start + {DAY} AS win_end_us, count(*) AS n
        FROM (SELECT {key}, unnest([t - t % {DAY // 2}, t - t % {DAY // 2} - {DAY // 2}]) AS start
              FROM (SELECT {key}, epoch_us(ts) AS t FROM events))
        GROUP BY ALL"""


def session_sql(gap: int, strict: bool = False, unit: int = 1) -> str:
    return f"""WITH src AS (SELECT *, epoch_us(ts) // {unit} * {unit} AS ts_us FROM events), {sessions_cte('src', gap, strict)}
        SELECT user_id, min(ts_us) AS win_start_us, max(ts_us) + {gap} AS win_end_us, count(*) AS n
        FROM ses GROUP BY user_id, s"""


WINDOW_COUNTS = fixed_sql("event_type", "count(*) AS n")
SESSION_SUMMARIES = f"""
    WITH {EV_US}, {sessions_cte('src', GAP)}
    SELECT user_id, count(*) AS events, max(ts_us) AS ended_us,
        array_to_string(list_slice(list(value::VARCHAR ORDER BY ts_us, event_id), 1, 5), ',') AS sample_values,
        CASE WHEN count(*) >= 4 THEN 'BURST' ELSE 'ok' END AS flag
    FROM ses GROUP BY user_id, s"""
def channels_cte(m: ArrivalModel = SIX_HOURLY) -> str:
    """``run``: newest event times of the inputs a and b in each slice, and so far."""
    return f"""{arrival_cte(m)},
    ch AS (SELECT slice, max(ts_us) FILTER (WHERE channel = 'a') AS a, max(ts_us) FILTER (WHERE channel = 'b') AS b
        FROM (SELECT *, CASE WHEN user_id % 2 = 0 AND slice % 8 NOT IN (4, 5, 6) THEN 'b' ELSE 'a' END AS channel
              FROM arr) GROUP BY slice),
    run AS (SELECT slice, a, b, max(a) OVER (ORDER BY slice) AS ra, max(b) OVER (ORDER BY slice) AS rb FROM ch)"""


def merged_sql(m: ArrivalModel = SIX_HOURLY, idle: bool = False, unit: int = 1) -> str:
    """The watermark of both inputs after each slice, down to whole ``unit`` microseconds."""
    least = "CASE WHEN ra IS NULL OR rb IS NULL THEN NULL ELSE least(ra, rb) END"
    if idle:
        least = """max(CASE WHEN ra IS NULL OR rb IS NULL THEN NULL
                WHEN a IS NULL THEN rb WHEN b IS NULL THEN ra ELSE least(ra, rb) END) OVER (ORDER BY slice)"""
    return f"WITH {channels_cte(m)} SELECT slice, {least} // {unit} * {unit} AS wm_us FROM run"


CLOSED = f"""
    WITH {status_cte(lateness=0)},
    counts AS (SELECT event_type, e, count(*) AS n FROM st WHERE status IN ('EARLY', 'ON_TIME') GROUP BY event_type, e)
    SELECT event_type, e AS win_end_us, n,
        (SELECT min(slice) FROM wm WHERE a >= e) AS fired_slice,
        (SELECT min(last_arrival) FROM wm WHERE a >= e) AS fired_arrival
    FROM counts"""

ORACLES.update(
    {
        "wordcount": WORDS,
        "text_sink_roundtrip": f"SELECT word || ': ' || n::VARCHAR AS line FROM ({WORDS})",
        "create_inline": """
            SELECT user_id, count(*) AS n, sum(coalesce(weight, 0))::BIGINT AS weight
            FROM events LEFT JOIN (VALUES ('click', 1), ('view', 2), ('signup', 3), ('purchase', 5), ('error', 0))
                w(event_type, weight) USING (event_type) GROUP BY user_id""",
        "csv_parse_roundtrip": f"""
            SELECT (epoch_us(ts) // {S})::DOUBLE AS event_time, event_type AS key, user_id, event_id AS id, value
            FROM events""",
        "replay_arrival_order": f"""
            WITH {arrival_cte()}
            SELECT event_id, slice, arrival_us, row_number() OVER (ORDER BY arrival_us, event_id) - 1 AS arrival_seq
            FROM arr""",
        "synthetic_events": f"""
            SELECT 'sensor-' || (seq % 3)::VARCHAR AS key, seq % 100 + 1 AS value, seq, seq - 8 AS event_s
            FROM (SELECT epoch_us(ts) // {S} AS seq FROM events)""",
        "offset_range_by_digit": """
            SELECT o % 10 AS digit, count(*) AS n, sum(o)::BIGINT AS total, max(o) AS last
            FROM (SELECT unnest(range(l_quantity::BIGINT)) AS o FROM lineitem) GROUP BY digit""",
        "score_and_keep": """
            SELECT c_custkey, c_name, c_nationkey, (length(c_name) * c_nationkey)::INTEGER AS score FROM customer
            WHERE length(c_name) * c_nationkey >= 200""",
        "batched_enrich": """
            SELECT event_id, event_type, (props::JSON ->> 'k')::BIGINT AS k FROM events WHERE event_type <> 'error'""",
        "element_anatomy": f"""
            SELECT event_id, t AS event_s, t - t % 86400 AS window_start_s, t - t % 86400 + 86400 AS window_end_s,
                'UNKNOWN' AS timing, 0::BIGINT AS pane_index, strftime(ts, '%H:%M:%S') AS clock
            FROM (SELECT *, epoch_us(ts) // {S} AS t FROM events)""",
        "event_skew": f"""
            WITH {arrival_cte()}
            SELECT event_id, arrival_us - ts_us AS skew_us,
                coalesce(ts_us < max(ts_us) OVER (ORDER BY arrival_us, event_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS out_of_order
            FROM arr""",
        "group_values": """
            SELECT o_custkey, ceil(count(*) OVER k / 8.0)::BIGINT AS parts, count(*) OVER k AS total, o_orderkey
            FROM orders WINDOW k AS (PARTITION BY o_custkey)""",
        "combine_mean_custom": """
            SELECT l_suppkey, round(sum(l_extendedprice) / count(*), 4) AS mean
            FROM lineitem GROUP BY l_suppkey""",
        "mean_global": "SELECT round(sum(value) / count(*), 4) AS mean FROM events",
        "count_all": "SELECT count(*) AS n FROM lineitem",
        "top_n_global": "SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 3",
        "top_n_per_key": """
            SELECT user_id, event_id, value, rank FROM (
                SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS rank FROM events)
            WHERE rank <= 3""",
        "sample_fixed_size": """
            SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(o_orderkey::VARCHAR || '-7'), o_orderkey LIMIT 100""",
        "distinct_pairs": "SELECT DISTINCT user_id, event_type FROM events",
        "cogroup_lists": """
            WITH rows AS (
                SELECT user_id AS customer, 'events' AS side, event_id AS id FROM events
                UNION ALL SELECT o_custkey, 'orders', o_orderkey FROM orders),
            sized AS (
                SELECT *, count(*) FILTER (side = 'events') OVER (PARTITION BY customer) AS events_total,
                    count(*) FILTER (side = 'orders') OVER (PARTITION BY customer) AS orders_total FROM rows)
            SELECT customer, greatest(ceil(greatest(events_total, orders_total) / 20.0), 1)::BIGINT AS parts,
                events_total, orders_total, side, id FROM sized""",
        "left_enrich": """
            SELECT doc_id, lang, source, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic
            FROM documents LEFT JOIN (
                SELECT * FROM labels QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY quality) = 1
            ) USING (doc_id)""",
        "union_all": """
            SELECT customer, kind, count(*) AS n FROM (
                SELECT user_id AS customer, 'event' AS kind FROM events
                UNION ALL SELECT o_custkey, 'order' FROM orders) GROUP BY customer, kind""",
        "validate_tagged": f"""{VALIDATED}
            SELECT id, region, amount, CASE WHEN error IS NULL THEN r_name END AS region_name, error FROM checked""",
        "side_singleton": """
            SELECT o_orderkey, o_totalprice FROM orders
            WHERE o_totalprice > (SELECT avg(o_totalprice) FROM orders)""",
        "side_list_semi": """
            SELECT o_custkey, o_orderkey,
                CASE WHEN o_custkey IN (SELECT user_id FROM events WHERE event_type = 'purchase')
                    THEN 'listed' ELSE 'unlisted' END AS side
            FROM orders""",
        "dead_letter": f"{VALIDATED} SELECT id, region, amount, error FROM checked WHERE error IS NOT NULL",
        "dead_letter_roundtrip": f"{VALIDATED} SELECT id, region, amount, error FROM checked WHERE error IS NOT NULL",
        "tagged_outputs": f"""{VALIDATED}
            SELECT CASE WHEN error IS NULL THEN 'valid' ELSE 'dead_letter' END AS output, region, count(*) AS n
            FROM checked GROUP BY output, region""",
        "partition_by_tier": f"""{VALIDATED}
            SELECT CASE WHEN amount < 50000 THEN 0 WHEN amount < 250000 THEN 1 ELSE 2 END AS part,
                r_name AS region_name, count(*) AS n, round(sum(amount), 2) AS total
            FROM checked WHERE error IS NULL GROUP BY part, region_name""",
        "valid_revenue_by_region": f"""{VALIDATED}
            SELECT r_name AS region_name, t - t % {30 * DAY} AS win_start_us, t - t % {30 * DAY} + {30 * DAY} AS win_end_us,
                count(*) AS n, round(sum(amount), 2) AS total
            FROM (SELECT *, epoch_us(o_orderdate) AS t FROM checked WHERE error IS NULL) GROUP BY ALL""",
        "window_fixed_count": WINDOW_COUNTS,
        "window_fixed_sum": fixed_sql("event_type", "round(sum(value), 2) AS total"),
        "window_sliding_count": sliding_sql("event_type"),
        "window_session_count": session_sql(GAP),
        "window_session_strict": session_sql(HOUR, strict=True, unit=S),
        "window_global_count": "SELECT user_id, count(*) AS n FROM events GROUP BY user_id",
        "window_family": f"""
            SELECT 'fixed' AS label, * FROM ({fixed_sql('user_id', 'count(*) AS n')})
            UNION ALL SELECT 'sliding', * FROM ({sliding_sql('user_id')})
            UNION ALL SELECT 'session', * FROM ({session_sql(GAP)})
            UNION ALL SELECT 'global', user_id, NULL, NULL, count(*) FROM events GROUP BY user_id""",
        "watermark_closed_windows": f"SELECT event_type, win_end_us, n, fired_slice FROM ({CLOSED})",
        "watermark_trail": f"""
            SELECT event_type, win_end_us, floor((fired_arrival - win_end_us) / {S})::BIGINT AS trail_s
            FROM ({CLOSED})""",
        "watermark_min_inputs": merged_sql(),
        "watermark_min_idle": merged_sql(idle=True),
        "panes_accumulating": panes_sql("slice"),
        "panes_discarding": panes_sql("slice", accumulating=False),
        "panes_early_count": panes_sql("count", 10),
        "panes_late_per_slice": panes_sql(None, late="per_slice"),
        "panes_after_any": panes_sql("any", 7, accumulating=False),
        "panes_after_all": panes_sql("all", 25),
        "panes_after_each": panes_sql("each", 20),
        "panes_once": panes_sql("count", 5, once=True),
        "panes_final_equivalence": f"""
            WITH {status_cte()}
            SELECT event_type, e AS win_end_us, sum(v)::DOUBLE AS upserted, sum(v)::DOUBLE AS added, true AS agree
            FROM st WHERE status <> 'DROPPED' GROUP BY event_type, e""",
        "late_lifecycle": f"WITH {status_cte()} SELECT event_id, event_type, e AS win_end_us, status FROM st",
        "late_dropped_counts": f"WITH {status_cte()} SELECT status, count(*) AS n FROM st GROUP BY status",
        "state_sessions": SESSION_SUMMARIES,
        "state_dedup": f"""
            WITH {arrival_cte()}
            SELECT user_id, event_type, event_id, arrival_us FROM arr
            QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY arrival_us, event_id) = 1""",
        "rate_limit": f"""
            SELECT user_id, period, nth, event_id FROM (
                SELECT *, epoch_us(ts) // {DAY} AS period,
                    row_number() OVER (PARTITION BY user_id, period ORDER BY ts, event_id) AS nth FROM events)
            WHERE nth <= 2""",
        "join_with_timeout": f"""
            WITH {EV_US}
            SELECT c.user_id, c.event_id, min(p.ts_us) AS matched_us, min(p.ts_us) IS NOT NULL AS matched
            FROM src c LEFT JOIN src p ON p.event_type = 'purchase' AND p.user_id = c.user_id
                AND p.ts_us BETWEEN c.ts_us AND c.ts_us + {DAY}
            WHERE c.event_type = 'click' GROUP BY c.user_id, c.event_id""",
    }
)
ORACLES["combine_two_phase"] = ORACLES["combine_mean_builtin"] = ORACLES["combine_mean_custom"]

STREAM_PANES = {"m": TARDY, "lateness": 3 * DAY, "size": 3 * DAY, "columns": "event_type, e AS win_end_us, pane_index, timing, value"}
ORACLES.update(
    {
        **dict.fromkeys(
            ["stream_window_fixed", "restart_counts", "rescale_counts", "idempotent_sink_counts", "restart_after_failure", "transactional_sink_counts", "stream_offset_range"],
            WINDOW_COUNTS,
        ),
        "stream_window_sliding": sliding_sql("event_type"),
        "stream_window_session": session_sql(GAP),
        "stream_panes_accumulating": panes_sql("slice", **STREAM_PANES),
        "stream_panes_discarding": panes_sql("slice", late="per_slice", accumulating=False, **STREAM_PANES),
        "stream_panes_after_any": panes_sql("any", 7, **STREAM_PANES),
        "stream_panes_early_count": panes_sql("count", 10, **STREAM_PANES),
        "stream_panes_after_all": panes_sql("all", 25, **STREAM_PANES),
        "stream_panes_after_each": panes_sql("each", 20, **STREAM_PANES),
        "stream_panes_once": panes_sql("count", 5, once=True, **STREAM_PANES),
        "stream_late_counts": f"WITH {status_cte(TARDY, 3 * DAY, 3 * DAY)} SELECT status, count(*) AS n FROM st GROUP BY status",
        # The engine keeps milliseconds.
        "stream_watermark_min": merged_sql(COARSE, unit=1_000),
        "stream_watermark_min_idle": merged_sql(COARSE, idle=True, unit=1_000),
        "stream_flush_counts": "SELECT event_type, count(*)::BIGINT AS n FROM events GROUP BY event_type",
        "stream_state_sessions": SESSION_SUMMARIES,
        "stream_dedup": "SELECT event_id, user_id, event_type FROM events",
        "stream_rate_limit": f"""
            WITH {arrival_cte()}
            SELECT user_id, period, nth, event_id FROM (
                SELECT *, ts_us // {DAY} AS period,
                    row_number() OVER (PARTITION BY user_id, period ORDER BY arrival_us, event_id) AS nth FROM arr)
            WHERE nth <= 2""",
        "stream_join_with_timeout": ORACLES["join_with_timeout"],
        "kafka_shape_counts": f"""
            SELECT CASE WHEN event_id % 41 = 0 OR event_id % 43 = 0 THEN 'unknown' ELSE 'user-' || user_id END AS user,
                count(*) AS n, t - t % {DAY} AS win_start_us
            FROM (SELECT *, epoch_us(ts) AS t FROM events) GROUP BY ALL""",
    }
)
