"""Early, on-time and late panes of fixed windows, over arrival slices.

Rows are first reduced to one cell per (key, window, slice), because every row of a cell meets the same
watermark and so has the same status. Only triggers that count rows, and one pane per late row, go
back to single rows, and those are ranked with ``prefix_scan``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.functions.numeric import US
from tideline.operators.scan import prefix_scan
from tideline.operators.watermarks import slice_watermarks, window_end, with_status, with_watermark
from tideline.session import settle
from tideline.sources.arrivals import with_arrival_minute


@dataclass(frozen=True)
class Early:
    """When a window fires before its watermark.

    ``slice``: at the end of each slice with new rows (the processing-time tick).
    ``count``: after every ``n`` rows. ``any``: at whichever of the two comes first.
    ``all``: at the end of the slice that completes ``n`` rows since the last pane.
    ``each``: after ``n`` rows, then at the end of the slice, in turn.
    Without ``repeat`` the trigger fires once (``each``: its two halves once each).
    """

    kind: str
    n: int = 1
    repeat: bool = True


def per_slice() -> Early:
    return Early("slice")


def after_count(n: int) -> Early:
    return Early("count", n)


def any_of(n: int) -> Early:
    return Early("any", n)


def all_of(n: int) -> Early:
    return Early("all", n)


def each_of(n: int) -> Early:
    return Early("each", n)


def once(trigger: Early) -> Early:
    return Early(trigger.kind, trigger.n, repeat=False)


# Order of the three kinds of firing inside one window.
_EARLY, _ON_TIME, _LATE = 0, 1, 2


def _early_sums(kind_n: Early, keys: list[str], cells: DataFrame, early_rows) -> DataFrame:
    """Rows (keys, b1, b2, o1, delta, rows) of the early panes. ``b1 < b2 < o1`` order the panes."""
    n = kind_n.n
    early = cells.where(F.col("status") == "EARLY")
    zero = F.lit(0).cast("bigint")
    if kind_n.kind == "slice":
        return early.select(*keys, F.col("slice").alias("b1"), zero.alias("b2"), zero.alias("o1"), "delta", "rows")

    if kind_n.kind == "all":
        # The slices of one window, in order, folded until n rows are together.
        start = F.struct(
            F.lit(0).cast("bigint").alias("held"),
            F.expr("cast(array() as array<struct<slice: bigint, pane: bigint>>)").alias("out"),
            F.lit(0).cast("bigint").alias("pane"),
        )

        def step(acc: Column, cell: Column) -> Column:
            held = acc["held"] + cell["rows"]
            fires = held >= n
            return F.struct(
                F.when(fires, F.lit(0)).otherwise(held).cast("bigint").alias("held"),
                F.concat(
                    acc["out"], F.array(F.struct(cell["slice"].alias("slice"), acc["pane"].alias("pane")))
                ).alias("out"),
                (acc["pane"] + F.when(fires, 1).otherwise(0)).cast("bigint").alias("pane"),
            )

        def finish(acc: Column) -> Column:
            # Slices after the last full pane stay unfired.
            return F.filter(acc["out"], lambda s: s["pane"] < acc["pane"])

        slices = early.groupBy(*keys).agg(
            F.sort_array(F.collect_list(F.struct("slice", "rows"))).alias("__cells")
        )
        panes_of = slices.select(
            *keys, F.explode(F.aggregate("__cells", start, step, finish)).alias("__s")
        ).select(*keys, F.col("__s.slice").alias("slice"), F.col("__s.pane").alias("b1"))
        return (
            early.join(panes_of, [*keys, "slice"])
            .groupBy(*keys, "b1")
            .agg(F.sum("delta").alias("delta"), F.sum("rows").alias("rows"))
            .select(*keys, "b1", zero.alias("b2"), zero.alias("o1"), "delta", "rows")
        )

    rows = early_rows()
    if kind_n.kind == "count":
        ranked = prefix_scan(
            rows, keys, ["slice", "arrival_min"], ["arrival_us", "__id"],
            sums={"rank": F.lit(1).cast("bigint")}, totals={"total": "rank"},
        )
        pane = F.floor((F.col("rank") - 1) / n).cast("bigint")
        full = ranked.withColumn("o1", pane).where((F.col("o1") + 1) * n <= F.col("total"))
        full = full.withColumns(
            {"b1": F.floor(F.col("o1") / 1_000_000).cast("bigint"), "b2": F.floor(F.col("o1") / 1_000).cast("bigint")}
        )
    elif kind_n.kind == "any":
        ranked = prefix_scan(
            rows, [*keys, "slice"], ["arrival_min"], ["arrival_us", "__id"],
            sums={"rank": F.lit(1).cast("bigint")},
        )
        full = ranked.withColumns(
            {"b1": F.col("slice"), "o1": F.floor((F.col("rank") - 1) / n).cast("bigint")}
        ).withColumn("b2", F.floor(F.col("o1") / 1_000).cast("bigint"))
    elif kind_n.kind == "each":
        full = _each_panes(rows, early, keys, n)
    else:
        raise ValueError(f"unknown early trigger {kind_n.kind!r}")
    return full.groupBy(*keys, "b1", "b2", "o1").agg(
        F.sum("__v").alias("delta"), F.count(F.lit(1)).alias("rows")
    )


def _each_panes(rows: DataFrame, early: DataFrame, keys: list[str], n: int) -> DataFrame:
    """``each``: fold the slice counts of a window to the rank, inside each slice, that completes n.

    A slice that starts in the counting phase and completes n rows fires a count pane there; the rest
    of its rows, or a slice that starts in the tick phase, fire at the end of the slice.
    """
    empty = "cast(array() as array<struct<slice: bigint, first: bigint, cut: bigint, left: bigint>>)"
    start = F.struct(
        F.lit(0).cast("bigint").alias("held"),
        F.lit(True).alias("counting"),
        F.lit(0).cast("bigint").alias("pane"),
        F.expr(empty).alias("out"),
    )

    def step(acc: Column, cell: Column) -> Column:
        need = F.lit(n) - acc["held"]
        completes = acc["counting"] & (cell["rows"] >= need)
        left = F.when(completes, cell["rows"] - need).otherwise(F.lit(0))
        ticks = ~acc["counting"] | (left > 0)
        # cut: rows of the slice that belong to pane `first`; later rows belong to the next one.
        cut = F.when(completes, need).otherwise(cell["rows"])
        fired = F.when(completes, 1).otherwise(0) + F.when(ticks, 1).otherwise(0)
        return F.struct(
            F.when(acc["counting"] & ~completes, acc["held"] + cell["rows"]).otherwise(0).cast("bigint").alias("held"),
            F.when(acc["counting"], ~completes | (left > 0)).otherwise(F.lit(True)).alias("counting"),
            (acc["pane"] + fired).cast("bigint").alias("pane"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        cell["slice"].alias("slice"),
                        acc["pane"].alias("first"),
                        cut.cast("bigint").alias("cut"),
                        left.cast("bigint").alias("left"),
                    )
                ),
            ).alias("out"),
        )

    folded = early.groupBy(*keys).agg(
        F.aggregate(
            F.sort_array(F.collect_list(F.struct("slice", "rows"))),
            start,
            step,
            lambda acc: F.struct(acc["out"].alias("out"), acc["pane"].alias("panes")),
        ).alias("__f")
    )
    plan = folded.select(*keys, F.explode("__f.out").alias("__s"), F.col("__f.panes").alias("panes")).select(
        *keys, "panes", "__s.*"
    )
    ranked = prefix_scan(
        rows, [*keys, "slice"], ["arrival_min"], ["arrival_us", "__id"],
        sums={"rank": F.lit(1).cast("bigint")},
    )
    pane = F.col("first") + F.when(F.col("rank") > F.col("cut"), 1).otherwise(0)
    zero = F.lit(0).cast("bigint")
    return (
        ranked.join(plan, [*keys, "slice"])
        .withColumns({"b1": pane.cast("bigint"), "b2": zero, "o1": zero})
        .where(F.col("b1") < F.col("panes"))
    )


def units(value: Column, digits: int) -> Column:
    """Amounts as whole units of ``10 ** -digits``, which add up the same in any order."""
    return F.coalesce(F.rint(value * F.lit(10.0**digits)).cast("bigint"), F.lit(0).cast("bigint"))


def panes(
    df: DataFrame,
    key: str,
    value: str,
    size_s: int,
    lateness_s: int = 0,
    disorder_s: int = 0,
    early: Early | None = None,
    late: str = "per_element",
    accumulating: bool = True,
    row_id: str = "event_id",
    slices: DataFrame | None = None,
    digits: int = 6,
) -> DataFrame:
    """All panes of all fixed windows: one row per firing, with its timing and place in the sequence.

    Needs ``ts_us``, ``arrival_us`` and ``slice``. Rows that arrive after the window end plus
    ``lateness_s`` are in no pane. ``late`` is ``per_element`` or ``per_slice``. Values are added as
    whole units of ``10 ** -digits``, as in the streaming form; a NULL value adds nothing.
    """
    if late not in ("per_element", "per_slice"):
        raise ValueError("late must be 'per_element' or 'per_slice'")
    slices = slice_watermarks(df, disorder_s) if slices is None else slices
    keys = [key, "win_end_us"]
    amount = units(F.col(value), digits)
    rows = df.select(
        key,
        window_end(F.col("ts_us"), size_s).alias("win_end_us"),
        "slice",
        "arrival_us",
        F.col(row_id).alias("__id"),
        amount.alias("__v"),
    )
    reduced = rows.groupBy(*keys, "slice").agg(F.sum("__v").alias("delta"), F.count(F.lit(1)).alias("rows"))
    # Far fewer than the rows, and read by every branch below: written once.
    cells = settle(with_status(with_watermark(reduced, slices), lateness_s), "cells")

    def rows_with(status: str):
        return lambda: with_arrival_minute(
            with_status(with_watermark(rows, slices), lateness_s).where(F.col("status") == status)
        )

    zero = F.lit(0).cast("bigint")
    place = ["b1", "b2", "o1", "o2"]
    firings = None
    if early is not None:
        fired = _early_sums(early, keys, cells, rows_with("EARLY")).select(
            *keys, F.lit(_EARLY).alias("phase"), "b1", "b2", "o1", zero.alias("o2"), "delta", "rows"
        )
        if not early.repeat and early.kind == "each":
            fired = fired.where(F.col("b1") < 2)
        elif not early.repeat:
            first = F.min_by(F.struct("phase", *place, "delta", "rows"), F.struct(*place)).alias("__1")
            fired = fired.groupBy(*keys).agg(first).select(*keys, "__1.*")
        # Panes that took a scan of single rows are used three times below.
        firings = fired if early.kind in ("slice", "all") else settle(fired, "early")

    # Whatever no early pane has taken goes into the on-time pane, even if that leaves nothing.
    held = cells.where(F.col("status").isin("EARLY", "ON_TIME")).select(*keys, "delta")
    if firings is not None:
        held = held.unionByName(firings.select(*keys, (-F.col("delta")).alias("delta")))
    on_time = held.groupBy(*keys).agg(F.sum("delta").alias("delta")).select(
        *keys, F.lit(_ON_TIME).alias("phase"), *[zero.alias(c) for c in place], "delta", zero.alias("rows")
    )
    firings = on_time if firings is None else firings.unionByName(on_time)

    if late == "per_slice":
        late_firings = cells.where(F.col("status") == "LATE").select(
            *keys, F.lit(_LATE).alias("phase"), F.col("slice").alias("b1"),
            zero.alias("b2"), zero.alias("o1"), zero.alias("o2"), "delta", "rows",
        )
    else:
        late_firings = rows_with("LATE")().select(
            *keys, F.lit(_LATE).alias("phase"), F.col("slice").alias("b1"),
            F.col("arrival_min").alias("b2"), F.col("arrival_us").alias("o1"),
            F.col("__id").cast("bigint").alias("o2"), F.col("__v").alias("delta"),
            F.lit(1).cast("bigint").alias("rows"),
        )
    firings = firings.drop("rows").unionByName(late_firings.drop("rows"))

    scanned = prefix_scan(
        firings.withColumn("at", F.struct("phase", "b1")), keys, ["at", "b2"], ["o1", "o2"],
        sums={"seq": F.lit(1).cast("bigint"), "running": F.col("delta")},
        totals={"panes": "seq"},
    )
    total = F.col("running") if accumulating else F.col("delta")
    timing = F.when(F.col("phase") == _EARLY, "EARLY").when(F.col("phase") == _ON_TIME, "ON_TIME").otherwise("LATE")
    return scanned.select(
        key,
        (F.col("win_end_us") - size_s * US).alias("win_start_us"),
        "win_end_us",
        (F.col("seq") - 1).alias("pane_index"),
        timing.alias("timing"),
        (F.col("seq") == 1).alias("is_first"),
        (F.col("seq") == F.col("panes")).alias("is_last"),
        (total / F.lit(10.0**digits)).alias("value"),
    )


def final_values(accumulating: DataFrame, discarding: DataFrame, key: str, digits: int = 6) -> DataFrame:
    """What an upsert sink keeps of accumulating panes, next to what an adding sink makes of
    discarding ones."""
    keys = [key, "win_end_us"]
    kept = accumulating.groupBy(*keys).agg(F.max_by("value", "pane_index").alias("upserted"))
    added = discarding.groupBy(*keys).agg(F.round(F.sum("value"), digits).alias("added"))
    return kept.join(added, keys, "full_outer").withColumn("agree", F.col("upserted") == F.col("added"))


def row_status(df: DataFrame, size_s: int, lateness_s: int, slices: DataFrame | None = None) -> DataFrame:
    """Add ``win_end_us`` and ``status`` to every row, dropped ones included."""
    slices = slice_watermarks(df) if slices is None else slices
    marked = df.withColumn("win_end_us", window_end(F.col("ts_us"), size_s))
    return with_status(with_watermark(marked, slices), lateness_s)


def status_counts(df: DataFrame, size_s: int, lateness_s: int) -> DataFrame:
    """Rows per status, counted per (window, slice) cell first."""
    slices = slice_watermarks(df)
    cells = (
        df.withColumn("win_end_us", window_end(F.col("ts_us"), size_s))
        .groupBy("win_end_us", "slice")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    marked = with_status(with_watermark(cells, slices), lateness_s)
    return marked.groupBy("status").agg(F.sum("rows").alias("n"))


def observe_late(rows: DataFrame, observation) -> DataFrame:
    """Count late and dropped rows as a side effect of whatever job consumes ``rows``."""
    return rows.observe(
        observation,
        F.count_if(F.col("status") == "LATE").alias("late_elements"),
        F.count_if(F.col("status") == "DROPPED").alias("dropped_elements"),
    )

