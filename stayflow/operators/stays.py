"""Reconstruct unit stays from an admission/transfer/discharge event log.

A stay is a maximal run of consecutive events in the same unit group, after
removing "bridges" (a short trip In and straight back Out of a bridge group such as
the operating room) and ignoring events outside the units. The steps below are the
gaps-and-islands formulation; each is a window over the encounter, all with the same
partitioning and ordering, so the whole chain plans as ONE hash exchange on the
encounter key and one sort (filters in between preserve both).

Input columns (names are parameters): encounter key, an ordering (e.g. sequence
number, direction, event id), unit group, direction ('In'/'Out') and event time.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.functions.expr import boundary_diff, hours_from_minutes, ntz, year_of

IN, OUT = "In", "Out"


def _window(key: str | Sequence[str], order: Sequence[str | Column]):
    keys = [key] if isinstance(key, str) else list(key)
    return Window.partitionBy(*keys).orderBy(*order)


def encounter_bounds(events: DataFrame, key, order, time: str) -> DataFrame:
    """Add HOSP_ADMIT_DT / HOSP_DC_DT: time of the first and last event by order."""
    w = _window(key, order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return events.withColumns({
        "HOSP_ADMIT_DT": F.first(time).over(whole),
        "HOSP_DC_DT": F.last(time).over(whole),
    })


def flag_bridges(events: DataFrame, key, order, group: str, direction: str,
                 bridge_groups: Sequence[str] = ("PERIOP",)) -> DataFrame:
    """Add OUT_PERIOP='YES' to both halves of an adjacent In->Out pair in a bridge group."""
    w = _window(key, order)
    g, d = F.col(group), F.col(direction)
    bridges = list(bridge_groups)
    in_bridge = g.isin(bridges)
    out_half = (F.lag(group).over(w).isin(bridges) & in_bridge
                & (F.lag(direction).over(w) == IN) & (d == OUT))
    in_half = (F.lead(group).over(w).isin(bridges) & in_bridge
               & (F.lead(direction).over(w) == OUT) & (d == IN))
    return events.withColumn("OUT_PERIOP", F.when(out_half | in_half, F.lit("YES")))


def mark_runs(events: DataFrame, key, order, group: str) -> DataFrame:
    """Drop bridge rows; SAME_DEPT='YES' when the previous remaining row has the same group."""
    w = _window(key, order)
    kept = events.filter(F.col("OUT_PERIOP").isNull())
    return kept.withColumn(
        "SAME_DEPT", F.when(F.lag(group).over(w) == F.col(group), F.lit("YES")))


def mark_edges(events: DataFrame, key, order, group: str, time: str,
               outside_groups: Sequence[str] = ("PERIOP", "OTHER")) -> DataFrame:
    """Keep unit rows; VISIT_IN_DT on a run's first row, VISIT_OUT_DT on its last.

    The run marker was computed *before* non-unit rows are dropped, so an OTHER or
    unpaired PERIOP event between two rows of one unit splits the run.
    """
    w = _window(key, order)
    units = events.filter(~F.col(group).isin(list(outside_groups)))
    t = F.col(time)
    return units.withColumns({
        "VISIT_IN_DT": F.when(F.col("SAME_DEPT").isNull(), t),
        "VISIT_OUT_DT": F.when(F.lead("SAME_DEPT").over(w).isNull(), t),
    })


def pair_edges(events: DataFrame, key, order) -> DataFrame:
    """Keep edge rows; OUT_DT = the next edge's VISIT_OUT_DT on a row without its own.

    A one-row run (both edges on one row) gets no OUT_DT and is later dropped.
    """
    w = _window(key, order)
    edges = events.filter(F.col("VISIT_IN_DT").isNotNull() | F.col("VISIT_OUT_DT").isNotNull())
    return edges.withColumns({
        "OUT_DT": F.when(F.col("VISIT_OUT_DT").isNull(), F.lead("VISIT_OUT_DT").over(w)),
        "IN_YEAR": year_of("VISIT_IN_DT"),
    })


def stay_hours(start: str | Column, end: str | Column) -> Column:
    """Length of stay in hours: boundary minutes / 60 as decimal(16,6)."""
    return hours_from_minutes(boundary_diff("MINUTE", start, end))


STEPS = ("bounds", "bridges", "runs", "edges", "pairs")


def _plain_steps(events, key, order, group, direction, time, bridge_groups, outside_groups,
                 upto="pairs"):
    s = encounter_bounds(events, key, order, time)
    if upto == "bounds":
        return s
    s = flag_bridges(s, key, order, group, direction, bridge_groups)
    if upto == "bridges":
        return s
    s = mark_runs(s, key, order, group)
    if upto == "runs":
        return s
    s = mark_edges(s, key, order, group, time, outside_groups)
    if upto == "edges":
        return s
    return pair_edges(s, key, order)


def stay_steps(events: DataFrame, key: str, order: Sequence[str], group: str,
               direction: str, time: str, upto: str = "pairs",
               bridge_groups: Sequence[str] = ("PERIOP",),
               outside_groups: Sequence[str] = ("PERIOP", "OTHER"),
               hot_threshold: int | None = None, chunk_rows: int = 1_000_000,
               hot: DataFrame | None = None) -> DataFrame:
    """The step chain up to ``upto`` (bounds, bridges, runs, edges, pairs).

    Encounters with more than ``hot_threshold`` rows (or listed in ``hot``) take the
    chunked plan (``stays_chunked``), the rest the single-exchange window plan; the
    rows and columns are the same either way.
    """
    if upto not in STEPS:
        raise ValueError(f"upto must be one of {STEPS}")
    if hot is None and hot_threshold is not None:
        hot = hot_keys(events, key, hot_threshold)
    if hot is not None and not hot.isEmpty():
        from stayflow.operators.stays_chunked import build_stays_chunked
        # null-safe: the NULL key can be the largest group
        match = events[key].eqNullSafe(hot[key])
        cold = _plain_steps(events.join(hot, match, "left_anti"), key, order, group, direction,
                            time, bridge_groups, outside_groups, upto)
        big = build_stays_chunked(events.join(hot, match, "left_semi"), key, list(order), group,
                                  direction, time, chunk_rows, bridge_groups, outside_groups,
                                  upto)
        return cold.unionByName(big.select(*cold.columns))
    return _plain_steps(events, key, order, group, direction, time, bridge_groups,
                        outside_groups, upto)


#: Counters of the hot-key sketch, at first.
COUNTERS = 1 << 14


def hot_keys(events: DataFrame, key: str, threshold: int, counters: int = COUNTERS) -> DataFrame:
    """Keys with more than ``threshold`` rows, the NULL key included.

    Found by a sketch of mergeable counters: every task counts its rows by a hash of the key
    in ``counters`` counters, and these are added up, so the shuffle carries counters and not
    keys. A key above the threshold lifts its counter above it, so no hot key is missed; only
    the keys of such counters are then counted one by one (none, as a rule). Where the rows are
    so many that ordinary counters come near the threshold, the sketch is taken once more with
    enough of them. At most rows / threshold keys are returned; they are written out.
    """
    from stayflow.sources.sinks import materialize

    def sketch(width: int):
        counts = events.groupBy(F.pmod(F.xxhash64(key), F.lit(width)).alias("__counter")).agg(
            F.count(F.lit(1)).alias("__n"))
        found = counts.agg(F.sum("__n").alias("rows"), F.collect_list(
            F.when(F.col("__n") > threshold, F.col("__counter"))).alias("full")).first()
        return found["rows"] or 0, found["full"]

    rows, full = sketch(counters)
    needed = 16 * rows // max(1, threshold)
    if full and counters < needed <= 1 << 26:
        counters = needed
        rows, full = sketch(counters)
    if not full:
        return events.sparkSession.createDataFrame([], events.select(key).schema)
    # at most rows / threshold counters are full
    full = F.broadcast(events.sparkSession.createDataFrame([(c,) for c in full], "__counter long"))
    suspects = events.select(key).withColumn("__counter", F.pmod(F.xxhash64(key), F.lit(counters))).join(
        full, "__counter", "left_semi")
    return materialize(suspects.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
                       .filter(F.col("__n") > threshold).select(key), "hot-keys")


def build_stays(events: DataFrame, key, order: Sequence[str | Column], group: str,
                direction: str, time: str,
                bridge_groups: Sequence[str] = ("PERIOP",),
                outside_groups: Sequence[str] = ("PERIOP", "OTHER"),
                min_hours: float | None = 0.5,
                window: tuple[datetime, datetime] | None = None,
                hot_threshold: int | None = None, chunk_rows: int = 1_000_000,
                hot: DataFrame | None = None) -> DataFrame:
    """One row per completed stay (the row holding the stay's first event).

    Adds HOSP_ADMIT_DT, HOSP_DC_DT, OUT_PERIOP, SAME_DEPT, VISIT_IN_DT,
    VISIT_OUT_DT, OUT_DT, IN_YEAR and ICU_LOS_HRS. Keeps stays with both ends,
    whose first event lies strictly inside ``window`` (if given) and that last at
    least ``min_hours`` (boundary minutes / 60, decimal).
    ``order`` must be a total order within the key for deterministic results.

    Skew: with ``hot_threshold`` (or an explicit ``hot`` key frame), encounters with
    more rows than the threshold are split into chunks of ~``chunk_rows`` events
    (``stays_chunked``) instead of being windowed by one task; the others take the
    single-exchange window plan. The result is the same either way.
    """
    s = stay_steps(events, key, order, group, direction, time, "pairs", bridge_groups,
                   outside_groups, hot_threshold, chunk_rows, hot)
    s = s.withColumn("ICU_LOS_HRS", stay_hours("VISIT_IN_DT", "OUT_DT"))
    cond = F.col("VISIT_IN_DT").isNotNull() & F.col("OUT_DT").isNotNull()
    if window is not None:
        lo, hi = window
        cond = cond & (F.col(time) > ntz(lo)) & (F.col(time) < ntz(hi))
    if min_hours is not None:
        cond = cond & (F.col("ICU_LOS_HRS") >= F.lit(Decimal(str(min_hours))))
    return s.filter(cond)
