"""Stay reconstruction for encounters too large for one task.

The plain plan (``stays.build_stays``) windows over whole encounters, so one
encounter is processed by one task. Here a hot encounter is cut into segments of at most
``chunk_rows`` consecutive events, written once (``assign_chunks``). What a row needs to
know of the rows outside its segment is little, and it is found from one summary row per
segment:

* a segment is summed up as its first row, its inside and its last row. Whether a row of
  the inside is half of a bridge is known in the segment; for the two outer rows it takes
  the neighbouring segment's outer row;
* the summaries of an encounter, in order, are scanned by windows over these items: the
  bridges of the outer rows, the group of the last kept row before a segment (open run),
  whether the next unit row after it goes on with a run, and the next run edge after it;
* each segment then gets those few values and runs all steps in one pass of its own.

The items of neighbouring segments combine by "the last one that says something" and "the
next one that says something", which are associative, so segments can be of any length and
may end anywhere (inside a bridge, inside a run, between a run's only two rows). Data are
moved twice from the written segments (summary pass: five columns; last pass: all), the
summaries once. No task holds more than one segment of an encounter; summaries number one
per ``chunk_rows`` events.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayflow.functions.expr import year_of
from stayflow.sources.sinks import materialize

IN, OUT = "In", "Out"
CHUNK, PLACE = "__chunk", "__place"


def assign_chunks(df: DataFrame, key: str, order: Sequence[str], chunk_rows: int,
                  rows_per_task: int = 2_000_000) -> DataFrame:
    """Add __chunk and __place: contiguous runs of at most ``chunk_rows`` rows in (key, order)
    order, numbered in that order (NULLs first, as in the windows), and the rows' places.

    Spark's range partitioner samples the data to place range boundaries, so ranges
    of about ``rows_per_task`` rows follow the data (a burst of events is split like
    any other stretch) and a giant key spans many ranges. A range is sorted by the task that
    writes it, and its rows are numbered there; being written, the numbers stay fixed if
    tasks are re-run.
    """
    parts = max(1, math.ceil(df.count() / max(chunk_rows, rows_per_task)))
    by = [F.col(key), *[F.col(c) for c in order]]
    # partition number << 33 | place in the partition
    ranged = df.repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn(
        PLACE, F.monotonically_increasing_id())
    in_range = F.col(PLACE).bitwiseAND(F.lit((1 << 33) - 1))
    chunk = F.shiftright(PLACE, 33) * F.lit(1 << 33) + F.floor(in_range / F.lit(chunk_rows))
    return materialize(ranged.withColumn(CHUNK, chunk.cast("bigint")), "stays-segments")


def _before(value: Column, window) -> Column:
    """The last non-NULL ``value`` of the rows before."""
    return F.last(value, ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, -1))


def _after(value: str, window) -> Column:
    """The first non-NULL value of column ``value`` in the rows after."""
    return F.expr(f"lead({value}) IGNORE NULLS").over(window)


def _first(value: Column, rows: Column) -> Column:
    return F.min_by(value, F.when(rows, F.col(PLACE)))


def _last(value: Column, rows: Column) -> Column:
    return F.max_by(value, F.when(rows, F.col(PLACE)))


def _halves(group: str, direction: str, bridges: list[str]):
    """Conditions: a row can be the Out half, and the In half, of a bridge."""
    in_bridge = F.col(group).isin(bridges)
    return (in_bridge & (F.col(direction) == OUT)), (in_bridge & (F.col(direction) == IN))


def _local(segments: DataFrame, window, group: str, direction: str, bridges: list[str]) -> DataFrame:
    """Add, within segments: __out_half / __in_half (a row's possible part in a bridge),
    __paired (its other half is the neighbour in the segment), __head and __tail."""
    out_half, in_half = _halves(group, direction, bridges)
    return segments.withColumns({
        "__out_half": F.coalesce(out_half, F.lit(False)), "__in_half": F.coalesce(in_half, F.lit(False)),
    }).withColumns({
        "__paired": (F.col("__out_half") & F.coalesce(F.lag("__in_half").over(window), F.lit(False)))
        | (F.col("__in_half") & F.coalesce(F.lead("__out_half").over(window), F.lit(False))),
        "__head": F.lag(PLACE).over(window).isNull(),
        "__tail": F.lead(PLACE).over(window).isNull()})


def segment_summaries(segments: DataFrame, key: str, group: str, direction: str, time: str,
                      bridges: list[str], outside: list[str]) -> DataFrame:
    """One row per segment: its outer rows (``head``, ``tail``; no ``tail`` if it has one row)
    and, of the rows between, the group of the last kept one (``kept``), the first unit row
    (``unit``: group, time, the kept row's group before it and the run marker of the unit row
    after it, both from the inside alone), the first run edge between the first and the last
    unit row (``edge``) and the last unit row (``end``)."""
    w = Window.partitionBy(CHUNK, key).orderBy(PLACE)
    s = segments.select(CHUNK, PLACE, key, F.col(group), F.col(direction), F.col(time))
    s = _local(s, w, group, direction, bridges)
    g, t = F.col(group), F.col(time)
    s = s.withColumn("__kept", ~F.col("__head") & ~F.col("__tail") & ~F.col("__paired"))
    s = s.withColumn("__prev", _before(F.when(F.col("__kept"), F.struct(g.alias("g"))), w))
    s = s.withColumns({"__unit": F.coalesce(F.col("__kept") & ~g.isin(outside), F.lit(False)),
                       "__same": F.col("__prev.g").eqNullSafe(g) & g.isNotNull()})
    s = s.withColumn("__mark", F.when(F.col("__unit"), F.struct(F.col("__same").alias("same"))))
    s = s.withColumns({"__next": _after("__mark", w),
                       "__earlier": _before(F.col("__mark"), w).isNotNull()})
    ends = ~F.col("__next.same")  # of a unit row with another after it: its run ends there
    edge = F.col("__unit") & F.col("__earlier") & F.col("__next").isNotNull() & t.isNotNull() & (
        ~F.col("__same") | ends)
    row = F.struct(g.alias("g"), F.col("__out_half").alias("out_half"), F.col("__in_half").alias("in_half"),
                   F.col("__paired").alias("paired"), t.alias("t"))
    every = F.lit(True)
    return s.groupBy(CHUNK, key).agg(
        _first(row, every).alias("head"),
        _last(row, F.col("__tail") & ~F.col("__head")).alias("tail"),
        _last(F.struct(g.alias("g")), F.col("__kept")).alias("kept"),
        _first(F.struct(g.alias("g"), t.alias("t"), F.col("__prev").alias("prev"),
                        F.col("__next").alias("next")), F.col("__unit")).alias("unit"),
        _first(F.struct(F.when(ends, t).alias("out")), edge).alias("edge"),
        _last(F.struct(t.alias("t"), F.col("__same").alias("same")), F.col("__unit")
              & F.col("__earlier")).alias("end"))


def segment_contexts(summaries: DataFrame, key: str, outside: list[str]) -> DataFrame:
    """What every segment has to know: __head_cut / __tail_cut (its outer rows are halves of a
    bridge with the neighbouring segment's), __kept_before (group of the last kept row before),
    __unit_after (run marker of the next unit row after) and __edge_after (VISIT_OUT_DT of the
    next run edge after), each a struct or NULL for none; and the encounter's bounds."""
    def item(place: int, row: str | None) -> Column:
        own = {c: F.col(c) if row is None else F.lit(None).cast(summaries.schema[c].dataType)
               for c in ("kept", "unit", "edge", "end")}
        at = F.col(row) if row else F.lit(None).cast(summaries.schema["head"].dataType)
        return F.struct(F.lit(place).alias("place"), at.alias("row"), *[c.alias(n) for n, c in own.items()])

    inside = F.when(F.col("kept").isNotNull() | F.col("unit").isNotNull(), item(1, None))
    last = F.when(F.col("tail").isNotNull(), item(2, "tail"))
    items = summaries.select(key, CHUNK, F.explode(F.filter(
        F.array(item(0, "head"), inside, last), lambda x: x.isNotNull())).alias("i")).select(key, CHUNK, "i.*")
    w = Window.partitionBy(key).orderBy(CHUNK, "place")
    no = F.lit(False)
    # an outer row and the neighbouring segment's are adjacent; a row inside its own segment
    # stands between all others
    row_before, row_after = F.lag("row").over(w), F.lead("row").over(w)
    chunk_before, chunk_after = F.lag(CHUNK).over(w), F.lead(CHUNK).over(w)
    items = items.withColumns({
        "cut_before": F.coalesce(F.col("row.out_half") & row_before["in_half"]
                                 & (chunk_before != F.col(CHUNK)), no),
        "cut_after": F.coalesce(F.col("row.in_half") & row_after["out_half"]
                                & (chunk_after != F.col(CHUNK)), no)})
    stays = F.col("row").isNotNull() & ~F.col("row.paired") & ~F.col("cut_before") & ~F.col("cut_after")
    items = items.withColumn("kept", F.when(
        F.col("row").isNotNull(), F.when(stays, F.struct(F.col("row.g").alias("g")))).otherwise(F.col("kept")))
    items = items.withColumn("kept_before", _before(F.col("kept"), w))
    # an item's first unit row: its group, the group kept before it, its run marker
    is_unit = F.coalesce(stays & ~F.col("row.g").isin(outside), no)
    g = F.when(is_unit, F.col("row.g")).otherwise(F.col("unit.g"))
    prev = F.coalesce(F.col("unit.prev"), F.col("kept_before"))
    items = items.withColumn("same", F.when(
        is_unit | F.col("unit").isNotNull(), F.struct((prev["g"].eqNullSafe(g) & g.isNotNull()).alias("same"))))
    items = items.withColumn("unit_after", _after("same", w))
    goes_on = F.coalesce(F.col("unit_after.same"), no)  # the run of the item's last unit row
    # the item's first run edge: its first unit row, one between, or its last unit row
    t = F.when(is_unit, F.col("row.t")).otherwise(F.col("unit.t"))
    next_same = F.when(F.col("unit.next").isNotNull(), F.col("unit.next.same")).otherwise(goes_on)
    end = F.col("end")
    items = items.withColumn("edge", F.coalesce(
        F.when(F.col("same").isNotNull() & t.isNotNull() & (~F.col("same.same") | ~next_same),
               F.struct(F.when(~next_same, t).alias("out"))),
        F.col("edge"),
        F.when(end.isNotNull() & end["t"].isNotNull() & (~end["same"] | ~goes_on),
               F.struct(F.when(~goes_on, end["t"]).alias("out")))))
    items = items.withColumn("edge_after", _after("edge", w))
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # the last item of a segment is its tail, or its only row
    items = items.withColumns({"admitted": F.first("row.t").over(whole), "left": F.last("row.t").over(whole)})
    order = F.col("place")
    return items.groupBy(CHUNK, key).agg(
        F.min_by("cut_before", order).alias("__head_cut"), F.max_by("cut_after", order).alias("__tail_cut"),
        F.min_by("kept_before", order).alias("__kept_before"),
        F.max_by("unit_after", order).alias("__unit_after"), F.max_by("edge_after", order).alias("__edge_after"),
        F.first("admitted").alias("HOSP_ADMIT_DT"), F.first("left").alias("HOSP_DC_DT"))


STEPS = ("bounds", "bridges", "runs", "edges", "pairs")


def build_stays_chunked(events: DataFrame, key: str, order: Sequence[str], group: str,
                        direction: str, time: str, chunk_rows: int,
                        bridge_groups: Sequence[str] = ("PERIOP",),
                        outside_groups: Sequence[str] = ("PERIOP", "OTHER"),
                        upto: str = "pairs") -> DataFrame:
    """The rows and columns of the plain step chain (``stays.stay_steps``) up to
    step ``upto`` (bounds, bridges, runs, edges or pairs), for any encounter size."""
    bridges, outside = list(bridge_groups), list(outside_groups)
    columns = events.columns
    segments = assign_chunks(events, key, list(order), chunk_rows)
    summaries = segment_summaries(segments, key, group, direction, time, bridges, outside)
    # one row per segment; written, so that the planner knows how few they are
    contexts = materialize(segment_contexts(summaries, key, outside), "stays-contexts")
    contexts = contexts.withColumnsRenamed({key: "__of_key", CHUNK: "__of_chunk"})
    # null-safe, as a window keeps the rows of a NULL key
    s = segments.join(contexts, (segments[CHUNK] == contexts["__of_chunk"])
                      & segments[key].eqNullSafe(contexts["__of_key"]), "inner")
    kept = [*columns, "HOSP_ADMIT_DT", "HOSP_DC_DT"]
    if upto == "bounds":
        return s.select(*kept)

    w = Window.partitionBy(CHUNK, key).orderBy(PLACE)
    s = _local(s, w, group, direction, bridges)
    bridge = F.col("__paired") | (F.col("__head") & F.col("__head_cut")) | (F.col("__tail") & F.col("__tail_cut"))
    s = s.withColumn("OUT_PERIOP", F.when(bridge, F.lit("YES")))
    kept.append("OUT_PERIOP")
    if upto == "bridges":
        return s.select(*kept)

    # runs: the kept row before
    g, t = F.col(group), F.col(time)
    stays = F.col("OUT_PERIOP").isNull()
    s = s.withColumn("__prev", F.coalesce(
        _before(F.when(stays, F.struct(g.alias("g"))), w), F.col("__kept_before")))
    s = s.withColumn("SAME_DEPT", F.when(stays & (F.col("__prev.g") == g), F.lit("YES")))
    kept.append("SAME_DEPT")
    if upto == "runs":
        return s.filter(stays).select(*kept)

    # run edges: the unit row after
    unit = F.coalesce(stays & ~g.isin(outside), F.lit(False))
    s = s.withColumn("__unit", unit).withColumn("__mark", F.when(
        F.col("__unit"), F.struct(F.col("SAME_DEPT").isNotNull().alias("same"))))
    s = s.withColumn("__next", F.coalesce(_after("__mark", w), F.col("__unit_after")))
    s = s.withColumns({
        "VISIT_IN_DT": F.when(F.col("__unit") & F.col("SAME_DEPT").isNull(), t),
        "VISIT_OUT_DT": F.when(F.col("__unit") & ~F.coalesce(F.col("__next.same"), F.lit(False)), t)})
    kept += ["VISIT_IN_DT", "VISIT_OUT_DT"]
    if upto == "edges":
        return s.filter(F.col("__unit")).select(*kept)

    # pairs: the run edge after
    edge = F.col("VISIT_IN_DT").isNotNull() | F.col("VISIT_OUT_DT").isNotNull()
    s = s.withColumn("__edge", F.when(edge, F.struct(F.col("VISIT_OUT_DT").alias("out"))))
    s = s.withColumn("__next_edge", F.coalesce(_after("__edge", w), F.col("__edge_after")))
    s = s.withColumns({
        "OUT_DT": F.when(F.col("VISIT_OUT_DT").isNull(), F.col("__next_edge.out")),
        "IN_YEAR": year_of("VISIT_IN_DT")})
    return s.filter(F.col("__edge").isNotNull()).select(*kept, "OUT_DT", "IN_YEAR")
