"""Join-shaped operators: lookups, key-set restriction/exclusion, config windows.

Broadcast policy (applies to every operator here): only frames whose size is fixed
by the caller's configuration (unit windows, id lists) get an explicit
``F.broadcast`` hint. Every data-derived side (category tables, cohorts, edge
tables) is left to the planner, which broadcasts it only when its estimated size is
under ``spark.sql.autoBroadcastJoinThreshold`` and, with AQE, re-checks the actual
shuffle size at run time; beyond that it uses a shuffled hash / sort-merge join.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KeySpec = str | Iterable[str] | Mapping[str, str]


def _pairs(on: KeySpec) -> list[tuple[str, str]]:
    """Normalise a key spec to (left column, right column) pairs."""
    if isinstance(on, str):
        return [(on, on)]
    if isinstance(on, Mapping):
        return list(on.items())
    return [(c, c) for c in on]


def lookup(df: DataFrame, dim: DataFrame, on: KeySpec,
           columns: Mapping[str, str], how: str = "left") -> DataFrame:
    """``df LEFT JOIN dim ON df.k = dim.k'`` keeping only ``columns`` of ``dim``.

    ``on`` maps fact columns to dimension columns; ``columns`` maps dimension
    columns to output names, so one dimension can be joined several times under
    different names (role-playing lookups). The dimension is projected before the
    join, so the scan only reads the key and the requested columns.
    """
    pairs = _pairs(on)
    right = dim.select(*[F.col(d).alias(f) for f, d in pairs],
                       *[F.col(s).alias(a) for s, a in columns.items()])
    return df.join(right, on=[f for f, _ in pairs], how=how)


def _keys(keys: DataFrame, on: KeySpec) -> tuple[DataFrame, list[str]]:
    pairs = _pairs(on)
    return keys.select(*[F.col(k).alias(d) for d, k in pairs]), [d for d, _ in pairs]


def duplicate_keys(df: DataFrame, keys: Sequence[str], limit: int = 5) -> list:
    """Up to ``limit`` key values that occur more than once (an aggregate; map-side
    combined). Empty when the key is unique."""
    dup = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
           .filter(F.col("__n") > 1).limit(limit))
    return [tuple(r[k] for k in keys) for r in dup.collect()]


def restrict_to(df: DataFrame, keys: DataFrame, on: KeySpec) -> DataFrame:
    """Rows of ``df`` whose key appears in ``keys`` (``IN (SELECT ...)``).

    A left-semi join: never duplicates ``df`` rows, and a NULL key never matches.
    """
    right, names = _keys(keys, on)
    return df.join(right, on=names, how="left_semi")


def key_set(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    """Distinct key tuples of ``df``, materialised in the shared checkpoint folder.

    Materialising makes the key set a file-backed relation whose real size the planner
    sees, so a later ``restrict_to(big_table, key_set)`` is planned as a broadcast
    semi join exactly when the keys are small (``autoBroadcastJoinThreshold``) and as a
    shuffled one otherwise -- a size-checked broadcast with a fallback.
    """
    from stayflow.sources.sinks import materialize
    return materialize(df.select(*cols).distinct(), name)


#: Words (of 64 bits) of a sieve at most, its bits per key, and the fewest that still help.
SIEVE_WORDS, SIEVE_BITS, SIEVE_LEAST_BITS = 1 << 20, 12, 4


def _sieve_place(columns: Sequence[str], words: int) -> tuple[Column, Column]:
    """The word of a key, and the three bits that it sets there."""
    word = F.pmod(F.xxhash64(*columns), F.lit(words))
    more = F.xxhash64(F.lit(1), *columns)
    bits = [F.shiftright(more, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(3)]
    one = [F.call_function("shiftleft", F.lit(1).cast("bigint"), b) for b in bits]
    return word, one[0].bitwiseOR(one[1]).bitwiseOR(one[2])


def sift(df: DataFrame, keys: DataFrame, on: KeySpec) -> DataFrame | None:
    """The rows of ``df`` that may have a key in ``keys``: all that have one, and about 3 in
    100 of the others. None where no sieve applies (too many keys, or columns whose equal
    values need not have equal hashes).

    The sieve is a blocked Bloom filter: every key sets three bits of one 64-bit word, words
    are put together by ``bit_or`` (combined map-side) and sent to the scan of ``df``, at most
    SIEVE_WORDS of them (16 MB). It is a broadcast join on the word and a bit test, so rows
    without a chance go before any shuffle.
    """
    pairs = _pairs(on)
    for left, right in pairs:
        kinds = {df.schema[left].dataType.simpleString(), keys.schema[right].dataType.simpleString()}
        if len(kinds) > 1 or not kinds <= {"bigint", "int", "smallint", "string", "date", "timestamp",
                                           "timestamp_ntz"}:
            return None
    names = [r for _, r in pairs]
    keys = keys.select(*names).dropna()
    n = keys.count()
    if n * SIEVE_LEAST_BITS > SIEVE_WORDS * 64:
        return None
    words = min(SIEVE_WORDS, max(1, n * SIEVE_BITS // 64))
    word, bits = _sieve_place(names, words)
    sieve = keys.select(word.alias("__word"), bits.alias("__bits")).groupBy("__word").agg(
        F.bit_or("__bits").alias("__bits"))
    word, bits = _sieve_place([left for left, _ in pairs], words)
    # a semi join, which the planner does not move the exact semi join below
    return df.join(F.broadcast(sieve), (word == F.col("__word")) & (F.col("__bits").bitwiseAND(bits) == bits),
                   "left_semi")


def _broadcastable(keys: DataFrame) -> bool:
    """Whether the planner would broadcast ``keys`` (materialised, so that their size is known)."""
    most = keys.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= most


def sieved(df: DataFrame, keys: DataFrame, on: KeySpec) -> DataFrame:
    """The rows of ``df`` that a materialised key set can match, and possibly some others, with
    no shuffle of ``df``: for joins that decide themselves. A key set that the planner would
    broadcast restricts ``df`` exactly, a larger one sieves it (:func:`sift`); where no sieve
    applies, ``df`` stays as it is."""
    if _broadcastable(keys):
        return restrict_to(df, keys, on)
    sifted = sift(df, keys, on)
    return df if sifted is None else sifted


def reduce_dimension(dim: DataFrame, keys: DataFrame, on: KeySpec) -> DataFrame:
    """The rows of a large dimension or fact that a materialised key set can match.

    A LEFT JOIN from a few fact rows to a huge table otherwise shuffles the whole huge
    table; semi-joining it to the facts' key set first filters it where it is scanned. A key
    set that the planner would broadcast does so itself; for a larger one, whose semi join
    shuffles the huge table, a sieve (:func:`sift`) in the scan leaves out nearly all rows
    without a match before the shuffle. The semi join after it decides.
    """
    reduced = sieved(dim, keys, on)
    return reduced if _broadcastable(keys) else restrict_to(reduced, keys, on)


def exclude(df: DataFrame, keys: DataFrame, on: KeySpec) -> DataFrame:
    """Rows of ``df`` whose key has no match in ``keys`` (LEFT JOIN ... IS NULL).

    A left-anti join: unlike ``NOT IN`` a NULL key is kept.
    """
    right, names = _keys(keys, on)
    return df.join(right, on=names, how="left_anti")


def within_unit_window(events: DataFrame, units: DataFrame, dept_col: str, time_col: str,
                       skip_groups: Iterable[str] = ("PERIOP",)) -> DataFrame:
    """Events in a configured unit, strictly between its open and close dates.

    ``units`` has columns ``dpt_grp, dpt_id, opendate, closedate``; it is caller
    configuration (a handful of rows) and is broadcast. Adds ``dpt_grp``.
    """
    key_type = events.schema[dept_col].dataType
    u = F.broadcast(units.filter(~F.col("dpt_grp").isin(list(skip_groups)))
                    .select(F.col("dpt_id").cast(key_type).alias("__unit_id"),
                            "dpt_grp", "opendate", "closedate"))
    t = F.col(time_col)
    cond = ((F.col(dept_col) == F.col("__unit_id"))
            & (t > F.col("opendate").cast("timestamp_ntz"))
            & (t < F.col("closedate").cast("timestamp_ntz")))
    return events.join(u, cond, "inner").drop("__unit_id", "opendate", "closedate")


def classify(events: DataFrame, units: DataFrame, dept_col: str,
             out_col: str = "DEPT_GRP", default: str = "OTHER") -> DataFrame:
    """Label each event with its unit group, ``default`` when not configured.

    Open/close dates are ignored here; a department listed twice under one group (closed
    and opened again) labels its events once, one listed under two groups yields one row
    per group.
    """
    key_type = events.schema[dept_col].dataType
    # a handful of configured rows: repeats are dropped here, not by an aggregate
    rows = {(r["dpt_id"], r["dpt_grp"]) for r in units.select("dpt_id", "dpt_grp").collect()}
    names = units.select(F.col("dpt_id").alias("__unit_id"), F.col("dpt_grp").alias("__unit_grp"))
    u = F.broadcast(units.sparkSession.createDataFrame(
        sorted(rows, key=str), names.schema).withColumn("__unit_id", F.col("__unit_id").cast(key_type)))
    joined = events.join(u, F.col(dept_col) == F.col("__unit_id"), "left")
    return (joined.withColumn(out_col, F.coalesce(F.col("__unit_grp"), F.lit(default)))
            .drop("__unit_id", "__unit_grp"))


#: Intervals of one key up to which a point is compared with all of them.
PAIRED_INTERVALS = 64


def _ticks(df: DataFrame, name: str) -> Column | None:
    """A time or whole-number column as a bigint in its own order; None for other types."""
    kind = df.schema[name].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if kind == "date":
        return F.unix_date(name).cast("bigint")
    return F.col(name).cast("bigint") if kind in ("byte", "short", "integer", "long") else None


def _within_bins(points: DataFrame, intervals: DataFrame, keys: list[tuple[str, str]],
                 time_col: str, start_col: str, end_col: str) -> DataFrame:
    """As the equi join of :func:`within_interval`, by bins of time.

    An interval has a level by its length (bins of the level are at least as wide, at most
    four times) and stands in the one or two bins of its level that it touches; a point looks
    into its bin of every level that its key's intervals have. Each pair meets in one bin
    only, so none is found twice, and a bin holds no intervals but those of similar length
    near the point.
    """
    start, end, at = (_ticks(intervals, start_col), _ticks(intervals, end_col), _ticks(points, time_col))
    p_names, i_names = points.columns, intervals.columns
    level = F.ceil(F.log2((end - start + 1).cast("double")) / 2).cast("int")
    width = F.expr("shiftleft(1L, 2 * least(__level, 30))")
    i = intervals.withColumns({"__start": start, "__end": end}).filter("__start <= __end").withColumn(
        "__level", level).withColumn("__bin", F.explode(F.sequence(
            F.floor(F.col("__start") / width), F.floor(F.col("__end") / width))))
    # columns of both sides by place, since their names may clash
    i = i.select(*[F.col(f"`{c}`").alias(f"__i{n}") for n, c in enumerate(i_names)], "__level", "__bin")
    i_key = {c: f"__i{n}" for n, c in enumerate(i_names)}
    p_key = {c: f"__p{n}" for n, c in enumerate(p_names)}
    levels = i.groupBy(*[F.col(i_key[r]).alias(f"__l{n}") for n, (_, r) in enumerate(keys)]).agg(
        F.collect_set("__level").alias("__levels"))  # 31 at most
    p = points.withColumn("__at", at).select(
        *[F.col(f"`{c}`").alias(f"__p{n}") for n, c in enumerate(p_names)], "__at")
    p = p.join(levels, [F.col(p_key[left]) == F.col(f"__l{n}") for n, (left, _) in enumerate(keys)], "inner")
    p = p.withColumn("__level", F.explode("__levels")).withColumn("__bin", F.floor(F.col("__at") / width))
    p = p.select(*[f"__p{n}" for n in range(len(p_names))], F.col("__level").alias("__p_level"),
                 F.col("__bin").alias("__p_bin"))
    cond = [F.col(p_key[left]) == F.col(i_key[right]) for left, right in keys]
    cond += [F.col("__p_level") == F.col("__level"), F.col("__p_bin") == F.col("__bin"),
             F.col(p_key[time_col]).between(F.col(i_key[start_col]), F.col(i_key[end_col]))]
    return p.join(i, cond, "inner").select(
        *[f"__p{n}" for n in range(len(p_names))], *[f"__i{n}" for n in range(len(i_names))]).toDF(
        *p_names, *i_names)


def within_interval(points: DataFrame, intervals: DataFrame, on: KeySpec,
                    time_col: str, start_col: str, end_col: str,
                    paired: int | None = PAIRED_INTERVALS) -> DataFrame:
    """Pair each point with every interval of the same key that contains it.

    Inclusive on both ends; a point inside two overlapping intervals appears twice.
    The equi key drives the join (hash/sort-merge on the key, ``BETWEEN`` as a residual),
    which compares a point with all intervals of its key. Keys with more than ``paired``
    intervals (found by counting the intervals, the small side) are joined by bins of time
    instead (:func:`_within_bins`), where a point meets nearby intervals of similar length
    only and a hot key is spread over its bins; ``paired=None`` never does. The rows are the
    same either way. Times that are neither timestamps, dates nor whole numbers are always
    joined by key.
    """
    pairs = _pairs(on)

    def by_key(points: DataFrame, intervals: DataFrame) -> DataFrame:
        cond: Column | None = None
        for left, right in pairs:
            c = points[left] == intervals[right]
            cond = c if cond is None else cond & c
        cond = cond & points[time_col].between(intervals[start_col], intervals[end_col])
        return points.join(intervals, cond, "inner")

    if paired is None or any(t is None for t in (
            _ticks(points, time_col), _ticks(intervals, start_col), _ticks(intervals, end_col))):
        return by_key(points, intervals)
    names = [r for _, r in pairs]
    hot = intervals.groupBy(*names).agg(F.count(F.lit(1)).alias("__n")).filter(
        F.col("__n") > paired).select(*names).dropna()
    if hot.isEmpty():
        return by_key(points, intervals)
    from stayflow.sources.sinks import materialize
    hot = materialize(hot, "hot-interval-keys")
    mine = {left: right for left, right in pairs}
    cold = by_key(exclude(points, hot, mine), exclude(intervals, hot, names))
    return cold.union(_within_bins(restrict_to(points, hot, mine), restrict_to(intervals, hot, names),
                                   pairs, time_col, start_col, end_col))
