"""Event-log queries: the stay builder and the extracts that read stays.

The reference's operators exercised on the driver's TPC-H-like tables.

Each entry of ``QUERIES`` reads whole tables from ``sf_dir`` and runs one of the
library's operators (or an extract) over data Spark derives from them; ``ORACLE``
holds an independent DuckDB SQL statement computing the same result from the same
parquet tables. Column names and types agree between the two.

* ``events`` is an admission/transfer/discharge log: encounter = user_id, order =
  (ts, direction, event_id), department = event_type, direction = 'In' for even
  event ids, 'Out' for odd ones.
* ``orders`` are unit events keyed by priority; ``lineitem`` rows are
  administrations of medication ``l_partkey``; ``part`` is the medication master;
  ``supplier``/``nation``/``region`` are departments/locations/unit types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.functions.expr import boundary_diff, ntz
from stayflow.operators import stays as st
from stayflow.operators.joins import (
    PAIRED_INTERVALS, classify, lookup, restrict_to, within_interval, within_unit_window)
from stayflow.sources.config import ids_frame, units_frame

from stayflow.plans.testdata_common import (
    EVENT_MEASURES, EVENT_UNITS, EVENT_WINDOW, KEY, ORDER, _read, _ts, _units_sql)

_W = f"(PARTITION BY {KEY} ORDER BY effective_time, event_dir, event_id)"

_LOG_SQL = f"""
units AS {_units_sql(EVENT_UNITS)},
log AS (
  SELECT e.user_id AS enc_id, e.event_id, e.ts AS effective_time, e.event_type AS dept,
         CASE WHEN e.event_id % 2 = 0 THEN 'In' ELSE 'Out' END AS event_dir,
         COALESCE(u.dpt_grp, 'OTHER') AS DEPT_GRP
  FROM events e LEFT JOIN units u ON e.event_type = u.dpt_id)"""


def _stay_steps_sql(src: str) -> str:
    """CTEs bounds -> runs -> edges -> pairs over an event log CTE named ``src``."""
    return f"""
bounds AS (
  SELECT *,
    first_value(effective_time) OVER (PARTITION BY {KEY} ORDER BY effective_time, event_dir,
      event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS HOSP_ADMIT_DT,
    last_value(effective_time) OVER (PARTITION BY {KEY} ORDER BY effective_time, event_dir,
      event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS HOSP_DC_DT,
    CASE WHEN (lag(DEPT_GRP) OVER {_W} = 'PERIOP' AND DEPT_GRP = 'PERIOP'
               AND lag(event_dir) OVER {_W} = 'In' AND event_dir = 'Out')
           OR (lead(DEPT_GRP) OVER {_W} = 'PERIOP' AND DEPT_GRP = 'PERIOP'
               AND lead(event_dir) OVER {_W} = 'Out' AND event_dir = 'In')
         THEN 'YES' END AS OUT_PERIOP
  FROM {src}),
runs AS (
  SELECT *, CASE WHEN lag(DEPT_GRP) OVER {_W} = DEPT_GRP THEN 'YES' END AS SAME_DEPT
  FROM bounds WHERE OUT_PERIOP IS NULL),
edges AS (
  SELECT *, CASE WHEN SAME_DEPT IS NULL THEN effective_time END AS VISIT_IN_DT,
         CASE WHEN lead(SAME_DEPT) OVER {_W} IS NULL THEN effective_time END AS VISIT_OUT_DT
  FROM runs WHERE DEPT_GRP NOT IN ('PERIOP', 'OTHER')),
pairs AS (
  SELECT *, CASE WHEN VISIT_OUT_DT IS NULL THEN lead(VISIT_OUT_DT) OVER {_W} END AS OUT_DT,
         CAST(year(VISIT_IN_DT) AS BIGINT) AS IN_YEAR
  FROM edges WHERE VISIT_IN_DT IS NOT NULL OR VISIT_OUT_DT IS NOT NULL),
stays AS (
  SELECT *, CAST(ROUND(CAST(date_diff('minute', VISIT_IN_DT, OUT_DT) AS DOUBLE) / 60, 6)
                 AS DECIMAL(16, 6)) AS ICU_LOS_HRS
  FROM pairs
  WHERE VISIT_IN_DT IS NOT NULL AND OUT_DT IS NOT NULL
    AND effective_time > {_ts(EVENT_WINDOW[0])} AND effective_time < {_ts(EVENT_WINDOW[1])}
    AND CAST(ROUND(CAST(date_diff('minute', VISIT_IN_DT, OUT_DT) AS DOUBLE) / 60, 6)
             AS DECIMAL(16, 6)) >= 0.5)"""


_STAY_SELECT_SQL = ("enc_id, event_id, DEPT_GRP, effective_time, HOSP_ADMIT_DT, HOSP_DC_DT, "
                    "VISIT_IN_DT AS ICU_IN_DT, OUT_DT AS ICU_OUT_DT, IN_YEAR, ICU_LOS_HRS")

# ---------------------------------------------------------------------------
# Event-log family (P1 and its steps)


def event_log(spark: SparkSession, d: str) -> DataFrame:
    ev = _read(spark, d, "events")
    log = ev.select(
        F.col("user_id").alias(KEY), "event_id", F.col("ts").alias("effective_time"),
        F.col("event_type").alias("dept"),
        F.when(F.col("event_id") % 2 == 0, F.lit("In")).otherwise(F.lit("Out")).alias("event_dir"))
    return classify(log, units_frame(spark, EVENT_UNITS), "dept")


# production setting: users with more events than this take the chunked plan
HOT_EVENTS = 1_000_000


def _steps(spark, d, upto: str) -> DataFrame:
    return st.stay_steps(event_log(spark, d), KEY, ORDER, "DEPT_GRP", "event_dir",
                         "effective_time", upto, hot_threshold=HOT_EVENTS)


def _stays_of(log: DataFrame) -> DataFrame:
    s = st.build_stays(log, KEY, ORDER, "DEPT_GRP", "event_dir", "effective_time",
                       window=EVENT_WINDOW, hot_threshold=HOT_EVENTS)
    return s.select(KEY, "event_id", "DEPT_GRP", "effective_time", "HOSP_ADMIT_DT", "HOSP_DC_DT",
                    F.col("VISIT_IN_DT").alias("ICU_IN_DT"), F.col("OUT_DT").alias("ICU_OUT_DT"),
                    "IN_YEAR", "ICU_LOS_HRS")


def q_stays(spark, d):
    return _stays_of(event_log(spark, d))


def q_stays_chunked(spark, d):
    """The same stays through the hot-encounter plan: every encounter is treated as
    hot and cut into chunks of 16 events."""
    s = st.build_stays(event_log(spark, d), KEY, ORDER, "DEPT_GRP", "event_dir",
                       "effective_time", window=EVENT_WINDOW, hot_threshold=0, chunk_rows=16)
    return s.select(KEY, "event_id", "DEPT_GRP", "effective_time", "HOSP_ADMIT_DT", "HOSP_DC_DT",
                    F.col("VISIT_IN_DT").alias("ICU_IN_DT"), F.col("OUT_DT").alias("ICU_OUT_DT"),
                    "IN_YEAR", "ICU_LOS_HRS")


def seeded_log(spark, d) -> DataFrame:
    """Events of encounters admitted/transferred into a configured unit while it was
    open and inside the study window (the cohort seed)."""
    log = event_log(spark, d)
    seed = within_unit_window(log, units_frame(spark, EVENT_UNITS), "dept", "effective_time")
    lo, hi = EVENT_WINDOW
    seed = seed.filter((F.col("event_dir") == "In") & (F.col("effective_time") > ntz(lo))
                       & (F.col("effective_time") < ntz(hi)))
    return restrict_to(log, seed.select(KEY), KEY)


def q_cohort(spark, d):
    return _stays_of(seeded_log(spark, d))


def q_encounter_bounds(spark, d):
    return _steps(spark, d, "bounds").select(KEY, "event_id", "HOSP_ADMIT_DT", "HOSP_DC_DT")


def q_bridge_flags(spark, d):
    return _steps(spark, d, "bridges").select(KEY, "event_id", "DEPT_GRP", "event_dir",
                                              "OUT_PERIOP")


def q_same_group_runs(spark, d):
    return _steps(spark, d, "edges").select(KEY, "event_id", "DEPT_GRP", "SAME_DEPT",
                                            "VISIT_IN_DT", "VISIT_OUT_DT")


def q_stay_pairing(spark, d):
    return _steps(spark, d, "pairs").select(KEY, "event_id", "VISIT_IN_DT", "VISIT_OUT_DT",
                                            "OUT_DT", "IN_YEAR")


def q_stay_projection(spark, d):
    s = q_stays(spark, d)
    return s.select(
        F.col(KEY).alias("hid"), F.col("event_id").alias("eid"), F.col("DEPT_GRP").alias("icu"),
        F.col("ICU_IN_DT").alias("icuAdmission"),
        boundary_diff("SECOND", "HOSP_ADMIT_DT", "ICU_IN_DT").alias("icuAdmission_Anonymized"),
        F.col("ICU_OUT_DT").alias("icuDischarge"),
        boundary_diff("SECOND", "HOSP_ADMIT_DT", "ICU_OUT_DT").alias("icuDischarge_Anonymized"),
        F.when(F.col("DEPT_GRP") != "ICU_A", F.lit("0"))
        .when((F.col("DEPT_GRP") == "ICU_A") & (F.col("ICU_OUT_DT") == F.col("HOSP_DC_DT")),
              F.lit("1")).otherwise(F.lit("0")).alias("icuMortality"))


def q_measure_extract(spark, d):
    ev = _read(spark, d, "events")
    cohort = q_stays(spark, d).select(F.col(KEY).alias("user_id"))
    ids = ids_frame(spark, EVENT_MEASURES)
    birth = ev.groupBy("user_id").agg(F.min("ts").alias("BIRTH_DATE"))
    m = restrict_to(ev, cohort, "user_id")
    m = restrict_to(m, F.broadcast(ids), {"event_type": "FloId"})
    m = lookup(m, birth, "user_id", {"BIRTH_DATE": "BIRTH_DATE"})
    m = lookup(m, F.broadcast(ids), {"event_type": "FloId"}, {"DisplayName": "name"})
    return m.select(F.col("user_id").alias("hid"), F.col("event_id").alias("code"),
                    F.col("ts").alias("startTime"),
                    boundary_diff("SECOND", "BIRTH_DATE", "ts").alias("startTime_Anonymized"),
                    "value", "name")


def q_within_stay_counts(spark, d, paired: int = PAIRED_INTERVALS):
    ev = _read(spark, d, "events").select("user_id", "event_id", "ts", "event_type", "props")
    stays = q_stays(spark, d).select(F.col(KEY).alias("s_user"), "ICU_IN_DT", "ICU_OUT_DT")
    j = within_interval(ev, stays, {"user_id": "s_user"}, "ts", "ICU_IN_DT", "ICU_OUT_DT", paired)
    return (j.groupBy(F.col("event_type").alias("FLO_MEAS_ID"))
            .agg(F.min(F.collate(F.col("props"), "UTF8_BINARY")).alias("FLO_MEAS_NAME"),
                 F.count("event_id").alias("OCCURANCES")))


def q_within_stay_bins(spark, d):
    """The same counts with every user's stays joined by bins of time."""
    return q_within_stay_counts(spark, d, paired=0)


SQL_STAYS = f"WITH {_LOG_SQL}, {_stay_steps_sql('log')} SELECT {_STAY_SELECT_SQL} FROM stays"

SQL_COHORT = f"""WITH {_LOG_SQL},
seed AS (
  SELECT DISTINCT l.enc_id FROM log l JOIN units u
    ON l.dept = u.dpt_id AND u.dpt_grp <> 'PERIOP'
   AND l.effective_time > CAST(u.opendate AS TIMESTAMP)
   AND l.effective_time < CAST(u.closedate AS TIMESTAMP)
  WHERE l.event_dir = 'In' AND l.effective_time > {_ts(EVENT_WINDOW[0])}
    AND l.effective_time < {_ts(EVENT_WINDOW[1])}),
slog AS (SELECT * FROM log WHERE enc_id IN (SELECT enc_id FROM seed)),
{_stay_steps_sql('slog')} SELECT {_STAY_SELECT_SQL} FROM stays"""

SQL_ENCOUNTER_BOUNDS = f"""WITH {_LOG_SQL}, {_stay_steps_sql('log')}
SELECT enc_id, event_id, HOSP_ADMIT_DT, HOSP_DC_DT FROM bounds"""

SQL_BRIDGE_FLAGS = f"""WITH {_LOG_SQL}, {_stay_steps_sql('log')}
SELECT enc_id, event_id, DEPT_GRP, event_dir, OUT_PERIOP FROM bounds"""

SQL_SAME_GROUP_RUNS = f"""WITH {_LOG_SQL}, {_stay_steps_sql('log')}
SELECT enc_id, event_id, DEPT_GRP, SAME_DEPT, VISIT_IN_DT, VISIT_OUT_DT FROM edges"""

SQL_STAY_PAIRING = f"""WITH {_LOG_SQL}, {_stay_steps_sql('log')}
SELECT enc_id, event_id, VISIT_IN_DT, VISIT_OUT_DT, OUT_DT, IN_YEAR FROM pairs"""

SQL_STAY_PROJECTION = f"""WITH {_LOG_SQL}, {_stay_steps_sql('log')}
SELECT enc_id AS hid, event_id AS eid, DEPT_GRP AS icu, VISIT_IN_DT AS icuAdmission,
  date_diff('second', HOSP_ADMIT_DT, VISIT_IN_DT) AS icuAdmission_Anonymized,
  OUT_DT AS icuDischarge,
  date_diff('second', HOSP_ADMIT_DT, OUT_DT) AS icuDischarge_Anonymized,
  CASE WHEN DEPT_GRP <> 'ICU_A' THEN '0'
       WHEN DEPT_GRP = 'ICU_A' AND OUT_DT = HOSP_DC_DT THEN '1' ELSE '0' END AS icuMortality
FROM stays"""

_MEASURES_SQL = ", ".join(f"('{m.flo_id}', '{m.display_name}')" for m in EVENT_MEASURES)

SQL_MEASURE_EXTRACT = f"""WITH {_LOG_SQL}, {_stay_steps_sql('log')},
ids AS (SELECT * FROM (VALUES {_MEASURES_SQL}) AS t(FloId, DisplayName)),
birth AS (SELECT user_id, min(ts) AS BIRTH_DATE FROM events GROUP BY user_id)
SELECT e.user_id AS hid, e.event_id AS code, e.ts AS startTime,
  date_diff('second', b.BIRTH_DATE, e.ts) AS startTime_Anonymized, e.value,
  i.DisplayName AS name
FROM events e
LEFT JOIN birth b ON b.user_id = e.user_id
LEFT JOIN ids i ON i.FloId = e.event_type
WHERE e.user_id IN (SELECT enc_id FROM stays)
  AND e.event_type IN (SELECT FloId FROM ids)"""

SQL_WITHIN_STAY_COUNTS = f"""WITH {_LOG_SQL}, {_stay_steps_sql('log')}
SELECT e.event_type AS FLO_MEAS_ID, min(e.props) AS FLO_MEAS_NAME,
       count(e.event_id) AS OCCURANCES
FROM events e JOIN stays s ON e.user_id = s.enc_id
 AND e.ts >= s.VISIT_IN_DT AND e.ts <= s.OUT_DT
GROUP BY e.event_type"""

QUERIES = {
    "stays": q_stays,
    "stays_chunked": q_stays_chunked,
    "cohort": q_cohort,
    "encounter_bounds": q_encounter_bounds,
    "bridge_flags": q_bridge_flags,
    "same_group_runs": q_same_group_runs,
    "stay_pairing": q_stay_pairing,
    "stay_projection": q_stay_projection,
    "measure_extract": q_measure_extract,
    "within_stay_counts": q_within_stay_counts,
    "within_stay_bins": q_within_stay_bins,
}

ORACLE = {
    "stays": SQL_STAYS,
    "stays_chunked": SQL_STAYS,
    "cohort": SQL_COHORT,
    "encounter_bounds": SQL_ENCOUNTER_BOUNDS,
    "bridge_flags": SQL_BRIDGE_FLAGS,
    "same_group_runs": SQL_SAME_GROUP_RUNS,
    "stay_pairing": SQL_STAY_PAIRING,
    "stay_projection": SQL_STAY_PROJECTION,
    "measure_extract": SQL_MEASURE_EXTRACT,
    "within_stay_counts": SQL_WITHIN_STAY_COUNTS,
    "within_stay_bins": SQL_WITHIN_STAY_COUNTS,
}

