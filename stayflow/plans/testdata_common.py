"""Configuration and helpers shared by the driver-table queries."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

from stayflow.sources.config import MeasureId, UnitWindow

# ---------------------------------------------------------------------------
# Configuration used by the queries.
EVENT_UNITS = (
    UnitWindow("ICU_A", "view", date(2024, 1, 1), date(2024, 1, 20)),
    UnitWindow("ICU_B", "click", date(2024, 1, 5), date(2024, 2, 1)),
    UnitWindow("PERIOP", "error", date(2024, 1, 1), date(2024, 2, 1)),
)
EVENT_WINDOW = (datetime(2024, 1, 3), datetime(2024, 1, 28))
EVENT_MEASURES = (MeasureId("click", "CLICKS"), MeasureId("error", "ERRORS"))

ORDER_UNITS = (
    UnitWindow("PCICU", "1-URGENT", date(1995, 6, 1), date(1998, 1, 1)),
    UnitWindow("NICU", "2-HIGH", date(1996, 1, 1), date(2001, 1, 1)),
    UnitWindow("PERIOP", "3-MEDIUM", date(1995, 1, 1), date(2002, 1, 1)),
)
ORDER_WINDOW = (datetime(1995, 3, 1), datetime(2000, 12, 31))

SEGMENT_UNITS = (
    UnitWindow("PICU", "HOUSEHOLD", date(2000, 1, 1), date(2030, 1, 1)),
    UnitWindow("CICU", "MACHINERY", date(2000, 1, 1), date(2030, 1, 1)),
    UnitWindow("PERIOP", "FURNITURE", date(2000, 1, 1), date(2030, 1, 1)),
    UnitWindow("NICU", "HOUSEHOLD", date(2000, 1, 1), date(2030, 1, 1)),
)

ORDER = ["effective_time", "event_dir", "event_id"]
KEY = "enc_id"


_READS: dict = {}


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    """The table as a DataFrame, built once per session and path (one footer read;
    the same plan object lets Spark reuse exchanges between query branches)."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _READS:
        _READS[key] = spark.read.parquet(f"{d}/{name}.parquet")
    return _READS[key]


# ---------------------------------------------------------------------------
# SQL helpers for the oracle side
def _units_sql(units) -> str:
    rows = ", ".join(f"('{u.group}', '{u.dept_id}', DATE '{u.open_date}', DATE '{u.close_date}')"
                     for u in units)
    return (f"(SELECT * FROM (VALUES {rows}) AS t(dpt_grp, dpt_id, opendate, closedate))")


def _ts(v: datetime) -> str:
    return f"TIMESTAMP '{v:%Y-%m-%d %H:%M:%S}'"


