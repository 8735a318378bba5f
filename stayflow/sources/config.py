"""User configuration: study window, care units, measurement ids, search inputs.

The reference keeps these as T-SQL variables and table variables edited in place;
here they are typed values turned into small (broadcastable) DataFrames.
"""

from __future__ import annotations

import warnings
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class UnitWindow:
    """A care unit: its group label, department id and the dates it was open."""

    group: str
    dept_id: str
    open_date: date
    close_date: date
    display_name: str | None = None


@dataclass(frozen=True)
class MeasureId:
    flo_id: str
    display_name: str | None = None


@dataclass
class StudyConfig:
    """A study: its window and care units are mandatory, the other fields are needed by the
    extracts that use them. ``file_prefix`` is put before extract file names."""

    start: datetime
    end: datetime
    units: tuple[UnitWindow, ...]
    vital_ids: tuple[MeasureId, ...] = ()
    intervention_ids: tuple[MeasureId, ...] = ()
    network_departments: tuple[str, ...] = ()
    department_patterns: tuple[str, ...] = ()
    # fixed values: event types of admissions, discharges, transfers and hospital outpatients
    network_event_types: tuple[str, ...] = ("1", "2", "3", "4", "6")
    file_prefix: str = ""
    bridge_groups: tuple[str, ...] = ("PERIOP",)
    outside_groups: tuple[str, ...] = ("PERIOP", "OTHER")
    min_stay_hours: float = 0.5
    # Encounters with more ADT rows than this are reconstructed in chunks of
    # ``chunk_events`` rows instead of by a single task (None: never split).
    hot_encounter_events: int | None = 1_000_000
    chunk_events: int = 250_000
    # Opt-in (Q22): fail fast if a lookup table of the cohort plan has duplicate keys,
    # which would duplicate stays.
    check_lookup_keys: bool = False

    def validate(self, numeric_dept_ids: bool = True) -> "StudyConfig":
        if not self.units:
            raise ValueError("a study needs at least one care unit")
        if self.start >= self.end:
            raise ValueError("study start must be before its end")
        if not any(u.group in self.bridge_groups for u in self.units):
            warnings.warn("no bridge (PERIOP) unit configured: no operating-room trip "
                          "will be bridged", stacklevel=2)
        seen: dict[str, str] = {}
        for u in self.units:
            if numeric_dept_ids and not u.dept_id.strip().isdigit():
                raise ValueError(f"department id {u.dept_id!r} is not numeric")
            if u.open_date >= u.close_date:
                raise ValueError(f"unit {u.dept_id} opens after it closes")
            if u.dept_id in seen and seen[u.dept_id] != u.group:
                warnings.warn(f"department {u.dept_id} is listed under groups "
                              f"{seen[u.dept_id]} and {u.group}: its events are duplicated",
                              stacklevel=2)
            seen[u.dept_id] = u.group
        return self


def config_from_dict(d: dict) -> StudyConfig:
    """A StudyConfig from plain JSON-style values (dates as ISO strings)."""
    missing = [k for k in ("start", "end", "units") if not d.get(k)]
    if missing:
        raise ValueError(f"the study configuration lacks {', '.join(missing)}")

    def dt(v):
        return datetime.fromisoformat(v) if isinstance(v, str) else v

    def dd(v):
        return date.fromisoformat(v) if isinstance(v, str) else v

    kw = {k: v for k, v in d.items() if k not in ("units", "vital_ids", "intervention_ids")}
    for k in ("start", "end"):
        if k in kw:
            kw[k] = dt(kw[k])
    for k in ("network_departments", "department_patterns", "network_event_types",
              "bridge_groups", "outside_groups"):
        if k in kw:
            kw[k] = tuple(kw[k])
    if "units" in d:
        kw["units"] = tuple(UnitWindow(u["group"], str(u["dept_id"]), dd(u["open_date"]),
                                       dd(u["close_date"]), u.get("display_name"))
                            for u in d["units"])
    for k in ("vital_ids", "intervention_ids"):
        if k in d:
            kw[k] = tuple(MeasureId(str(m["flo_id"]), m.get("display_name")) for m in d[k])
    return StudyConfig(**kw)


UNITS_SCHEMA = "dpt_grp string, dpt_id string, opendate date, closedate date, displayName string"
IDS_SCHEMA = "FloId string, DisplayName string"


def units_frame(spark: SparkSession, units) -> DataFrame:
    rows = [(u.group, u.dept_id, u.open_date, u.close_date, u.display_name) for u in units]
    return spark.createDataFrame(rows, UNITS_SCHEMA)


def ids_frame(spark: SparkSession, ids) -> DataFrame:
    return spark.createDataFrame([(m.flo_id, m.display_name) for m in ids], IDS_SCHEMA)
