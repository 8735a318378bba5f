"""Exploratory helpers: department lists, department search, the department
network of a seed unit, and the flowsheet measurement ids seen inside ICU stays."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.expr import min_text, status_ok
from stayflow.operators.joins import restrict_to, within_interval
from stayflow.sources.catalog import SourceCatalog
from stayflow.sources.sinks import materialize

ACTIVE_STATUS = ["1"]


def _with_locations(src: SourceCatalog) -> DataFrame:
    dep = src.table("CLARITY_DEP")
    loc = src.table("CLARITY_LOC").select("LOC_ID", "LOC_NAME", "RECORD_STATUS")
    return dep.join(loc, dep["REV_LOC_ID"] == loc["LOC_ID"], "inner"), dep.columns


def _department_columns(j: DataFrame, dep_columns: Sequence[str]) -> DataFrame:
    """DEPARTMENT_ID, DEPARTMENT_NAME, LOC_NAME, then every other department column
    once (the reference repeats the first two via ``dpt.*``)."""
    lead = ["DEPARTMENT_ID", "DEPARTMENT_NAME"]
    rest = [c for c in dep_columns if c not in lead]
    return j.select(*lead, "LOC_NAME", *rest)


def all_departments(src: SourceCatalog) -> DataFrame:
    """Departments at active (status '1' or unset) locations, by location then id."""
    j, cols = _with_locations(src)
    j = j.filter(status_ok("RECORD_STATUS", ACTIVE_STATUS))
    return _department_columns(j, cols).orderBy("REV_LOC_ID", "DEPARTMENT_ID")


def search_departments(src: SourceCatalog, patterns: Sequence[str],
                       strict: bool = False) -> DataFrame:
    """Departments whose name matches one of the LIKE ``patterns``.

    Faithful default: ``(active AND like(p1)) OR like(p2) OR ...`` -- SQL's AND/OR
    precedence lets every pattern after the first skip the status filter.
    ``strict=True`` applies the status filter to all patterns.
    """
    j, cols = _with_locations(src)
    name = F.col("DEPARTMENT_NAME")
    likes = [name.like(p) for p in patterns]
    active = status_ok("RECORD_STATUS", ACTIVE_STATUS)
    if strict:
        cond = active & reduce(lambda a, b: a | b, likes)
    else:
        cond = reduce(lambda a, b: a | b, [active & likes[0], *likes[1:]])
    return _department_columns(j.filter(cond), cols)


def network_departments(src: SourceCatalog, seed_names: Sequence[str],
                        event_types: Sequence[str] = ("1", "2", "3", "4", "6")) -> DataFrame:
    """Every department visited by encounters that had an event of ``event_types``
    in a department named in ``seed_names``: first/last event time, location, unit
    type, beds ('0' if unset), periop flag ('N' if unset) and distinct encounters,
    most-visited first."""
    adt = src.table("CLARITY_ADT").select("PAT_ENC_CSN_ID", "DEPARTMENT_ID", "EFFECTIVE_TIME",
                                          "EVENT_TYPE_C")
    dep = src.table("CLARITY_DEP")
    seed_depts = dep.filter(F.col("DEPARTMENT_NAME").isin(list(seed_names))).select(
        "DEPARTMENT_ID")
    seed_enc = restrict_to(
        adt.filter(F.col("EVENT_TYPE_C").isin(list(event_types))
                   & F.col("PAT_ENC_CSN_ID").isNotNull()),
        seed_depts, "DEPARTMENT_ID").select("PAT_ENC_CSN_ID")
    rows = restrict_to(adt, seed_enc, "PAT_ENC_CSN_ID")
    # department INNER JOIN location LEFT JOIN unit type, as one right-hand side
    loc = src.table("CLARITY_LOC").select("LOC_ID", "LOC_NAME")
    unit = src.table("ZC_ADT_UNIT_TYPE").select("ADT_UNIT_TYPE_C", F.col("NAME").alias("UNIT_TYPE"))
    right = (dep.select("DEPARTMENT_ID", "DEPARTMENT_NAME", "REV_LOC_ID", "ADT_UNIT_TYPE_C",
                        "LICENSED_BEDS", "IS_PERIOP_DEP_YN")
             .join(loc, F.col("REV_LOC_ID") == F.col("LOC_ID"), "inner")
             .join(unit, "ADT_UNIT_TYPE_C", "left"))
    j = rows.join(right, "DEPARTMENT_ID", "left")
    g = j.groupBy("DEPARTMENT_NAME", "DEPARTMENT_ID", "LOC_NAME", "UNIT_TYPE",
                  "IS_PERIOP_DEP_YN", "LICENSED_BEDS").agg(
        F.min("EFFECTIVE_TIME").alias("FIRST_ADT_DATE"),
        F.max("EFFECTIVE_TIME").alias("LAST_ADT_DATE"),
        F.countDistinct("PAT_ENC_CSN_ID").alias("UNIQUE_PATIENTS"))
    out = g.select(
        "DEPARTMENT_NAME", "DEPARTMENT_ID", "FIRST_ADT_DATE", "LAST_ADT_DATE", "LOC_NAME",
        "UNIT_TYPE", F.coalesce(F.col("LICENSED_BEDS"), F.lit("0")).alias("LICENSED_BEDS"),
        F.coalesce(F.col("IS_PERIOP_DEP_YN"), F.lit("N")).alias("IS_PERIOP_DEP_YN"),
        "UNIQUE_PATIENTS").distinct()
    return out.orderBy(F.desc("UNIQUE_PATIENTS"))


#: The linguistic, case- and accent-sensitive order of names.
NAME_COLLATION = "UNICODE"


def flowsheet_catalog(src: SourceCatalog, cohort: DataFrame,
                      name_collation: str = NAME_COLLATION) -> DataFrame:
    """Flowsheet measurement ids recorded inside any ICU stay of the cohort, with
    their minimum names in the order of ``name_collation`` (display names: binary order)
    and occurrence counts, most frequent first. A measurement inside two overlapping stays
    counts twice.

    Starts from the cohort: its encounters, their flowsheet records (written out, so that
    the planner knows their size), then the measurements of those records alone. Counts
    are by id; names are looked up for the few ids counted."""
    keys = cohort.select("PAT_ENC_CSN_ID").distinct()
    enc = restrict_to(src.table("PAT_ENC_HSP").select("INPATIENT_DATA_ID", "PAT_ENC_CSN_ID"),
                      keys, "PAT_ENC_CSN_ID")
    rec = materialize(src.table("IP_FLWSHT_REC").select("FSD_ID", "INPATIENT_DATA_ID").join(
        enc, "INPATIENT_DATA_ID", "inner").select("FSD_ID", "PAT_ENC_CSN_ID"),
        "flowsheet-records")
    meas = src.table("IP_FLWSHT_MEAS").select("FSD_ID", "FLO_MEAS_ID", "RECORDED_TIME")
    stays = cohort.select(F.col("PAT_ENC_CSN_ID").alias("__csn"), "ICU_IN_DT", "ICU_OUT_DT")
    inside = within_interval(meas.join(rec, "FSD_ID", "inner"), stays,
                             {"PAT_ENC_CSN_ID": "__csn"}, "RECORDED_TIME", "ICU_IN_DT",
                             "ICU_OUT_DT")
    counts = inside.groupBy("FLO_MEAS_ID").agg(F.count(F.lit(1)).alias("__n"))
    names = (src.table("IP_FLO_GP_DATA").groupBy("FLO_MEAS_ID")
             .agg(min_text("FLO_MEAS_NAME", name_collation).alias("FLO_MEAS_NAME"),
                  F.min("DISP_NAME").alias("DisplayName"),
                  F.count(F.lit(1)).alias("__rows")))
    # an id described by several rows counts once for each, an unset id never
    return (counts.join(names, "FLO_MEAS_ID", "left")
            .select("FLO_MEAS_ID", "FLO_MEAS_NAME", "DisplayName",
                    F.when(F.col("FLO_MEAS_ID").isNull(), F.lit(0)).otherwise(
                        F.col("__n") * F.coalesce("__rows", F.lit(1))).alias("OCCURANCES"))
            .orderBy(F.desc("OCCURANCES")))
