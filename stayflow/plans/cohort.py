"""P1: the ICU-stay cohort.

1. seed: Admission / Transfer In events into a configured (non-bridge) unit while it
   was open, strictly inside the study window, subtype not Canceled (a NULL
   subtype is dropped too, as ``NOT IN`` drops it);
2. every distinct Admission / Transfer In / Transfer Out / Discharge event (not Canceled)
   of the seeded encounters, with its direction and unit group ('OTHER' when the
   department is not configured; open/close dates ignored);
3-6. stay reconstruction (``operators.stays.build_stays``);
7. stays starting strictly inside the window and lasting >= 0.5 h, with patient,
   department, room, disposition and sex attached.

Plan shape: the seed is a broadcast join against the unit configuration, the
expansion a left-semi join on the encounter key, and the stay windows share ONE
hash exchange on the encounter. Encounters with more ADT rows than
``cfg.hot_encounter_events`` are reconstructed in bounded chunks instead
(``operators.stays_chunked``), so no task holds a whole giant encounter. The seeded
encounters' events are materialised once and read by every later step. Descriptive lookups (patient names, department,
room, disposition, sex) are joined to the stays rather than to every event: the
lookup keys are unique, so the result is the same and far fewer rows are joined.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.expr import ntz
from stayflow.operators.joins import (
    classify, duplicate_keys, key_set, lookup, reduce_dimension, restrict_to,
    within_unit_window)
from stayflow.operators.stays import build_stays, hot_keys
from stayflow.sources.catalog import SourceCatalog
from stayflow.sources.config import StudyConfig, units_frame
from stayflow.sources.sinks import materialize

# Event type and subtype names used by the reference.
IN_TYPES = ["Admission", "Transfer In"]
OUT_TYPES = ["Transfer Out", "Discharge"]
CANCELED = ["Canceled"]

COHORT_COLUMNS = [
    "EVENT_ID", "PAT_ENC_CSN_ID", "PAT_ID", "PAT_MRN_ID", "PAT_LAST_NAME", "PAT_FIRST_NAME",
    "BIRTH_DATE", "EFFECTIVE_TIME", "EVENT_TIME", "EVENT_TYPE", "DEPARTMENT_NAME", "DEPT_GRP",
    "FIRST_ROOM_NAME", "HOSP_ADMIT_DT", "HOSP_DC_DT", "ICU_IN_DT", "ICU_OUT_DT", "IN_YEAR",
    "ICU_LOS_HRS", "DISCH_DISP", "DISCH_DISP_C", "SEX",
]


def named_events(src: SourceCatalog) -> DataFrame:
    adt = src.table("CLARITY_ADT").select(
        "EVENT_ID", "PAT_ENC_CSN_ID", "PAT_ID", "EFFECTIVE_TIME", "EVENT_TIME", "SEQ_NUM_IN_ENC",
        "EVENT_TYPE_C", "EVENT_SUBTYPE_C", "DEPARTMENT_ID", "ROOM_ID")
    adt = lookup(adt, src.table("ZC_EVENT_TYPE"), "EVENT_TYPE_C", {"NAME": "EVENT_TYPE"})
    return lookup(adt, src.table("ZC_EVENT_SUBTYPE"), "EVENT_SUBTYPE_C",
                  {"NAME": "EVENT_SUB_TYPE"})


def seed_encounters(src: SourceCatalog, cfg: StudyConfig, events: DataFrame | None = None
                    ) -> DataFrame:
    """Distinct encounter ids admitted or transferred into a configured unit."""
    ev = named_events(src) if events is None else events
    units = units_frame(src.spark, cfg.units)
    seed = within_unit_window(ev, units, "DEPARTMENT_ID", "EFFECTIVE_TIME",
                              skip_groups=cfg.bridge_groups)
    t = F.col("EFFECTIVE_TIME")
    seed = seed.filter(F.col("EVENT_TYPE").isin(IN_TYPES) & (t > ntz(cfg.start))
                       & (t < ntz(cfg.end)) & ~F.col("EVENT_SUB_TYPE").isin(CANCELED))
    return seed.select("PAT_ENC_CSN_ID").distinct()


def cohort_events(src: SourceCatalog, cfg: StudyConfig) -> DataFrame:
    """All movement events of the seeded encounters with EVENT_DIR and DEPT_GRP."""
    ev = named_events(src)
    ev = restrict_to(ev, seed_encounters(src, cfg, ev), "PAT_ENC_CSN_ID")
    ev = ev.filter(F.col("EVENT_TYPE").isin(IN_TYPES + OUT_TYPES)
                   & ~F.col("EVENT_SUB_TYPE").isin(CANCELED))
    ev = ev.withColumn("EVENT_DIR", F.when(F.col("EVENT_TYPE").isin(IN_TYPES), F.lit("In"))
                       .when(F.col("EVENT_TYPE").isin(OUT_TYPES), F.lit("Out")))
    ev = classify(ev, units_frame(src.spark, cfg.units), "DEPARTMENT_ID")
    # event rows are compared by type and subtype names, not codes; dealt by encounter
    # first, so that collapsing repeated rows and the stay windows share one exchange
    return ev.drop("EVENT_TYPE_C", "EVENT_SUBTYPE_C").repartition("PAT_ENC_CSN_ID").distinct()


# lookup tables of the cohort plan and their keys (checked by check_lookup_keys)
LOOKUP_KEYS = {
    "ZC_EVENT_TYPE": ["EVENT_TYPE_C"], "ZC_EVENT_SUBTYPE": ["EVENT_SUBTYPE_C"],
    "PATIENT": ["PAT_ID"], "CLARITY_DEP": ["DEPARTMENT_ID"], "ED_ROOM_INFO": ["ROOM_ID"],
    "PAT_ENC_HSP": ["PAT_ENC_CSN_ID"], "ZC_DISCH_DISP": ["DISCH_DISP_C"],
    "ZC_SEX": ["RCPT_MEM_SEX_C"],
}


def check_lookup_keys(src: SourceCatalog) -> None:
    """Raise if a lookup table of the cohort plan has duplicate keys (Q22)."""
    bad = {name: dups for name, keys in LOOKUP_KEYS.items()
           if (dups := duplicate_keys(src.table(name), keys))}
    if bad:
        raise ValueError(f"duplicate lookup keys would duplicate stays: {bad}")


def all_encounters(src: SourceCatalog, cfg: StudyConfig) -> DataFrame:
    """One row per ICU stay, 22 columns (COHORT_COLUMNS)."""
    cfg = cfg.validate()
    if cfg.check_lookup_keys:
        check_lookup_keys(src)
    # the seeded encounters' events (a small part of the ADT log) are written once:
    # hot-encounter detection, the lookup key set and the stay windows all read that
    # file instead of re-scanning the log, and lineage is cut before the windows
    ev = materialize(cohort_events(src, cfg), "cohort-events")
    hot = None
    if cfg.hot_encounter_events is not None:
        hot = hot_keys(ev.select("PAT_ENC_CSN_ID"), "PAT_ENC_CSN_ID", cfg.hot_encounter_events)
    stays = build_stays(
        ev, "PAT_ENC_CSN_ID", ["SEQ_NUM_IN_ENC", "EVENT_DIR", "EVENT_ID", "DEPT_GRP"],
        "DEPT_GRP", "EVENT_DIR", "EFFECTIVE_TIME", bridge_groups=cfg.bridge_groups,
        outside_groups=cfg.outside_groups, min_hours=cfg.min_stay_hours,
        window=(cfg.start, cfg.end), hot=hot, chunk_rows=cfg.chunk_events)
    # the large patient and encounter tables are reduced to the cohort's keys (taken
    # from the events before the windows, materialised) before their lookups
    keys = key_set(ev, ["PAT_ENC_CSN_ID", "PAT_ID"], "cohort-event-keys")
    patient = reduce_dimension(src.table("PATIENT"), keys.select("PAT_ID"), "PAT_ID")
    s = lookup(stays, patient, "PAT_ID",
               {"PAT_LAST_NAME": "PAT_LAST_NAME", "PAT_FIRST_NAME": "PAT_FIRST_NAME",
                "PAT_MRN_ID": "PAT_MRN_ID", "BIRTH_DATE": "BIRTH_DATE", "SEX_C": "SEX_C"})
    s = lookup(s, src.table("CLARITY_DEP"), "DEPARTMENT_ID",
               {"DEPARTMENT_NAME": "DEPARTMENT_NAME"})
    s = lookup(s, src.table("ED_ROOM_INFO"), "ROOM_ID", {"ROOM_NAME": "FIRST_ROOM_NAME"})
    s = lookup(s, reduce_dimension(src.table("PAT_ENC_HSP"), keys.select("PAT_ENC_CSN_ID"),
                                   "PAT_ENC_CSN_ID"),
               "PAT_ENC_CSN_ID", {"DISCH_DISP_C": "DISCH_DISP_C"})
    s = lookup(s, src.table("ZC_DISCH_DISP"), "DISCH_DISP_C", {"NAME": "DISCH_DISP"})
    s = lookup(s, src.table("ZC_SEX"), {"SEX_C": "RCPT_MEM_SEX_C"}, {"NAME": "SEX"})
    return s.select(*[F.col("VISIT_IN_DT").alias("ICU_IN_DT") if c == "ICU_IN_DT" else
                      F.col("OUT_DT").alias("ICU_OUT_DT") if c == "ICU_OUT_DT" else F.col(c)
                      for c in COHORT_COLUMNS])
