"""P2-P7: extracts hanging off the cohort (hospital, ICU, conditions, labs,
vital signs and interventions). Pass the published cohort (``sinks.publish`` /
``plans.run.extracts``), as the reference's scripts read its published table.

Every extract restricts its source facts to the cohort's encounters with a left-semi
join BEFORE the descriptive lookups, so the large fact tables are filtered first; the
cohort key set is small and is broadcast when the planner's size check allows it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.expr import boundary_diff, day_diff, flag, typed_null, year_of
from stayflow.operators.joins import key_set, lookup, reduce_dimension, restrict_to
from stayflow.operators.merge import listagg_sorted, tagged_union
from stayflow.sources.catalog import SourceCatalog
from stayflow.sources.config import MeasureId
from stayflow.sources.sinks import materialize

DEATH = "20"              # fixed value: discharge disposition code meaning death
LOINC_LABEL = "LONIC CODE"  # fixed value: the reference's (misspelt) nomenclature label
COMPONENT_LABEL = "COMPONENT CODE"


def _cohort_keys(cohort: DataFrame, col: str = "PAT_ENC_CSN_ID") -> DataFrame:
    """The cohort's distinct keys. Extracts expect the published cohort (a parquet
    table, see ``plans.run``), whose real size the planner sees, so these keys are
    broadcast into fact-table scans exactly when they are small."""
    return cohort.select(col).distinct()


# -- P2 hospital ---------------------------------------------------------------

def patient_names(src: SourceCatalog, cohort: DataFrame, link_table: str, code_col: str,
                  category: str, out: str) -> DataFrame:
    """'|'-joined category names per cohort patient (ordered by name, duplicates kept)."""
    pats = _cohort_keys(cohort, "PAT_ID")
    links = restrict_to(src.table(link_table).select("PAT_ID", code_col), pats, "PAT_ID")
    # patients that exist: the (large) patient table reduced to the cohort's patients
    known = reduce_dimension(src.table("PATIENT").select("PAT_ID"), pats, "PAT_ID")
    links = restrict_to(links, known, "PAT_ID")
    named = links.join(src.table(category).select(code_col, "NAME"), code_col, "inner")
    return named.groupBy("PAT_ID").agg(listagg_sorted("NAME", "|").alias(out))


def hospital(src: SourceCatalog, cohort: DataFrame) -> DataFrame:
    """One row per (patient, encounter)."""
    race = patient_names(src, cohort, "PATIENT_RACE", "PATIENT_RACE_C", "ZC_PATIENT_RACE",
                         "RACE")
    eth = patient_names(src, cohort, "ETHNIC_BACKGROUND", "ETHNIC_BKGRND_C", "ZC_ETHNIC_BKGRND",
                        "ETHNICITY")
    c = cohort.join(race, "PAT_ID", "left").join(eth, "PAT_ID", "left")
    disp, out_dt, dc = F.col("DISCH_DISP_C"), F.col("ICU_OUT_DT"), F.col("HOSP_DC_DT")
    died_after_unit = flag((disp == DEATH) & (out_dt < dc))
    g = c.groupBy("PAT_ID", "PAT_ENC_CSN_ID").agg(
        F.min("SEX").alias("sex"),
        F.min("BIRTH_DATE").alias("BIRTH_DATE"),
        F.min("HOSP_ADMIT_DT").alias("HOSP_ADMIT_DT"),
        F.min(day_diff("BIRTH_DATE", "HOSP_ADMIT_DT")).alias("ageAtAdmission_Anonymized"),
        F.min("HOSP_DC_DT").alias("HOSP_DC_DT"),
        F.min(boundary_diff("SECOND", "HOSP_ADMIT_DT", "HOSP_DC_DT"))
        .alias("hospitalDischarge_Anonymized"),
        F.min("RACE").alias("RACE"),
        F.min("ETHNICITY").alias("ETHNICITY"),
        F.max(died_after_unit).alias("hospitalMortality"),
        F.min(year_of("HOSP_ADMIT_DT")).alias("yearOfAdmission"))
    return g.select(F.col("PAT_ID").alias("pid"), F.col("PAT_ENC_CSN_ID").alias("hid"),
                    "sex", "BIRTH_DATE", "HOSP_ADMIT_DT", "ageAtAdmission_Anonymized",
                    "HOSP_DC_DT", "hospitalDischarge_Anonymized", "RACE", "ETHNICITY",
                    "hospitalMortality", "yearOfAdmission")


# -- P3 icu --------------------------------------------------------------------

def icu(cohort: DataFrame) -> DataFrame:
    """One row per ICU stay, times relative to hospital admission."""
    disp = F.col("DISCH_DISP_C")
    died_in_unit = flag((disp == DEATH) & (F.col("ICU_OUT_DT") == F.col("HOSP_DC_DT")))
    return cohort.select(
        F.col("PAT_ID").alias("pid"), F.col("EVENT_ID").alias("eid"),
        F.col("PAT_ENC_CSN_ID").alias("hid"), F.col("DEPT_GRP").alias("icu"),
        F.col("ICU_IN_DT").alias("icuAdmission"),
        boundary_diff("SECOND", "HOSP_ADMIT_DT", "ICU_IN_DT").alias("icuAdmission_Anonymized"),
        F.col("ICU_OUT_DT").alias("icuDischarge"),
        boundary_diff("SECOND", "HOSP_ADMIT_DT", "ICU_OUT_DT").alias("icuDischarge_Anonymized"),
        F.col("DISCH_DISP").alias("icuDisposition"), died_in_unit.alias("icuMortality"),
        "PAT_MRN_ID", "PAT_LAST_NAME", "PAT_FIRST_NAME")


# -- P4 conditions ---------------------------------------------------------------

def _dx(df: DataFrame, start: str, end: str, dx: str, primary) -> DataFrame:
    return df.select(
        F.col("PAT_ENC_CSN_ID").alias("CSN"),
        F.col(start).cast("timestamp_ntz").alias("START_DT"),
        (F.col(end) if end else typed_null("timestamp_ntz")).cast("timestamp_ntz")
        .alias("END_DT"),
        F.col(dx).alias("DX_ID"), primary.alias("PRIMARY_YN"))


def diagnoses(src: SourceCatalog, cohort: DataFrame) -> DataFrame:
    """Distinct (CSN, start, end, dx, name, source, ICD-10 list, primary) rows from the
    four diagnosis sources, restricted to cohort encounters."""
    keys = _cohort_keys(cohort)
    enc_dx = restrict_to(src.table("PAT_ENC_DX"), keys, "PAT_ENC_CSN_ID")
    # the cohort's rows of these facts are written once, and read for their keys and again
    # for the lookups
    prob = materialize(restrict_to(src.table("PAT_ENC_HOSP_PROB").select(
        "PAT_ENC_CSN_ID", "PROBLEM_LIST_ID", "PRINCIPAL_PROB_YN"), keys, "PAT_ENC_CSN_ID"),
        "cohort-problems")
    problems = reduce_dimension(src.table("PROBLEM_LIST"),
                                key_set(prob, ["PROBLEM_LIST_ID"], "problem-ids"),
                                "PROBLEM_LIST_ID")
    prob = lookup(prob, problems, "PROBLEM_LIST_ID",
                  {"NOTED_DATE": "NOTED_DATE", "RESOLVED_DATE": "RESOLVED_DATE",
                   "DX_ID": "DX_ID"})
    bill = materialize(restrict_to(src.table("PAT_ENC").select(
        "PAT_ENC_CSN_ID", "HSP_ACCOUNT_ID"), keys, "PAT_ENC_CSN_ID"), "cohort-accounts")
    accounts = key_set(bill, ["HSP_ACCOUNT_ID"], "account-ids")
    bill = lookup(bill, reduce_dimension(src.table("HSP_ACCOUNT"), accounts, "HSP_ACCOUNT_ID"),
                  "HSP_ACCOUNT_ID",
                  {"ADM_DATE_TIME": "ADM_DATE_TIME", "LAST_INTRM_BILL_DT": "LAST_INTRM_BILL_DT"})
    bill = lookup(bill, reduce_dimension(src.table("HSP_ACCT_DX_LIST"), accounts,
                                         "HSP_ACCOUNT_ID"),
                  "HSP_ACCOUNT_ID", {"DX_ID": "DX_ID"})
    ed = restrict_to(src.table("F_ED_ENCOUNTERS").filter(F.col("PRIMARY_DX_ED_YN") == "Y"),
                     keys, "PAT_ENC_CSN_ID")
    u = tagged_union({
        "ENC_DX": _dx(enc_dx, "CONTACT_DATE", "CONTACT_DATE", "DX_ID",
                      F.nullif(F.col("PRIMARY_DX_YN"), F.lit("N"))),
        "PROB_LIST": _dx(prob, "NOTED_DATE", "RESOLVED_DATE", "DX_ID",
                         F.nullif(F.col("PRINCIPAL_PROB_YN"), F.lit("N"))),
        "BILLING": _dx(bill, "ADM_DATE_TIME", "LAST_INTRM_BILL_DT", "DX_ID",
                       typed_null("string")),
        "ED_PRIMARY": _dx(ed, "ED_DISPOSITION_DTTM", "ED_DISPOSITION_DTTM", "PRIMARY_DX_ID",
                          F.nullif(F.col("PRIMARY_DX_ED_YN"), F.lit("N"))),
    })
    u = lookup(u, src.table("CLARITY_EDG"), "DX_ID",
               {"DX_NAME": "DX_NAME", "CURRENT_ICD10_LIST": "CURRENT_ICD10_LIST"})
    return u.filter(F.col("DX_ID").isNotNull()).distinct()


def conditions(src: SourceCatalog, cohort: DataFrame) -> DataFrame:
    """One row per (encounter, diagnosis, start, end); on ties the lexically least
    source wins (BILLING < ED_PRIMARY < ENC_DX < PROB_LIST)."""
    dia = diagnoses(src, cohort)
    # every aggregate is a MIN, so de-duplicating the cohort's per-stay rows first
    # gives the same result with less fan-out
    enc = cohort.select(F.col("PAT_ENC_CSN_ID").alias("CSN"), "PAT_ID", "BIRTH_DATE").distinct()
    j = dia.join(enc, "CSN", "inner")
    birth = F.col("BIRTH_DATE")
    g = j.groupBy("CSN", "DX_ID", "START_DT", "END_DT").agg(
        F.min("PAT_ID").alias("pid"), F.min(birth).alias("BIRTH_DATE"),
        F.min(day_diff(birth, "START_DT")).alias("recorded_Anonymized"),
        F.min("CURRENT_ICD10_LIST").alias("code"), F.min("DX_NAME").alias("codeText"),
        F.min("SOURCE").alias("source"), F.min("START_DT").alias("onset"),
        F.min("END_DT").alias("abatement"),
        F.min(day_diff(birth, "END_DT")).alias("abatement_Anonymized"),
        F.min("PRIMARY_YN").alias("isPrimary"))
    return g.select(
        "pid", F.col("CSN").alias("hid"), "BIRTH_DATE", F.col("START_DT").alias("recorded"),
        "recorded_Anonymized", F.lit("ICD10").alias("nomenclature"), "code", "codeText",
        "source", "onset", F.col("recorded_Anonymized").alias("onset_Anonymized"),
        "abatement", "abatement_Anonymized",
        F.when(F.col("END_DT").isNotNull(), F.lit("1")).otherwise(F.lit("0"))
        .alias("abatementBoolean"), "isPrimary")


# -- P5 labs -----------------------------------------------------------------------

def labs(src: SourceCatalog, cohort: DataFrame) -> DataFrame:
    """One row per lab result component of a cohort encounter."""
    res = materialize(restrict_to(src.table("ORDER_RESULTS").select(
        "ORDER_PROC_ID", "PAT_ENC_CSN_ID", "COMPONENT_ID", "COMPON_LNC_ID", "RESULT_TIME",
        "ORD_VALUE"), _cohort_keys(cohort), "PAT_ENC_CSN_ID"), "cohort-results")
    orders = key_set(res, ["ORDER_PROC_ID"], "lab-order-ids")
    x = lookup(res, reduce_dimension(src.table("ORDER_PROC"), orders, "ORDER_PROC_ID"),
               "ORDER_PROC_ID", {"ORDER_PROC_ID": "__op_id", "ORDER_TIME": "ORDER_TIME"})
    # the second order table hangs off the first (no row there, no row here)
    x = lookup(x, reduce_dimension(src.table("ORDER_PROC_2"), orders, "ORDER_PROC_ID"),
               {"__op_id": "ORDER_PROC_ID"}, {"SPECIMN_TAKEN_TIME": "SPECIMN_TAKEN_TIME"})
    x = lookup(x, src.table("CLARITY_COMPONENT"), "COMPONENT_ID",
               {"COMPONENT_ID": "__comp_id", "NAME": "__comp_name", "LOINC_CODE": "LOINC_CODE",
                "DFLT_UNITS": "DFLT_UNITS"})
    x = lookup(x, src.table("LNC_DB_MAIN"), {"COMPON_LNC_ID": "RECORD_ID"},
               {"LNC_CODE": "LNC_CODE", "LNC_FULL_NAM": "LNC_FULL_NAM"})
    x = lookup(x, reduce_dimension(src.table("PAT_ENC"), _cohort_keys(cohort),
                                    "PAT_ENC_CSN_ID"),
               "PAT_ENC_CSN_ID", {"PAT_ID": "PAT_ID", "HOSP_ADMSN_TIME": "HOSP_ADMIT_DT"})
    lnc, comp = F.col("LNC_CODE"), F.col("LOINC_CODE")
    return x.select(
        F.col("PAT_ID").alias("pid"), F.col("PAT_ENC_CSN_ID").alias("hid"),
        F.when(F.coalesce(lnc, comp).isNull(), F.lit(COMPONENT_LABEL))
        .otherwise(F.lit(LOINC_LABEL)).alias("nomenclature"),
        F.coalesce(lnc, comp, F.col("__comp_id").cast("string")).alias("code"),
        F.coalesce(F.col("LNC_FULL_NAM"), F.col("__comp_name")).alias("NAME"),
        "HOSP_ADMIT_DT", F.col("SPECIMN_TAKEN_TIME").alias("sampleTime"),
        boundary_diff("SECOND", "HOSP_ADMIT_DT", "SPECIMN_TAKEN_TIME")
        .alias("sampleTime_Anonymized"),
        F.col("RESULT_TIME").alias("resultTime"),
        boundary_diff("SECOND", "HOSP_ADMIT_DT", "RESULT_TIME").alias("resultTime_Anonymized"),
        F.col("ORD_VALUE").alias("value"), F.col("DFLT_UNITS").alias("units"),
        F.col("ORDER_TIME").alias("orderTime"),
        boundary_diff("SECOND", "HOSP_ADMIT_DT", "ORDER_TIME").alias("orderTime_Anonymized"))


# -- P6 / P7 flowsheets ---------------------------------------------------------------

def flowsheet_extract(src: SourceCatalog, cohort: DataFrame, ids: Sequence[MeasureId]
                      ) -> DataFrame:
    """Flowsheet measurements of the configured ids for cohort encounters.

    The measurement table is the largest input: it is filtered by the configured id
    list first (a literal IN list, so the filter reaches the parquet scan), then
    joined to the records of cohort encounters, which are found starting from the
    cohort side (encounter -> inpatient record -> flowsheet record).
    ``code`` is the flowsheet record id (FSD_ID), as in the reference.
    """
    id_list = sorted({m.flo_id for m in ids})
    meas = src.table("IP_FLWSHT_MEAS").select(
        "FSD_ID", "FLO_MEAS_ID", "RECORDED_TIME", "MEAS_VALUE", "DOCUMENTATION_SOURCE_C")
    meas = meas.filter(F.col("FLO_MEAS_ID").isin(id_list))
    enc = restrict_to(src.table("PAT_ENC_HSP").select("PAT_ENC_CSN_ID", "PAT_ID",
                                                      "INPATIENT_DATA_ID"),
                      _cohort_keys(cohort), "PAT_ENC_CSN_ID")
    # the cohort's flowsheet records (multiplicity kept): small and materialised, so
    # the planner can broadcast them into the scan of the measurement table
    rec = materialize(src.table("IP_FLWSHT_REC").select("FSD_ID", "INPATIENT_DATA_ID").join(
        enc, "INPATIENT_DATA_ID", "inner"), "flowsheet-records")
    x = meas.join(rec, "FSD_ID", "inner")
    x = lookup(x, src.table("ZC_FLO_DOC_SRC"), "DOCUMENTATION_SOURCE_C", {"NAME": "source"})
    x = lookup(x, src.table("IP_FLO_GP_DATA"), "FLO_MEAS_ID",
               {"UNITS": "units", "DISP_NAME": "name"})
    x = lookup(x, reduce_dimension(src.table("PATIENT"), rec.select("PAT_ID"), "PAT_ID"),
               "PAT_ID", {"PAT_ID": "__pat_id", "BIRTH_DATE": "BIRTH_DATE"})
    return x.select(
        F.col("__pat_id").alias("pid"), F.col("PAT_ENC_CSN_ID").alias("hid"),
        F.col("FSD_ID").alias("code"), F.col("RECORDED_TIME").alias("startTime"),
        boundary_diff("SECOND", "BIRTH_DATE", "RECORDED_TIME").alias("startTime_Anonymized"),
        F.col("MEAS_VALUE").alias("value"), "units", "source", "name")


def vitals(src: SourceCatalog, cohort: DataFrame, cfg) -> DataFrame:
    return flowsheet_extract(src, cohort, cfg.vital_ids)


def interventions(src: SourceCatalog, cohort: DataFrame, cfg) -> DataFrame:
    return flowsheet_extract(src, cohort, cfg.intervention_ids)
