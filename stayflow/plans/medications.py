"""P8-P13: medication administrations and their nomenclature linkage.

P9 ``medications`` is the administration set (the caller writes it DISTINCT; the
reports count the raw rows). P10-P13 expand each principal medication into related
ids, link every id to standard nomenclatures, and report how many principal ids
reach an RxNorm code directly or through a related id. ``medication_chain``
materialises the reused, catalog-sized intermediates once, as the reference does
with its temp tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.expr import status_ok
from stayflow.operators.coverage import coverage_summary, coverage_waterfall, unmatched_ids
from stayflow.operators.hierarchy import expand_hierarchy
from stayflow.operators.joins import lookup, reduce_dimension, restrict_to, sieved
from stayflow.operators.linkage import (
    best_code, class_links_shared, link_codes, link_rows, unpivot_ids)
from stayflow.sources.catalog import SourceCatalog
from stayflow.sources.sinks import materialize

RXNORM_LABEL = "RXNORM CODE"        # fixed values of the legacy extract
MEDICATION_ID_LABEL = "MEDICATION ID"


def cohort_orders(src: SourceCatalog, cohort: DataFrame) -> DataFrame:
    """The used columns of the orders of cohort encounters, materialised once for both
    administration extracts: the administration table (the largest input) is then joined
    to a relation whose real size the planner knows, i.e. broadcast into its scan when
    small enough."""
    orders = src.table("ORDER_MED").select(
        "ORDER_MED_ID", "PAT_ID", "PAT_ENC_CSN_ID", "MEDICATION_ID", "DESCRIPTION",
        "DISPLAY_NAME", "ORDER_STATUS_C")
    keys = cohort.select("PAT_ENC_CSN_ID").distinct()
    return materialize(restrict_to(orders, keys, "PAT_ENC_CSN_ID"), "cohort-orders")


def _order_info(src: SourceCatalog, orders: DataFrame) -> DataFrame:
    """ORDER_MEDINFO rows of the given orders only (semi-join reduction)."""
    return reduce_dimension(src.table("ORDER_MEDINFO"), orders.select("ORDER_MED_ID"),
                            "ORDER_MED_ID")


def _administrations(src: SourceCatalog, orders: DataFrame, om: DataFrame) -> DataFrame:
    """The administrations of ``orders`` with the columns of ``om``: the same orders under key
    __om, with whatever is looked up by a column of an order. Such lookups are made before this
    join, where there are fewer and narrower rows to move than administrations; the latter are
    reduced to those of the orders where they are scanned, and moved once."""
    mar = sieved(src.table("MAR_ADMIN_INFO"), orders.select("ORDER_MED_ID"), "ORDER_MED_ID")
    return mar.join(om, mar["ORDER_MED_ID"] == om["__om"], "inner")


# (category table, its key, administration column, name alias, code alias)
_UNIT_LOOKUPS = [
    ("ZC_MAR_RSLT", "RESULT_C", "MAR_ACTION_C", "__action", "__action_code"),
    ("ZC_ADMIN_ROUTE", "MED_ROUTE_C", "ROUTE_C", "__route", "__route_code"),
    ("ZC_MED_UNIT", "DISP_QTYUNIT_C", "MAR_INF_RATE_UNIT_C", "__rate_unit", "__rate_unit_code"),
    ("ZC_MED_UNIT", "DISP_QTYUNIT_C", "DOSE_UNIT_C", "__dose_unit", "__dose_unit_code"),
    ("ZC_MED_DURATION_UN", "MED_DURATION_UN_C", "MAR_DURATION_UNIT_C", "__dur_unit",
     "__dur_unit_code"),
]


def _unit_lookups(x: DataFrame, src: SourceCatalog, with_codes: bool) -> DataFrame:
    """Action, route, dose/rate unit (one category table in two roles) and duration
    unit names, plus their internal codes when ``with_codes``."""
    for table, key, fact_col, name_out, code_out in _UNIT_LOOKUPS:
        cols = {"NAME": name_out}
        if with_codes:
            cols["INTERNAL_ID"] = code_out
        x = lookup(x, src.table(table), {fact_col: key}, cols)
    return x


def medications(src: SourceCatalog, cohort: DataFrame, orders: DataFrame | None = None
                ) -> DataFrame:
    """P9: administrations of cohort orders, 21 columns, NOT de-duplicated. ``orders``:
    the result of ``cohort_orders``, if there is one already."""
    orders = cohort_orders(src, cohort) if orders is None else orders
    om = orders.select(
        F.col("ORDER_MED_ID").alias("__om"), "PAT_ID", "PAT_ENC_CSN_ID", "DISPLAY_NAME")
    om = lookup(om, _order_info(src, orders), {"__om": "ORDER_MED_ID"},
                {"DISPENSABLE_MED_ID": "__disp_id"})
    om = lookup(om, src.table("CLARITY_MEDICATION"), {"__disp_id": "MEDICATION_ID"},
                {"MEDICATION_ID": "medID", "NAME": "medName"})
    x = _unit_lookups(_administrations(src, orders, om), src, with_codes=True)
    return x.select(
        F.col("PAT_ID").alias("pid"), F.col("PAT_ENC_CSN_ID").alias("hid"), "medID",
        F.col("ORDER_MED_ID").alias("orderMedID"), "medName", "DISPLAY_NAME",
        F.col("TAKEN_TIME").alias("startTime"), F.col("SAVED_TIME").alias("eventTime"),
        F.col("__route").alias("route"), F.col("__route_code").alias("routeCode"),
        F.col("SIG").alias("doseQuantity"), F.col("__dose_unit").alias("quantityUnits"),
        F.col("__dose_unit_code").alias("quantityUnitCode"),
        F.col("INFUSION_RATE").alias("doseRate"), F.col("__rate_unit").alias("rateUnits"),
        F.col("__rate_unit_code").alias("rateUnitCode"), F.col("MAR_DURATION").alias("duration"),
        F.col("__dur_unit").alias("durationUnit"),
        F.col("__dur_unit_code").alias("durationUnitCode"),
        F.col("__action").alias("marAction"), F.col("__action_code").alias("marActionCode"))


def rxnorm_pick(src: SourceCatalog, meds: DataFrame | None = None) -> DataFrame:
    """Per medication: highest eligible term type, then the max code with that type. With
    ``meds`` (materialised, column MEDICATION_ID), medications beyond those may be left out."""
    codes = src.table("RXNORM_CODES")
    if meds is not None:
        codes = sieved(codes, meds, "MEDICATION_ID")
    eligible = (status_ok("RXNORM_CODE_LEVEL_C", ["1"])
                & status_ok("RXNORM_TERM_TYPE_C", ["1", "3"]))
    return best_code(codes, "MEDICATION_ID", "RXNORM_TERM_TYPE_C", "RXNORM_CODE", eligible) \
        .select("MEDICATION_ID", F.col("RXNORM_CODE").alias("rxnormcode"),
                F.lit(RXNORM_LABEL).alias("nomenclature"))


def medications_v1(src: SourceCatalog, cohort: DataFrame, orders: DataFrame | None = None
                   ) -> DataFrame:
    """P8: the legacy wide administration extract (29 columns). Names and classes
    come from the dispensable medication, the code from the ordered one."""
    orders = cohort_orders(src, cohort) if orders is None else orders
    om = orders.select(
        F.col("ORDER_MED_ID").alias("__om"), F.col("PAT_ENC_CSN_ID"), "MEDICATION_ID",
        "DESCRIPTION", "DISPLAY_NAME", "ORDER_STATUS_C")
    om = lookup(om, _order_info(src, orders), {"__om": "ORDER_MED_ID"},
                {"DISPENSABLE_MED_ID": "__disp_id"})
    om = lookup(om, src.table("CLARITY_MEDICATION"), {"__disp_id": "MEDICATION_ID"},
                {"NAME": "MED_NAME", "ROUTE": "MED_ROUTE", "THERA_CLASS_C": "__thera",
                 "PHARM_CLASS_C": "__pharm", "PHARM_SUBCLASS_C": "__sub",
                 "SIMPLE_GENERIC_C": "__sg"})
    om = lookup(om, src.table("ZC_ORDER_STATUS"), "ORDER_STATUS_C", {"NAME": "ORDER_STATUS"})
    om = lookup(om, src.table("ZC_THERA_CLASS"), {"__thera": "THERA_CLASS_C"},
                {"NAME": "THERA_CLASS"})
    om = lookup(om, src.table("ZC_PHARM_CLASS"), {"__pharm": "PHARM_CLASS_C"},
                {"NAME": "PHARM_CLASS"})
    om = lookup(om, src.table("ZC_PHARM_SUBCLASS"), {"__sub": "PHARM_SUBCLASS_C"},
                {"NAME": "PHARM_SUBCLASS"})
    om = lookup(om, src.table("ZC_SIMPLE_GENERIC"), {"__sg": "SIMPLE_GENERIC_C"},
                {"NAME": "SIMPLE_GENERIC"})
    om = lookup(om, rxnorm_pick(src, orders.select("MEDICATION_ID")), "MEDICATION_ID",
                {"rxnormcode": "__rx_code", "nomenclature": "__rx_nom"})
    encounters = materialize(reduce_dimension(
        src.table("PAT_ENC").select("PAT_ENC_CSN_ID", "PAT_ID"),
        orders.select("PAT_ENC_CSN_ID"), "PAT_ENC_CSN_ID"), "cohort-order-encounters")
    # an encounter's person is found before the orders are joined: there are fewer encounters
    persons = lookup(
        encounters.withColumnRenamed("PAT_ID", "__enc_pat"),
        reduce_dimension(src.table("PATIENT"), encounters.select("PAT_ID"), "PAT_ID"),
        {"__enc_pat": "PAT_ID"}, {"BIRTH_DATE": "BIRTH_DATE"})
    om = lookup(om, persons, "PAT_ENC_CSN_ID",
                {"__enc_pat": "__enc_pat", "BIRTH_DATE": "BIRTH_DATE"})
    x = _unit_lookups(_administrations(src, orders, om), src, with_codes=False)
    x = lookup(x, src.table("ZC_MAR_TIME_SRC"), {"MAR_TIME_SOURCE_C": "MAR_TIME_SRC_C"},
               {"NAME": "MAR_TIME_SRC"})
    x = lookup(x, src.table("ZC_MAR_RSN"), "REASON_C", {"NAME": "MAR_REASON"})
    x = lookup(x, src.table("CLARITY_DEP"), {"MAR_ADMIN_DEPT_ID": "DEPARTMENT_ID"},
               {"DEPARTMENT_NAME": "MED_ADMIN_DEPT_NAME"})
    return x.select(
        F.col("__enc_pat").alias("PAT_ID"), "ORDER_MED_ID", "PAT_ENC_CSN_ID", "LINE",
        "TAKEN_TIME", "BIRTH_DATE", "MAR_TIME_SRC", F.col("__action").alias("MAR_ACTION"),
        "SIG", F.col("__route").alias("ADMIN_ROUTE"), "MED_ROUTE", "MAR_REASON",
        "INFUSION_RATE", F.col("__rate_unit").alias("MAR_INF_RATE_UNIT"),
        F.col("__dose_unit").alias("DOSE_UNIT"), "MAR_DURATION",
        F.col("__dur_unit").alias("MAR_DURATION_UNIT"), "MED_ADMIN_DEPT_NAME", "MEDICATION_ID",
        "DESCRIPTION", "DISPLAY_NAME", "ORDER_STATUS", "MED_NAME", "THERA_CLASS", "PHARM_CLASS",
        "PHARM_SUBCLASS", "SIMPLE_GENERIC",
        F.coalesce(F.col("__rx_code"), F.col("MEDICATION_ID").cast("string")).alias("code"),
        F.coalesce(F.col("__rx_nom"), F.lit(MEDICATION_ID_LABEL)).alias("nomenclature"))


def med_hierarchy(src: SourceCatalog, meds: DataFrame) -> DataFrame:
    """P10: principal medication ids with ingredients, components, production drugs."""
    return expand_hierarchy(meds.select("medID"), src.table("RX_MED_INGRED_ID"),
                            src.table("RX_MED_MIX_COMPON"), src.table("DRUG_PRODUCTION"),
                            src.table("ZC_INGRED_TYPE"))


# (nomenclature, medication master column, category table, category key)
CLASS_LINKS = [
    ("THERA_CLASS", "THERA_CLASS_C", "ZC_THERA_CLASS", "THERA_CLASS_C"),
    ("PHARM_CLASS", "PHARM_CLASS_C", "ZC_PHARM_CLASS", "PHARM_CLASS_C"),
    ("PHARM_SUBCLASS", "PHARM_SUBCLASS_C", "ZC_PHARM_SUBCLASS", "PHARM_SUBCLASS_C"),
    ("SIMPLE GENERIC", "SIMPLE_GENERIC_C", "ZC_SIMPLE_GENERIC", "SIMPLE_GENERIC_C"),
]


def med_links(src: SourceCatalog, hierarchy: DataFrame) -> DataFrame:
    """P11: every id of the hierarchy linked to RxNorm, NDC and the four classes."""
    ids = unpivot_ids(hierarchy, ["medID", "proxyMedID", "componentMedID", "productionMedID"])
    rx = ids.join(src.table("RXNORM_CODES").select(
        "MEDICATION_ID", "RXNORM_CODE", "RXNORM_CODE_LEVEL_C", "RXNORM_TERM_TYPE_C"),
        "MEDICATION_ID", "inner")
    rx = lookup(rx, src.table("ZC_RXNORM_CODE_LEVEL"), "RXNORM_CODE_LEVEL_C", {"NAME": "__lvl"})
    rx = lookup(rx, src.table("ZC_RXNORM_TERM_TYPE"), "RXNORM_TERM_TYPE_C", {"NAME": "__tt"})
    ndc = (ids.join(src.table("CLARITY_NDC_CODES").select("MEDICATION_ID", "NDC_CODE", "LINE"),
                    "MEDICATION_ID", "inner")
           .join(src.table("RX_NDC").select("NDC_CODE", "RAW_NDC_CODE"), "NDC_CODE", "inner"))
    master = src.table("CLARITY_MEDICATION")
    branches = [
        link_rows(rx, "RXNORM", med="MEDICATION_ID", code=F.col("RXNORM_CODE"),
                  level=F.col("__lvl"), term_type=F.col("__tt")),
        link_rows(ndc, "NDC", med="MEDICATION_ID", line=F.col("LINE"),
                  code=F.col("RAW_NDC_CODE"), name=F.col("NDC_CODE")),
        class_links_shared(ids, master, [(nom, col, src.table(cat), key)
                                         for nom, col, cat, key in CLASS_LINKS]),
    ]
    return link_codes(branches)


def unique_meds(src: SourceCatalog, meds: DataFrame) -> DataFrame:
    ids = meds.select("medID").distinct()
    return lookup(ids, src.table("CLARITY_MEDICATION"), {"medID": "MEDICATION_ID"},
                  {"NAME": "CLARITY_NAME"}).select(F.col("medID").alias("ORIG_MED_ID"),
                                                   "CLARITY_NAME")


def med_link_matches(src: SourceCatalog, meds: DataFrame, hierarchy: DataFrame,
                     links: DataFrame) -> DataFrame:
    """P12: RxNorm matches of principal ids, directly or through a related id."""
    return coverage_waterfall(unique_meds(src, meds), hierarchy, links)


def unmatched_meds(src: SourceCatalog, meds: DataFrame, matches: DataFrame) -> DataFrame:
    """P12: principal ids (with names) that no match row covers; NULL id included."""
    ids = unmatched_ids(meds, matches)
    return lookup(ids, src.table("CLARITY_MEDICATION"), {"medID": "MEDICATION_ID"},
                  {"NAME": "CLARITY_NAME"}).select("medID", "CLARITY_NAME").distinct()


def med_coverage_summary(meds: DataFrame, matches: DataFrame) -> DataFrame:
    """P13: four (DESCRIP, CNT) rows."""
    return coverage_summary(meds, matches)


def medication_chain(src: SourceCatalog, cohort: DataFrame, orders: DataFrame | None = None
                     ) -> dict[str, DataFrame]:
    """Run P9-P13, materialising the administrations (read by four consumers) and
    the catalog-sized hierarchy, links and matches."""
    meds = materialize(medications(src, cohort, orders), "meds")
    hierarchy = materialize(med_hierarchy(src, meds), "med_hierarchy")
    links = materialize(med_links(src, hierarchy), "med_links")
    matches = materialize(med_link_matches(src, meds, hierarchy, links), "med_matches")
    return {
        "medications": meds.distinct(),
        "med_hierarchy": hierarchy.orderBy("medID", "proxyMedID", "productionMedID",
                                           "componentMedID"),
        "med_links": links.orderBy("nomenclature", "medID", "line"),
        "med_link_matches": matches,
        "unmatched_meds": unmatched_meds(src, meds, matches),
        "med_coverage_summary": med_coverage_summary(meds, matches),
    }
