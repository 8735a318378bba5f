"""P8-P13 on the clinical fixture."""

import pytest

from stayflow.plans.cohort import all_encounters
from stayflow.plans.medications import (
    med_coverage_summary, med_hierarchy, med_link_matches, med_links, medication_chain,
    medications, medications_v1, rxnorm_pick, unmatched_meds)
from stayflow.sources.sinks import materialize
from tests.clinical_fixtures import CFG, catalog


@pytest.fixture(scope="module")
def src(spark):
    return catalog(spark)


@pytest.fixture(scope="module")
def meds(src):
    cohort = all_encounters(src, CFG)
    return materialize(medications(src, cohort), "test-meds")


def test_medications_raw_and_distinct(meds):
    assert meds.count() == 5                 # duplicate administration kept (Q20)
    assert meds.distinct().count() == 4
    assert len(meds.columns) == 21
    r = {x.orderMedID: x for x in meds.collect()}
    assert r[5].medID is None                # no dispensable medication
    assert (r[1].medID, r[1].route, r[1].routeCode, r[1].marAction) == (10, "IV", "202", "Given")
    assert (r[1].quantityUnits, r[1].rateUnits, r[1].durationUnit) == ("mg", "mL/hr", "Minutes")


def test_rxnorm_pick(src):
    got = {r.MEDICATION_ID: r.rxnormcode for r in rxnorm_pick(src).collect()}
    # type '3' beats '1'; the level-2 row of type '3' re-enters after the join-back
    assert got == {10: "9999999", 21: "161", 40: None}


def test_medications_v1(src):
    cohort = all_encounters(src, CFG)
    rows = medications_v1(src, cohort).collect()
    assert len(rows) == 5 and len(rows[0]) == 29
    by = {r.ORDER_MED_ID: r for r in rows}
    assert (by[1].code, by[1].nomenclature) == ("9999999", "RXNORM CODE")
    assert (by[2].code, by[2].nomenclature) == ("20", "MEDICATION ID")
    assert (by[1].MED_NAME, by[1].THERA_CLASS, by[1].SIMPLE_GENERIC) == ("MORPHINE",
                                                                        "Analgesic", "Morphine")
    assert by[1].PAT_ID == "P2" and by[1].MED_ADMIN_DEPT_NAME == "PICU NORTH"


@pytest.fixture(scope="module")
def chain(src, meds):
    h = materialize(med_hierarchy(src, meds), "test-hier")
    lk = materialize(med_links(src, h), "test-links")
    m = materialize(med_link_matches(src, meds, h, lk), "test-matches")
    return h, lk, m


def test_hierarchy(chain):
    h = {tuple(r) for r in chain[0].collect()}
    assert h == {
        (10, None, None, None, None, None), (20, None, None, None, None, None),
        (30, None, None, None, None, None), (None, None, None, None, None, None),
        (20, 21, None, None, 1, None), (30, None, 31, None, 1, "Base"),
        (30, None, None, 33, 1, None), (30, None, 34, 33, 2, None),
        (30, 32, 31, None, 1, "Base"), (20, 22, None, None, 1, None)}


def test_links(chain):
    lk = chain[1].collect()
    assert len(lk) == 11
    by_nom = {}
    for r in lk:
        by_nom.setdefault(r.nomenclature, set()).add((r.medID, r.code))
    assert by_nom["NDC"] == {(10, "00409189001")}
    assert by_nom["THERA_CLASS"] == {(10, "501"), (20, "501")}
    assert by_nom["SIMPLE GENERIC"] == {(10, "801")}          # Q18: blank, not underscore
    assert by_nom["RXNORM"] == {(10, "7052"), (10, "1730193"), (10, "9999999"), (10, "1111"),
                                (21, "161")}


def test_matches_and_summary(src, meds, chain):
    m = chain[2].collect()
    assert sorted((r.ORIG_MED_ID, r.proxyMedID, r.code) for r in m) == [
        (10, None, "1111"), (10, None, "1730193"), (10, None, "7052"), (10, None, "9999999"),
        (20, 21, "161")]
    un = {(r.medID, r.CLARITY_NAME) for r in unmatched_meds(src, meds, chain[2]).collect()}
    assert un == {(30, "MIXTURE"), (None, None)}
    summary = {r.DESCRIP: r.CNT for r in med_coverage_summary(meds, chain[2]).collect()}
    assert summary == {"All Unique Principle Med IDs": 4,
                       "Unique Unmatched Principle Med IDs": 2,
                       "All Med Admins": 5, "Unmatched Med Admins": 1}     # Q19


def test_chain_materialises(src):
    cohort = all_encounters(src, CFG)
    out = medication_chain(src, cohort)
    assert out["medications"].count() == 4
    assert out["med_links"].count() == 11
    assert {r.DESCRIP: r.CNT for r in out["med_coverage_summary"].collect()}[
        "Unmatched Med Admins"] == 1


def _moved(df) -> int:
    """Rows that the shuffles of ``df`` (already run) have written."""
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        if kind == "ShuffleExchangeExec":
            total += node.metrics().apply("shuffleRecordsWritten").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return total


@pytest.mark.parametrize("extract", [medications, medications_v1])
def test_administrations_of_other_orders_are_not_moved(spark, src, extract):
    cohort = materialize(all_encounters(src, CFG), "test-cohort")
    want = sorted(map(str, extract(src, cohort).collect()))
    mar = src.table("MAR_ADMIN_INFO")
    others = spark.range(100, 5100).join(mar.limit(1).drop("ORDER_MED_ID")).withColumnRenamed(
        "id", "ORDER_MED_ID").select(mar.columns)
    many = catalog(spark).register("MAR_ADMIN_INFO", mar.unionAll(others))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")    # no key set is small enough
    try:
        got = extract(many, cohort)
        assert sorted(map(str, got.collect())) == want
        assert _moved(got) < 1000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_repeated_dimension_rows_repeat_administrations(spark, src):
    cohort = materialize(all_encounters(src, CFG), "test-cohort")
    want = sorted(map(str, medications_v1(src, cohort).collect()))
    for name in ("ORDER_MEDINFO", "PAT_ENC", "PATIENT", "ORDER_MED"):
        table = src.table(name)
        doubled = catalog(spark).register(name, table.unionAll(table))
        rows = sorted(map(str, medications_v1(doubled, cohort).collect()))
        assert set(rows) == set(want) and len(rows) >= len(want)
        if name == "ORDER_MED":
            assert rows == sorted(want * 2)
