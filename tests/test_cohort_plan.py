"""P1 all_encounters and the extracts that read only the cohort (P2, P3)."""

from datetime import datetime as dt
from decimal import Decimal

import pytest

from stayflow.plans.cohort import COHORT_COLUMNS, all_encounters
from stayflow.plans.extracts import hospital, icu
from tests.clinical_fixtures import CFG, catalog


@pytest.fixture(scope="module")
def src(spark):
    return catalog(spark)


@pytest.fixture(scope="module")
def cohort(src):
    return all_encounters(src, CFG).cache()


def test_columns(cohort):
    assert cohort.columns == COHORT_COLUMNS


def test_stays(cohort):
    got = sorted((r.PAT_ENC_CSN_ID, r.DEPT_GRP, r.ICU_IN_DT, r.ICU_OUT_DT, r.ICU_LOS_HRS)
                 for r in cohort.collect())
    assert got == [
        (1001, "PICU", dt(2020, 3, 1, 9), dt(2020, 3, 1, 15), Decimal("6.000000")),
        (1002, "PICU", dt(2020, 4, 1, 8), dt(2020, 4, 1, 18), Decimal("10.000000")),
        (1003, "CICU", dt(2020, 5, 1, 12), dt(2020, 5, 1, 18), Decimal("6.000000")),
        (1003, "PICU", dt(2020, 5, 1, 8), dt(2020, 5, 1, 10), Decimal("2.000000")),
        (1005, "PICU", dt(2020, 5, 3, 9), dt(2020, 5, 3, 18), Decimal("9.000000")),
        (1008, "PICU", dt(2020, 6, 1, 8), dt(2020, 6, 2, 8), Decimal("24.000000")),
    ]


def test_descriptive_columns(cohort):
    r = {x.PAT_ENC_CSN_ID: x for x in cohort.collect() if x.DEPT_GRP == "PICU"}
    a = r[1001]
    assert (a.HOSP_ADMIT_DT, a.HOSP_DC_DT) == (dt(2020, 3, 1, 8), dt(2020, 3, 1, 20))
    assert (a.DEPARTMENT_NAME, a.FIRST_ROOM_NAME, a.EVENT_TYPE) == ("PICU NORTH", "PICU-1",
                                                                      "Transfer In")
    assert (a.PAT_MRN_ID, a.SEX, a.DISCH_DISP, a.IN_YEAR) == ("MRN0", "Male", "Home", 2020)
    assert r[1005].DISCH_DISP is None and r[1005].DISCH_DISP_C is None


def test_hospital(src, cohort):
    h = {r.hid: r for r in hospital(src, cohort).collect()}
    assert set(h) == {1001, 1002, 1003, 1005, 1008}
    assert h[1003].hospitalMortality == "1"          # Q9: earlier stay ended before discharge
    assert h[1008].hospitalMortality == "0"          # died in the unit
    assert h[1003].RACE == "Black|White"             # ordered by name
    assert h[1003].ETHNICITY == "Not Hispanic"
    assert h[1001].RACE is None
    assert h[1002].ageAtAdmission_Anonymized == 1752  # days 2015-06-15 -> 2020-04-01
    assert h[1002].hospitalDischarge_Anonymized == 10 * 3600
    assert h[1002].yearOfAdmission == 2020


def test_icu(cohort):
    rows = {(r.hid, r.icu): r for r in icu(cohort).collect()}
    assert rows[(1008, "PICU")].icuMortality == "1"
    assert rows[(1003, "CICU")].icuMortality == "1"
    assert rows[(1003, "PICU")].icuMortality == "0"
    assert rows[(1001, "PICU")].icuAdmission_Anonymized == 3600
    assert rows[(1001, "PICU")].icuDischarge_Anonymized == 7 * 3600


def test_case_insensitive_category_names(spark):
    from stayflow.sources.catalog import SourceCatalog
    base = catalog(spark)
    upper = {name: base.table(name) for name in base._tables}
    upper["ZC_EVENT_TYPE"] = spark.createDataFrame(
        [("1", "ADMISSION"), ("2", "DISCHARGE"), ("3", "TRANSFER IN  "), ("4", "transfer out")],
        "EVENT_TYPE_C string, NAME string")
    upper["ZC_EVENT_SUBTYPE"] = spark.createDataFrame([("1", "Original"), ("2", "CANCELED")],
                                                      "EVENT_SUBTYPE_C string, NAME string")
    binary = SourceCatalog(spark, tables=upper)
    assert all_encounters(binary, CFG).count() == 0          # binary compare: no match
    lcase = SourceCatalog(spark, tables=upper, category_collation="UTF8_LCASE_RTRIM")
    got = sorted((r.PAT_ENC_CSN_ID, r.DEPT_GRP) for r in all_encounters(lcase, CFG).collect())
    assert got == [(1001, "PICU"), (1002, "PICU"), (1003, "CICU"), (1003, "PICU"),
                   (1005, "PICU"), (1008, "PICU")]


def test_lookup_key_check(spark):
    import dataclasses

    import pytest as _pytest
    from stayflow.sources.catalog import SourceCatalog
    base = catalog(spark)
    tables = {name: base.table(name) for name in base._tables}
    cfg = dataclasses.replace(CFG, check_lookup_keys=True)
    assert all_encounters(SourceCatalog(spark, tables=tables), cfg).count() == 6
    tables["ZC_SEX"] = tables["ZC_SEX"].unionByName(tables["ZC_SEX"])
    with _pytest.raises(ValueError, match="ZC_SEX"):
        all_encounters(SourceCatalog(spark, tables=tables), cfg)
