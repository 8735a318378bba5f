"""P14-P16 on the clinical fixture."""

import pytest

from stayflow.plans.departments import (
    all_departments, network_departments, search_departments)
from tests.clinical_fixtures import CFG, catalog


@pytest.fixture(scope="module")
def src(spark):
    return catalog(spark)


def test_all_departments(src):
    df = all_departments(src)
    assert df.columns[:3] == ["DEPARTMENT_ID", "DEPARTMENT_NAME", "LOC_NAME"]
    assert len(df.columns) == len(set(df.columns))           # Q21: each column once
    assert [r.DEPARTMENT_ID for r in df.collect()] == [100, 200, 500]


def test_search_precedence(src):
    loose = {r.DEPARTMENT_ID for r in search_departments(src, CFG.department_patterns).collect()}
    strict = {r.DEPARTMENT_ID for r in
              search_departments(src, CFG.department_patterns, strict=True).collect()}
    assert loose == {100, 500, 600}                            # Q14: last pattern skips status
    assert strict == {100, 500}


def test_network(src):
    rows = network_departments(src, CFG.network_departments).collect()
    assert [(r.DEPARTMENT_ID, r.UNIQUE_PATIENTS) for r in rows][:2] == [(100, 7), (500, 2)]
    by = {r.DEPARTMENT_ID: r for r in rows}
    assert set(by) == {100, 500, 900, 200}
    assert (by[200].LICENSED_BEDS, by[200].IS_PERIOP_DEP_YN) == ("0", "N")
    assert (by[900].UNIT_TYPE, by[900].IS_PERIOP_DEP_YN, by[900].LOC_NAME) == (None, "Y",
                                                                               "SURGERY")
