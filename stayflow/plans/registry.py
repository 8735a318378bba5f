"""All registered driver-table queries and their DuckDB oracle SQL."""

from __future__ import annotations

from stayflow.plans import (
    testdata, testdata_clinical, testdata_common, testdata_departments, testdata_meds,
    testdata_orders, testdata_sinks)

QUERIES: dict = {}
ORACLE: dict = {}
for _mod in (testdata, testdata_orders, testdata_meds, testdata_departments,
             testdata_clinical, testdata_sinks):
    QUERIES.update(_mod.QUERIES)
    ORACLE.update(_mod.ORACLE)


def build_shared(spark, d: str) -> None:
    """The inputs that several queries read: the published cohort, the medication chain."""
    testdata_clinical.cohort(spark, d)
    testdata_meds.chain(spark, d)


def clear_shared() -> None:
    """Forget them (and the tables read): the next query builds its inputs anew."""
    for cache in (testdata_clinical._COHORTS, testdata_clinical._CATALOGS, testdata_meds._CHAINS,
                  testdata_meds._DERIVED_CACHE, testdata_common._READS):
        cache.clear()
