"""Department helpers on the driver tables: supplier = department, nation =
location (its region decides the record status), lineitem = ADT events
(encounter = order, department = supplier, time = ship date)."""

from __future__ import annotations

from stayflow.plans.departments import (
    all_departments, network_departments, search_departments)
from stayflow.plans.testdata_common import _read
from stayflow.sources.catalog import SourceCatalog

SEARCH_PATTERNS = ("%1%", "%7%")
NETWORK_SEEDS = ("Supplier#000000001", "Supplier#000000007")
NETWORK_TYPES = ("1", "2", "3", "4", "6")

DERIVED = {
    "CLARITY_DEP": """
SELECT s_suppkey AS DEPARTMENT_ID, s_name AS DEPARTMENT_NAME, s_nationkey AS REV_LOC_ID,
  CASE WHEN s_acctbal < 0 THEN NULL WHEN s_acctbal < 3000 THEN '1'
       WHEN s_acctbal < 6000 THEN '2' ELSE '9' END AS ADT_UNIT_TYPE_C,
  CASE WHEN s_acctbal < 1000 THEN NULL WHEN s_acctbal < 5000 THEN '0'
       WHEN s_acctbal < 7000 THEN '12' ELSE '24' END AS LICENSED_BEDS,
  CASE WHEN s_acctbal > 8000 THEN 'Y' WHEN s_acctbal > 4000 THEN NULL ELSE 'N' END
    AS IS_PERIOP_DEP_YN
FROM {supplier}""",
    "CLARITY_LOC": """
SELECT n_nationkey AS LOC_ID, n_name AS LOC_NAME,
  CASE WHEN n_regionkey = 0 THEN NULL WHEN n_regionkey = 1 THEN '0' ELSE '1' END
    AS RECORD_STATUS
FROM {nation}""",
    "ZC_ADT_UNIT_TYPE": """
SELECT * FROM (VALUES ('1', 'ICU'), ('2', 'WARD')) AS t(ADT_UNIT_TYPE_C, NAME)""",
    "CLARITY_ADT": """
SELECT l_orderkey AS PAT_ENC_CSN_ID, l_suppkey AS DEPARTMENT_ID, l_shipdate AS EFFECTIVE_TIME,
  CASE WHEN l_returnflag = 'R' THEN '1' WHEN l_returnflag = 'A' THEN '3' ELSE '5' END
    AS EVENT_TYPE_C
FROM {lineitem}""",
}

_CATALOGS: dict = {}


def catalog(spark, d: str) -> SourceCatalog:
    key = (id(spark), d)
    if key not in _CATALOGS:
        tables = {}
        for name, sql in DERIVED.items():
            used = {t: _read(spark, d, t) for t in ("supplier", "nation", "lineitem")
                    if "{" + t + "}" in sql}
            tables[name] = spark.sql(sql, **used)
        _CATALOGS[key] = SourceCatalog(spark, tables=tables)
    return _CATALOGS[key]


def q_department_list(spark, d):
    return all_departments(catalog(spark, d))


def q_department_search(spark, d):
    return search_departments(catalog(spark, d), SEARCH_PATTERNS)


def q_department_network(spark, d):
    return network_departments(catalog(spark, d), NETWORK_SEEDS, NETWORK_TYPES)


QUERIES = {
    "department_list": q_department_list,
    "department_search": q_department_search,
    "department_network": q_department_network,
}

_WITH = "WITH " + ",\n".join(
    f"{n} AS ({s.format(supplier='supplier', nation='nation', lineitem='lineitem')})"
    for n, s in DERIVED.items())
_SEEDS = ", ".join(f"'{s}'" for s in NETWORK_SEEDS)
_TYPES = ", ".join(f"'{t}'" for t in NETWORK_TYPES)

ORACLE = {
    "department_list": _WITH + """
SELECT d.DEPARTMENT_ID, d.DEPARTMENT_NAME, l.LOC_NAME, d.REV_LOC_ID, d.ADT_UNIT_TYPE_C,
       d.LICENSED_BEDS, d.IS_PERIOP_DEP_YN
FROM CLARITY_DEP d JOIN CLARITY_LOC l ON l.LOC_ID = d.REV_LOC_ID
WHERE l.RECORD_STATUS IS NULL OR l.RECORD_STATUS = '1'
ORDER BY d.REV_LOC_ID, d.DEPARTMENT_ID""",
    "department_search": _WITH + f"""
SELECT d.DEPARTMENT_ID, d.DEPARTMENT_NAME, l.LOC_NAME, d.REV_LOC_ID, d.ADT_UNIT_TYPE_C,
       d.LICENSED_BEDS, d.IS_PERIOP_DEP_YN
FROM CLARITY_DEP d JOIN CLARITY_LOC l ON l.LOC_ID = d.REV_LOC_ID
WHERE (l.RECORD_STATUS IS NULL OR l.RECORD_STATUS = '1')
  AND d.DEPARTMENT_NAME LIKE '{SEARCH_PATTERNS[0]}'
   OR d.DEPARTMENT_NAME LIKE '{SEARCH_PATTERNS[1]}'""",
    "department_network": _WITH + f"""
SELECT DISTINCT d.DEPARTMENT_NAME, a.DEPARTMENT_ID, min(a.EFFECTIVE_TIME) AS FIRST_ADT_DATE,
  max(a.EFFECTIVE_TIME) AS LAST_ADT_DATE, d.LOC_NAME, d.UNIT_TYPE,
  COALESCE(d.LICENSED_BEDS, '0') AS LICENSED_BEDS,
  COALESCE(d.IS_PERIOP_DEP_YN, 'N') AS IS_PERIOP_DEP_YN,
  count(DISTINCT a.PAT_ENC_CSN_ID) AS UNIQUE_PATIENTS
FROM CLARITY_ADT a
LEFT JOIN (SELECT dp.*, lc.LOC_NAME, u.NAME AS UNIT_TYPE FROM CLARITY_DEP dp
           JOIN CLARITY_LOC lc ON lc.LOC_ID = dp.REV_LOC_ID
           LEFT JOIN ZC_ADT_UNIT_TYPE u ON u.ADT_UNIT_TYPE_C = dp.ADT_UNIT_TYPE_C) d
  ON a.DEPARTMENT_ID = d.DEPARTMENT_ID
WHERE a.PAT_ENC_CSN_ID IN (
  SELECT DISTINCT x.PAT_ENC_CSN_ID FROM CLARITY_ADT x
  LEFT JOIN CLARITY_DEP y ON x.DEPARTMENT_ID = y.DEPARTMENT_ID
  WHERE x.EVENT_TYPE_C IN ({_TYPES}) AND y.DEPARTMENT_NAME IN ({_SEEDS})
    AND x.PAT_ENC_CSN_ID IS NOT NULL)
GROUP BY d.DEPARTMENT_NAME, a.DEPARTMENT_ID, d.LOC_NAME, d.UNIT_TYPE, d.IS_PERIOP_DEP_YN,
         d.LICENSED_BEDS
ORDER BY UNIQUE_PATIENTS DESC""",
}
