"""Joins, key-set filters, unit windows, aggregation and unions on orders/lineitem."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.expr import boundary_diff, day_diff, flag, min_text, ntz, typed_null, year_of
from stayflow.operators.joins import (
    classify, exclude, lookup, restrict_to, within_unit_window)
from stayflow.operators.merge import listagg_sorted, tagged_rows
from stayflow.plans.testdata_common import (
    ORDER_UNITS, ORDER_WINDOW, SEGMENT_UNITS, _read, _ts, _units_sql)
from stayflow.sources.config import units_frame


def _t(spark, d, name, *cols) -> DataFrame:
    df = _read(spark, d, name)
    return df.select(*cols) if cols else df


# -- unit windows and classification (E3, E4) --------------------------------

def seed_orders(spark, d) -> DataFrame:
    o = _t(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority",
           "o_orderstatus")
    s = within_unit_window(o, units_frame(spark, ORDER_UNITS), "o_orderpriority", "o_orderdate")
    lo, hi = ORDER_WINDOW
    s = s.filter((F.col("o_orderstatus") == "O") & (F.col("o_orderdate") > ntz(lo))
                 & (F.col("o_orderdate") < ntz(hi)))
    return s.select("o_orderkey", "o_custkey", "o_orderdate", "dpt_grp")


SEED_SQL = f"""seed AS (
  SELECT o.o_orderkey, o.o_custkey, o.o_orderdate, u.dpt_grp
  FROM orders o JOIN {_units_sql(ORDER_UNITS)} u
    ON o.o_orderpriority = u.dpt_id AND u.dpt_grp <> 'PERIOP'
   AND o.o_orderdate > CAST(u.opendate AS TIMESTAMP) AND o.o_orderdate < CAST(u.closedate AS TIMESTAMP)
  WHERE o.o_orderstatus = 'O' AND o.o_orderdate > {_ts(ORDER_WINDOW[0])}
    AND o.o_orderdate < {_ts(ORDER_WINDOW[1])})"""


def q_unit_window_seed(spark, d):
    return seed_orders(spark, d)


def q_unit_classify(spark, d):
    c = _t(spark, d, "customer", "c_custkey", "c_mktsegment")
    return classify(c, units_frame(spark, SEGMENT_UNITS), "c_mktsegment").select(
        "c_custkey", "c_mktsegment", "DEPT_GRP")


# -- lookups (E1, E14, E12) --------------------------------------------------

def q_lookup_chain(spark, d):
    x = _t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey")
    x = lookup(x, _read(spark, d, "orders"), {"l_orderkey": "o_orderkey"},
               {"o_orderdate": "o_orderdate", "o_custkey": "o_custkey"})
    x = lookup(x, _read(spark, d, "customer"), {"o_custkey": "c_custkey"},
               {"c_name": "c_name", "c_nationkey": "c_nationkey"})
    x = lookup(x, _read(spark, d, "nation"), {"c_nationkey": "n_nationkey"},
               {"n_name": "cust_nation", "n_regionkey": "n_regionkey"})
    x = lookup(x, _read(spark, d, "region"), {"n_regionkey": "r_regionkey"},
               {"r_name": "cust_region"})
    return x.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderdate", "c_name",
                    "cust_nation", "cust_region")


def q_role_playing_lookup(spark, d):
    nation = _read(spark, d, "nation")
    x = _t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey")
    x = lookup(x, _read(spark, d, "supplier"), {"l_suppkey": "s_suppkey"},
               {"s_nationkey": "s_nationkey"})
    x = lookup(x, nation, {"s_nationkey": "n_nationkey"}, {"n_name": "supp_nation"})
    x = lookup(x, _read(spark, d, "orders"), {"l_orderkey": "o_orderkey"},
               {"o_custkey": "o_custkey"})
    x = lookup(x, _read(spark, d, "customer"), {"o_custkey": "c_custkey"},
               {"c_nationkey": "c_nationkey"})
    x = lookup(x, nation, {"c_nationkey": "n_nationkey"}, {"n_name": "cust_nation"})
    return x.select("l_orderkey", "l_linenumber", "l_suppkey", "supp_nation", "cust_nation")


def q_nested_left_tree(spark, d):
    c = _t(spark, d, "customer", "c_custkey", "c_name", "c_nationkey")
    n = _t(spark, d, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = _t(spark, d, "region", "r_regionkey", "r_name")
    right = c.join(n, c.c_nationkey == n.n_nationkey, "inner") \
             .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
    o = _t(spark, d, "orders", "o_orderkey", "o_custkey")
    return o.join(right, o.o_custkey == right.c_custkey, "left").select(
        "o_orderkey", "o_custkey", "c_name", "n_name", "r_name")


# -- key-set restriction (E6, E7, E13), exclusion (E8), filtered right (E9) ---

def q_cohort_semi(spark, d):
    li = _t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_quantity",
            "l_shipdate")
    return restrict_to(li, seed_orders(spark, d), {"l_orderkey": "o_orderkey"})


def q_cohort_semi_nested(spark, d):
    regions = _read(spark, d, "region").filter(F.col("r_name") == "ASIA")
    nations = restrict_to(_read(spark, d, "nation"), regions, {"n_regionkey": "r_regionkey"})
    custs = restrict_to(_read(spark, d, "customer"), nations, {"c_nationkey": "n_nationkey"})
    ords = restrict_to(_read(spark, d, "orders"), custs, {"o_custkey": "c_custkey"})
    li = _t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return restrict_to(li, ords, {"l_orderkey": "o_orderkey"})


def q_anti_unmatched(spark, d):
    big_returns = _read(spark, d, "lineitem").filter(
        (F.col("l_returnflag") == "R") & (F.col("l_quantity") >= 45))
    return exclude(_t(spark, d, "part", "p_partkey", "p_name"), big_returns,
                   {"p_partkey": "l_partkey"})


def q_left_join_filtered_right(spark, d):
    o = _t(spark, d, "orders", "o_orderkey", "o_orderstatus")
    returns = _read(spark, d, "lineitem").filter(F.col("l_returnflag") == "R")
    x = lookup(o, returns, {"o_orderkey": "l_orderkey"},
               {"l_linenumber": "l_linenumber", "l_quantity": "l_quantity"})
    return x.select("o_orderkey", "o_orderstatus", "l_linenumber", "l_quantity")


# -- aggregation (F1, F6-F9, F11, J6, J8, E16) --------------------------------

def priorities_per_customer(spark, d) -> DataFrame:
    """Per customer, the ordered '|' list of the distinct priorities of its orders."""
    p = _t(spark, d, "orders", "o_custkey", "o_orderpriority").distinct()
    return p.groupBy("o_custkey").agg(listagg_sorted("o_orderpriority", "|").alias("PRIORITIES"))


def q_listagg_names(spark, d):
    c = _t(spark, d, "customer", "c_custkey", "c_name")
    return lookup(c, priorities_per_customer(spark, d), {"c_custkey": "o_custkey"},
                  {"PRIORITIES": "PRIORITIES"}).select("c_custkey", "c_name", "PRIORITIES")


def q_hospital_style_rollup(spark, d):
    li = _t(spark, d, "lineitem", "l_orderkey", "l_shipdate", "l_returnflag")
    o = _t(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    x = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    rf, ship, od = F.col("l_returnflag"), F.col("l_shipdate"), F.col("o_orderdate")
    g = x.groupBy("o_custkey", "o_orderkey").agg(
        F.min(od).alias("BIRTH_DATE"),
        F.min(ship).alias("FIRST_SHIP"),
        F.min(day_diff(od, ship)).alias("shipAge_Anonymized"),
        F.max(ship).alias("LAST_SHIP"),
        F.min(boundary_diff("SECOND", od, ship)).alias("shipSpan_Anonymized"),
        F.max(flag((rf == "R") & (ship < od))).alias("returnedEarly"),
        F.min(year_of(od)).alias("yearOfOrder"))
    # Per-customer attributes are joined after the aggregate (one row per order
    # instead of per line); MIN over a per-customer constant is that constant.
    g = lookup(g, _read(spark, d, "customer"), {"o_custkey": "c_custkey"},
               {"c_mktsegment": "segment"})
    g = lookup(g, priorities_per_customer(spark, d), "o_custkey", {"PRIORITIES": "PRIORITIES"})
    return g.select(F.col("o_custkey").alias("pid"), F.col("o_orderkey").alias("hid"), "segment",
                    "BIRTH_DATE", "FIRST_SHIP", "shipAge_Anonymized", "LAST_SHIP",
                    "shipSpan_Anonymized", "PRIORITIES", "returnedEarly", "yearOfOrder")


def q_distinct_rows(spark, d):
    return _t(spark, d, "orders", "o_custkey", "o_orderstatus", "o_orderpriority").distinct()


def q_collated_min(spark, d):
    """Minimum in linguistic order over names in mixed case, some with accents."""
    p = _t(spark, d, "part", "p_partkey", "p_brand", "p_name")
    kind, name = F.col("p_partkey") % 3, F.col("p_name")
    mixed = F.when(kind == 0, F.upper(name)).when(kind == 1, F.replace(name, F.lit("a"), F.lit("á"))).otherwise(name)
    return p.groupBy("p_brand").agg(
        min_text(mixed, "UNICODE").alias("min_name"), min_text(mixed, "UTF8_BINARY").alias("min_binary"),
        F.count(F.lit(1)).alias("n_parts"))


# -- provenance union + group (I1, F2, F10, D4, D5, J2) and code coalesce (J1, J3)

def q_tagged_union_min(spark, d):
    seed = seed_orders(spark, d)
    li = _t(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_shipdate",
            "l_returnflag", "l_linestatus")
    o = _t(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    lo = li.join(o, li.l_orderkey == o.o_orderkey, "inner")
    lo = restrict_to(lo, seed, "o_custkey")
    ship, od, part, returned = (F.col(c) for c in ("l_shipdate", "o_orderdate", "l_partkey",
                                                   "l_returnflag"))
    not_n, never = F.nullif(returned, F.lit("N")), typed_null("timestamp_ntz")

    def branch(start, end, dx, primary):
        return {"START_DT": start, "END_DT": end, "DX_ID": dx, "PRIMARY_YN": primary}

    # one pass over the joined lines: each makes its rows of all four sources
    diags = tagged_rows(lo.withColumn("CSN", F.col("o_custkey")), {
        "SHIP": branch(ship, ship, part, F.nullif(F.col("l_linestatus"), F.lit("O"))),
        "ORDER": branch(od, ship, part, not_n),
        "SUPPLY": branch(od, never, F.col("l_suppkey"), typed_null("string")),
        "RETURN": branch(ship, ship, part, not_n),
    }, where={"RETURN": returned == "R"}, keep=["CSN"])
    diags = lookup(diags, _read(spark, d, "part"), {"DX_ID": "p_partkey"},
                   {"p_name": "DX_NAME", "p_brand": "CURRENT_ICD10_LIST"})
    diags = diags.filter(F.col("DX_ID").isNotNull()).distinct()
    # Each customer has several seed rows. Every aggregate over that fan-out is a MIN,
    # and day differences fall as the birth date rises, so one row per customer with
    # (min id, min birth, max birth) gives the same result without the fan-out.
    enc = seed.groupBy(F.col("o_custkey").alias("CSN")).agg(
        F.min("o_orderkey").alias("PAT_ID"), F.min("o_orderdate").alias("BIRTH_DATE"),
        F.max("o_orderdate").alias("__last_birth"))
    j = diags.join(enc, "CSN", "inner")
    last_birth, start, end = F.col("__last_birth"), F.col("START_DT"), F.col("END_DT")
    g = j.groupBy("CSN", "DX_ID", "START_DT", "END_DT").agg(
        F.min("PAT_ID").alias("pid"),
        F.min("BIRTH_DATE").alias("BIRTH_DATE"),
        F.min(day_diff(last_birth, start)).alias("recorded_Anonymized"),
        F.min("CURRENT_ICD10_LIST").alias("code"),
        F.min("DX_NAME").alias("codeText"),
        F.min("SOURCE").alias("source"),
        F.min(start).alias("onset"),
        F.min(end).alias("abatement"),
        F.min(day_diff(last_birth, end)).alias("abatement_Anonymized"),
        F.min("PRIMARY_YN").alias("isPrimary"))
    return g.select(
        "pid", F.col("CSN").alias("hid"), "BIRTH_DATE", F.col("START_DT").alias("recorded"),
        "recorded_Anonymized", F.lit("ICD10").alias("nomenclature"), "code", "codeText",
        "source", "onset", F.col("recorded_Anonymized").alias("onset_Anonymized"), "abatement",
        "abatement_Anonymized",
        F.when(F.col("END_DT").isNotNull(), F.lit("1")).otherwise(F.lit("0"))
        .alias("abatementBoolean"), "isPrimary")


def q_code_coalesce(spark, d):
    li = _t(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
            "l_shipdate", "l_returnflag")
    li = restrict_to(li, seed_orders(spark, d), {"l_orderkey": "o_orderkey"})
    comp = _read(spark, d, "part").select(
        F.col("p_partkey").alias("COMPONENT_ID"), F.col("p_name").alias("NAME"),
        F.when(F.col("p_size") <= 10, F.col("p_brand")).alias("LOINC_CODE"),
        F.col("p_type").alias("DFLT_UNITS"))
    lnc = _read(spark, d, "supplier").filter(F.col("s_acctbal") > 5000).select(
        F.col("s_suppkey").alias("RECORD_ID"),
        F.concat(F.lit("LNC-"), F.col("s_suppkey").cast("string")).alias("LNC_CODE"),
        F.col("s_name").alias("LNC_FULL_NAM"))
    x = lookup(li, comp, {"l_partkey": "COMPONENT_ID"},
               {"COMPONENT_ID": "COMPONENT_ID", "NAME": "COMP_NAME", "LOINC_CODE": "LOINC_CODE",
                "DFLT_UNITS": "DFLT_UNITS"})
    x = lookup(x, lnc, {"l_suppkey": "RECORD_ID"},
               {"LNC_CODE": "LNC_CODE", "LNC_FULL_NAM": "LNC_FULL_NAM"})
    x = lookup(x, _read(spark, d, "orders"), {"l_orderkey": "o_orderkey"},
               {"o_orderdate": "HOSP_ADMIT_DT"})
    lnc_code, comp_code = F.col("LNC_CODE"), F.col("LOINC_CODE")
    return x.select(
        F.col("l_orderkey").alias("hid"), F.col("l_linenumber").alias("line"),
        F.when(lnc_code.isNotNull(), F.lit("LONIC CODE"))
        .when(comp_code.isNotNull(), F.lit("LONIC CODE"))
        .otherwise(F.lit("COMPONENT CODE")).alias("nomenclature"),
        F.coalesce(lnc_code, comp_code, F.col("COMPONENT_ID").cast("string")).alias("code"),
        F.coalesce(F.col("LNC_FULL_NAM"), F.col("COMP_NAME")).alias("NAME"),
        "HOSP_ADMIT_DT", F.col("l_shipdate").alias("resultTime"),
        boundary_diff("SECOND", "HOSP_ADMIT_DT", "l_shipdate").alias("resultTime_Anonymized"),
        F.col("l_returnflag").alias("value"), F.col("DFLT_UNITS").alias("units"))


QUERIES = {
    "unit_window_seed": q_unit_window_seed,
    "unit_classify": q_unit_classify,
    "lookup_chain": q_lookup_chain,
    "role_playing_lookup": q_role_playing_lookup,
    "nested_left_tree": q_nested_left_tree,
    "cohort_semi": q_cohort_semi,
    "cohort_semi_nested": q_cohort_semi_nested,
    "anti_unmatched": q_anti_unmatched,
    "left_join_filtered_right": q_left_join_filtered_right,
    "listagg_names": q_listagg_names,
    "hospital_style_rollup": q_hospital_style_rollup,
    "distinct_rows": q_distinct_rows,
    "collated_min": q_collated_min,
    "tagged_union_min": q_tagged_union_min,
    "code_coalesce": q_code_coalesce,
}

_PRIORITIES_SQL = """prio AS (
  SELECT o_custkey, string_agg(o_orderpriority, '|' ORDER BY o_orderpriority) AS PRIORITIES
  FROM (SELECT DISTINCT o_custkey, o_orderpriority FROM orders) GROUP BY o_custkey)"""

ORACLE = {
    "unit_window_seed": f"WITH {SEED_SQL} SELECT * FROM seed",
    "unit_classify": f"""
SELECT c.c_custkey, c.c_mktsegment, COALESCE(u.dpt_grp, 'OTHER') AS DEPT_GRP
FROM customer c LEFT JOIN {_units_sql(SEGMENT_UNITS)} u ON c.c_mktsegment = u.dpt_id""",
    "lookup_chain": """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_orderdate, c.c_name,
       n.n_name AS cust_nation, r.r_name AS cust_region
FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey""",
    "role_playing_lookup": """
SELECT l.l_orderkey, l.l_linenumber, l.l_suppkey, sn.n_name AS supp_nation,
       cn.n_name AS cust_nation
FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_suppkey
LEFT JOIN nation sn ON sn.n_nationkey = s.s_nationkey
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN nation cn ON cn.n_nationkey = c.c_nationkey""",
    "nested_left_tree": """
SELECT o.o_orderkey, o.o_custkey, c.c_name, n.n_name, r.r_name
FROM orders o LEFT JOIN (customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                         LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)
  ON o.o_custkey = c.c_custkey""",
    "cohort_semi": f"""WITH {SEED_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_shipdate FROM lineitem
WHERE l_orderkey IN (SELECT DISTINCT o_orderkey FROM seed)""",
    "cohort_semi_nested": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_custkey IN (
  SELECT c_custkey FROM customer WHERE c_nationkey IN (
    SELECT n_nationkey FROM nation WHERE n_regionkey IN (
      SELECT r_regionkey FROM region WHERE r_name = 'ASIA'))))""",
    "anti_unmatched": """
SELECT p.p_partkey, p.p_name FROM part p
LEFT JOIN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity >= 45) b
  ON b.l_partkey = p.p_partkey
WHERE b.l_partkey IS NULL""",
    "left_join_filtered_right": """
SELECT o.o_orderkey, o.o_orderstatus, l.l_linenumber, l.l_quantity
FROM orders o LEFT JOIN lineitem l ON l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R'""",
    "listagg_names": f"""WITH {_PRIORITIES_SQL}
SELECT c.c_custkey, c.c_name, p.PRIORITIES FROM customer c
LEFT JOIN prio p ON p.o_custkey = c.c_custkey""",
    "hospital_style_rollup": f"""WITH {_PRIORITIES_SQL}
SELECT o.o_custkey AS pid, o.o_orderkey AS hid, min(c.c_mktsegment) AS segment,
  min(o.o_orderdate) AS BIRTH_DATE, min(l.l_shipdate) AS FIRST_SHIP,
  min(date_diff('day', o.o_orderdate, l.l_shipdate)) AS shipAge_Anonymized,
  max(l.l_shipdate) AS LAST_SHIP,
  min(date_diff('second', o.o_orderdate, l.l_shipdate)) AS shipSpan_Anonymized,
  min(p.PRIORITIES) AS PRIORITIES,
  max(if(l.l_returnflag = 'R' AND l.l_shipdate < o.o_orderdate, '1', '0')) AS returnedEarly,
  min(year(o.o_orderdate)) AS yearOfOrder
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON c.c_custkey = o.o_custkey
LEFT JOIN prio p ON p.o_custkey = o.o_custkey
GROUP BY o.o_custkey, o.o_orderkey""",
    "distinct_rows": "SELECT DISTINCT o_custkey, o_orderstatus, o_orderpriority FROM orders",
    "collated_min": """
SELECT p_brand, arg_min(name, icu_sort_key(name, 'en')) AS min_name, min(name) AS min_binary,
       count(*) AS n_parts
FROM (SELECT p_brand, CASE p_partkey % 3 WHEN 0 THEN upper(p_name)
             WHEN 1 THEN replace(p_name, 'a', 'á') ELSE p_name END AS name FROM part)
GROUP BY p_brand""",
    "tagged_union_min": f"""WITH {SEED_SQL},
lo AS (SELECT * FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
       WHERE o.o_custkey IN (SELECT DISTINCT o_custkey FROM seed)),
diags AS (
  SELECT d.CSN, d.START_DT, d.END_DT, d.DX_ID, p.p_name AS DX_NAME, d.SOURCE,
         p.p_brand AS CURRENT_ICD10_LIST, d.PRIMARY_YN
  FROM (
    SELECT o_custkey AS CSN, l_shipdate AS START_DT, l_shipdate AS END_DT, l_partkey AS DX_ID,
           NULLIF(l_linestatus, 'O') AS PRIMARY_YN, 'SHIP' AS SOURCE FROM lo
    UNION ALL
    SELECT o_custkey, o_orderdate, l_shipdate, l_partkey, NULLIF(l_returnflag, 'N'), 'ORDER'
    FROM lo
    UNION ALL
    SELECT o_custkey, o_orderdate, CAST(NULL AS TIMESTAMP), l_suppkey, CAST(NULL AS VARCHAR),
           'SUPPLY' FROM lo
    UNION ALL
    SELECT o_custkey, l_shipdate, l_shipdate, l_partkey, NULLIF(l_returnflag, 'N'), 'RETURN'
    FROM lo WHERE l_returnflag = 'R') d
  LEFT JOIN part p ON p.p_partkey = d.DX_ID
  WHERE d.DX_ID IS NOT NULL
  GROUP BY d.CSN, d.START_DT, d.END_DT, d.DX_ID, p.p_name, d.SOURCE, p.p_brand, d.PRIMARY_YN)
SELECT min(e.o_orderkey) AS pid, dia.CSN AS hid, min(e.o_orderdate) AS BIRTH_DATE,
  dia.START_DT AS recorded,
  min(date_diff('day', e.o_orderdate, dia.START_DT)) AS recorded_Anonymized,
  'ICD10' AS nomenclature, min(dia.CURRENT_ICD10_LIST) AS code, min(dia.DX_NAME) AS codeText,
  min(dia.SOURCE) AS source, min(dia.START_DT) AS onset,
  min(date_diff('day', e.o_orderdate, dia.START_DT)) AS onset_Anonymized,
  min(dia.END_DT) AS abatement,
  min(date_diff('day', e.o_orderdate, dia.END_DT)) AS abatement_Anonymized,
  CASE WHEN dia.END_DT IS NOT NULL THEN '1' ELSE '0' END AS abatementBoolean,
  min(dia.PRIMARY_YN) AS isPrimary
FROM diags dia JOIN seed e ON dia.CSN = e.o_custkey
GROUP BY dia.CSN, dia.DX_ID, dia.START_DT, dia.END_DT""",
    "code_coalesce": f"""WITH {SEED_SQL}
SELECT l.l_orderkey AS hid, l.l_linenumber AS line,
  CASE WHEN lnc.LNC_CODE IS NOT NULL THEN 'LONIC CODE'
       WHEN comp.LOINC_CODE IS NOT NULL THEN 'LONIC CODE' ELSE 'COMPONENT CODE' END AS nomenclature,
  COALESCE(lnc.LNC_CODE, comp.LOINC_CODE, CAST(comp.COMPONENT_ID AS VARCHAR)) AS code,
  COALESCE(lnc.LNC_FULL_NAM, comp.NAME) AS NAME,
  o.o_orderdate AS HOSP_ADMIT_DT, l.l_shipdate AS resultTime,
  date_diff('second', o.o_orderdate, l.l_shipdate) AS resultTime_Anonymized,
  l.l_returnflag AS value, comp.DFLT_UNITS AS units
FROM lineitem l
LEFT JOIN (SELECT p_partkey AS COMPONENT_ID, p_name AS NAME,
                  CASE WHEN p_size <= 10 THEN p_brand END AS LOINC_CODE, p_type AS DFLT_UNITS
           FROM part) comp ON comp.COMPONENT_ID = l.l_partkey
LEFT JOIN (SELECT s_suppkey AS RECORD_ID, 'LNC-' || CAST(s_suppkey AS VARCHAR) AS LNC_CODE,
                  s_name AS LNC_FULL_NAM FROM supplier WHERE s_acctbal > 5000) lnc
  ON lnc.RECORD_ID = l.l_suppkey
LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey
WHERE l.l_orderkey IN (SELECT DISTINCT o_orderkey FROM seed)""",
}
