
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from stayflow.operators.joins import exclude, restrict_to
from tests.clinical_fixtures import CFG

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_semi_and_anti_joins(spark):
    a = spark.range(10).withColumnRenamed("id", "k")
    b = spark.range(5).withColumnRenamed("id", "k")
    assert "LeftSemi" in _plan(restrict_to(a, b, "k"))
    assert "LeftAnti" in _plan(exclude(a, b, "k"))


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_python_in_registered_plans(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert not re.search(r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|"
                         r"MapInPandas|PythonUDF)", plan), name


def test_study_window_reaches_the_scan(spark):
    plan = _plan(E.queries()["cohort"](spark, SF))
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThan\(ts,2024-01-03", plan)


def test_lookup_chain_prunes_columns(spark):
    plan = _plan(E.queries()["lookup_chain"](spark, SF))
    read = re.findall(r"ReadSchema: (struct<[^>]*>)", plan)
    orders = [r for r in read if "o_orderdate" in r]
    assert orders and all("o_totalprice" not in r and "o_orderpriority" not in r for r in orders)


def test_cohort_exchange_budget(spark):
    """Seed aggregate + semi join + all nine windows: at most three shuffles."""
    df = E.queries()["cohort"](spark, "/root/testdata/sf0.01")
    df.write.format("noop").mode("overwrite").save()
    plan = _plan(df)
    shuffles = re.findall(r"Exchange (hashpartitioning|rangepartitioning)", plan)
    assert plan.count("Window [") >= 4 and len(shuffles) <= 3, plan


def test_config_frames_are_the_only_hinted_broadcasts(spark):
    from stayflow.operators.joins import classify
    from stayflow.sources.config import units_frame
    ev = spark.range(100).select(F.col("id").alias("d"))
    plan = classify(ev, units_frame(spark, CFG.units), "d")._jdf.queryExecution() \
        .optimizedPlan().toString()
    assert "strategy=broadcast" in plan.replace(" ", "") or "broadcast" in plan.lower()
