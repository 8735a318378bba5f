"""Key sets above the broadcast size: the sieve in the scan, and facts laid out in buckets."""

import re
import uuid
import warnings
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from stayflow.operators.joins import reduce_dimension, restrict_to, sift
from stayflow.plans.cohort import all_encounters
from stayflow.plans.extracts import conditions, labs, vitals
from stayflow.sources.layout import FACT_KEYS, lay_out, write_bucketed
from stayflow.sources.sinks import materialize
from tests.clinical_fixtures import CFG, catalog


@contextmanager
def settings(spark, **conf):
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def no_broadcast(spark):
    return settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"})


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_fewer_fact_rows_are_shuffled(spark):
    fact = materialize(spark.range(200_000).select((F.col("id") % 50_000).alias("enc"), F.col("id").alias("row")), "fact")
    keys = materialize(spark.range(0, 50_000, 50).select(F.col("id").alias("csn")), "keys")
    want = restrict_to(fact, keys, {"enc": "csn"}).count()
    assert want == 4000
    sifted = sift(fact, keys, {"enc": "csn"})
    assert sifted.columns == fact.columns
    assert want <= sifted.count() < 0.1 * fact.count()         # of 196,000 others few are left
    with no_broadcast(spark):
        found = reduce_dimension(fact, keys, {"enc": "csn"})
        plan = plan_of(found)
        # the sieve lies between the fact's scan and its exchange
        assert "SortMergeJoin" in plan and "BroadcastHashJoin" in plan
        assert plan.index("Exchange hashpartitioning(enc") < plan.index("BroadcastHashJoin")
        assert sorted(r.row for r in found.collect()) == sorted(
            r.row for r in restrict_to(fact, keys, {"enc": "csn"}).collect())
    assert "BroadcastHashJoin" in plan_of(reduce_dimension(fact, keys, {"enc": "csn"}))
    assert plan_of(reduce_dimension(fact, keys, {"enc": "csn"})).count("Join") == 1  # small keys: no sieve


def test_sieve_of_several_columns_nulls_and_other_types(spark):
    fact = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (None, "a"), (3, None)] * 20, "k long, t string")
    keys = spark.createDataFrame([(1, "a"), (None, "a"), (2, "a"), (2, "a")], "k long, t string")
    with no_broadcast(spark):
        assert reduce_dimension(fact, keys, ["k", "t"]).count() == 40
        assert reduce_dimension(fact, keys.limit(0), ["k", "t"]).count() == 0
        assert reduce_dimension(fact.limit(0), keys, ["k", "t"]).count() == 0
        ints = keys.select(F.col("k").cast("int").alias("k"))
        assert sift(fact, ints, "k") is None                     # 1 and 1L hash differently
        assert reduce_dimension(fact, ints, "k").count() == 60


def test_extracts_are_the_same_without_broadcasts(spark):
    src = catalog(spark)
    cohort = materialize(all_encounters(src, CFG), "cohort")

    def rows():
        return [sorted(map(str, df.collect())) for df in (
            conditions(src, cohort), labs(src, cohort), vitals(src, cohort, CFG))]

    plain = rows()
    with no_broadcast(spark):
        assert rows() == plain


@pytest.fixture
def database(spark):
    name = f"laid_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name}")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def exchanged(plan, column):
    """Whether the scan of ``column`` lies under an exchange of rows before the first join."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line and f"{column}#" in line)
    depth = [len(re.match(r"[\s:|+\-*()\d]*", line)[0]) for line in lines]
    here = depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < here:
            here = depth[i]
            if "Exchange hashpartitioning" in lines[i]:
                return True
            if "Join" in lines[i]:
                return False
    return False


def test_bucketed_facts_are_not_moved(spark, database):
    flat = catalog(spark)
    laid = lay_out(flat, database, 4)
    assert set(FACT_KEYS) >= {t.name.upper() for t in spark.catalog.listTables(database)} >= {"ORDER_RESULTS"}
    cohort = materialize(all_encounters(flat, CFG), "cohort")
    keys = materialize(cohort.select("PAT_ENC_CSN_ID").distinct(), "keys")
    for name in ("ORDER_RESULTS", "PAT_ENC_DX", "ORDER_MED"):
        assert sorted(map(str, laid.table(name).collect())) == sorted(map(str, flat.table(name).collect()))
        with no_broadcast(spark):
            moved = plan_of(restrict_to(materialize(flat.table(name), name), keys, "PAT_ENC_CSN_ID"))
            stays = plan_of(restrict_to(laid.table(name), keys, "PAT_ENC_CSN_ID"))
        own = next(c for c in laid.table(name).columns if c not in ("PAT_ENC_CSN_ID", "PAT_ID"))
        assert exchanged(moved, own) and not exchanged(stays, own), stays
    for extract in (lambda s: conditions(s, cohort), lambda s: labs(s, cohort), lambda s: vitals(s, cohort, CFG)):
        want = sorted(map(str, extract(flat).collect()))
        with no_broadcast(spark):
            assert sorted(map(str, extract(laid).collect())) == want


def test_a_hot_key_leaves_its_table_unbucketed(spark, database):
    df = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"), "id")
    with warnings.catch_warnings(record=True) as said:
        warnings.simplefilter("always")
        hot = write_bucketed(df, f"{database}.hot", "k", 16)
        even = write_bucketed(df.withColumn("k", F.col("id")), f"{database}.even", "k", 16)
    assert any("not bucketed" in str(w.message) for w in said)
    assert hot.count() == even.count() == 1000
    buckets = {t: spark.sql(f"DESCRIBE EXTENDED {database}.{t}").filter("col_name = 'Num Buckets'").count()
               for t in ("hot", "even")}
    assert buckets == {"hot": 0, "even": 1}
