"""Repeated rows and units, NULL keys, shared folders, source resolution, written order."""

import glob
import os
import types
from dataclasses import replace
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stayflow.operators.coverage import coverage_summary
from stayflow.operators.joins import classify
from stayflow.operators.merge import tagged_rows, tagged_union
from stayflow.operators.stays import stay_steps
from stayflow.plans.cohort import all_encounters
from stayflow.plans.departments import flowsheet_catalog
from stayflow.session import checkpoint_dir, run_folder
from stayflow.sources.catalog import JdbcSource, SourceCatalog
from stayflow.sources.config import UnitWindow, config_from_dict, units_frame
from stayflow.sources.sinks import materialize, write_extract
from tests.clinical_fixtures import CFG, catalog
from tests.test_stays import CASES, ORDER, events_frame


def _twice(cfg):
    units = []
    for u in cfg.units:
        middle = u.open_date + (u.close_date - u.open_date) / 2
        units += [replace(u, close_date=middle + timedelta(days=1)), replace(u, open_date=middle)]
    return replace(cfg, units=tuple(units))


def _stays(df):
    return sorted(tuple(r) for r in df.collect())


def test_units_listed_twice_and_repeated_events_change_nothing(spark):
    src = catalog(spark)
    want = _stays(all_encounters(src, CFG))
    assert _stays(all_encounters(src, _twice(CFG))) == want
    adt = src.table("CLARITY_ADT")
    doubled = catalog(spark).register("CLARITY_ADT", adt.unionAll(adt))
    assert _stays(all_encounters(doubled, CFG)) == want
    assert sum(r[1] == 1002 for r in want) == 1     # the bridged trip stays one stay


def test_classify_labels_once_per_group(spark):
    units = units_frame(spark, [UnitWindow("A", "1", date(2020, 1, 1), date(2021, 1, 1)),
                                UnitWindow("A", "1", date(2022, 1, 1), date(2023, 1, 1)),
                                UnitWindow("B", "2", date(2020, 1, 1), date(2021, 1, 1))])
    ev = spark.createDataFrame([(1,), (2,), (3,), (None,)], "dept long")
    got = sorted((str(r.dept), r.DEPT_GRP) for r in classify(ev, units, "dept").collect())
    assert got == [("1", "A"), ("2", "B"), ("3", "OTHER"), ("None", "OTHER")]


@pytest.mark.parametrize("step", ["bounds", "bridges", "runs", "edges", "pairs"])
def test_null_key_is_a_hot_key_like_any_other(spark, step):
    ev = events_frame(spark, CASES)
    one = ev.select("enc").first()["enc"]
    ev = ev.withColumn("enc", F.when(F.col("enc") != one, F.col("enc")))
    args = (ev, "enc", ORDER, "dept_grp", "dir", "effective_time", step)
    plain = stay_steps(*args)
    chunked = stay_steps(*args, hot_threshold=0, chunk_rows=3).select(plain.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted(plain.collect(), key=key) == sorted(chunked.collect(), key=key)


def test_coverage_of_nothing_is_zero(spark):
    meds = spark.createDataFrame([], "medID long")
    matches = spark.createDataFrame([], "ORIG_MED_ID long")
    assert [r.CNT for r in coverage_summary(meds, matches).collect()] == [0, 0, 0, 0]


def test_tagged_rows_equal_the_union(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, "b"), (3, "c", "d")], "k long, x string, y string")
    x, y = F.col("x"), F.col("y")
    union = tagged_union({"X": df.select("k", x.alias("v")), "Y": df.filter(y.isNotNull()).select("k", y.alias("v"))})
    rows = tagged_rows(df, {"X": {"v": x}, "Y": {"v": y}}, where={"Y": y.isNotNull()}, keep=["k"])
    assert sorted(map(str, rows.select(union.columns).collect())) == sorted(map(str, union.collect()))


def test_flowsheet_catalog_starts_from_the_cohort(spark):
    src = catalog(spark)
    cohort = materialize(all_encounters(src, CFG), "cohort")
    plan = flowsheet_catalog(src, cohort)._jdf.queryExecution().optimizedPlan().toString()
    names, counts = plan.index("FLO_MEAS_NAME"), plan.index("RECORDED_TIME")
    assert plan.count("Join") == 3 and names < counts        # names are joined to the counts


# -- folders ------------------------------------------------------------------------

def test_no_machine_local_folder_on_a_cluster():
    context = types.SimpleNamespace(applicationId="x", getCheckpointDir=lambda: None, master="yarn")
    session = types.SimpleNamespace(sparkContext=context, conf={})
    with pytest.raises(RuntimeError, match="all executors share"):
        checkpoint_dir(session)
    context.master = "local-cluster[2,1,1024]"
    with pytest.raises(RuntimeError):
        checkpoint_dir(session)


def test_run_folder_is_removed(spark):
    with run_folder(spark) as path:
        assert materialize(spark.range(3), "x").count() == 3
        assert os.listdir(path.removeprefix("file:"))
    assert not os.path.exists(path.removeprefix("file:"))


# -- sources ------------------------------------------------------------------------

def test_database_and_parquet_folder(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS resolver_db")
    spark.range(2).write.mode("overwrite").saveAsTable("resolver_db.ORDER_PROC")
    assert SourceCatalog(spark, database="resolver_db").table("Clarity..ORDER_PROC").count() == 2
    spark.range(3).write.parquet(str(tmp_path / "pat_enc.parquet"))
    spark.range(4).write.parquet(str(tmp_path / "PATIENT"))
    src = SourceCatalog(spark, parquet_dir=str(tmp_path), database="resolver_db")
    assert [src.table(t).count() for t in ("PAT_ENC", "patient", "order_proc")] == [3, 4, 2]
    with pytest.raises(KeyError):
        SourceCatalog(spark, parquet_dir=str(tmp_path)).table("NO_SUCH")


def test_jdbc_needs_partitioning(spark):
    src = SourceCatalog(spark, jdbc=JdbcSource("jdbc:none:x", small_tables=frozenset({"ZC_SEX"})))
    with pytest.raises(ValueError, match="partitioning"):
        src.table("ORDER_MED")


def test_study_is_mandatory():
    with pytest.raises(ValueError, match="lacks start, units"):
        config_from_dict({"end": "2021-01-01"})


# -- written order ---------------------------------------------------------------------

def test_files_are_in_the_stated_order(spark, tmp_path):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.col("id").alias("v"))
    path = write_extract(rows.repartition(5), "ordered", str(tmp_path), order_by=["k"])
    values = []
    for part in sorted(glob.glob(os.path.join(path, "part-*"))):
        with open(part) as f:
            values += [int(line.split(",")[0]) for line in f.read().split()[1:]]
    assert values == sorted(values) and len(values) == 1000
