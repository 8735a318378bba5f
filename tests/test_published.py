"""Published versions and the lifetime of intermediates."""

import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from stayflow.sources import intermediates, published
from stayflow.sources.sinks import materialize, publish, read_published


def place():
    return os.path.join(tempfile.mkdtemp(prefix="stayflow-pub-"), "cohort")


def ids(df):
    return sorted(r.id for r in df.collect())


def test_a_failed_publication_leaves_the_one_before(spark):
    path = place()
    first = publish(spark.range(5), path)
    fails = spark.range(9).withColumn("id", F.raise_error(F.lit("lost")).cast("long"))
    with pytest.raises(Exception, match="lost"):
        publish(fails, path)
    assert ids(read_published(spark, path)) == ids(first) == [0, 1, 2, 3, 4]
    assert len(os.listdir(f"{path}/versions")) == 1
    # rows written, manifest not: as if the driver had gone in between
    spark.range(7).write.parquet(f"{path}/versions/v-lost")
    assert ids(read_published(spark, path)) == [0, 1, 2, 3, 4]


def test_readers_of_a_version_keep_it(spark):
    path = place()
    first = publish(spark.range(2), path, keep=2)
    second = publish(spark.range(3), path, keep=2)
    assert ids(first) == [0, 1] and ids(second) == ids(read_published(spark, path)) == [0, 1, 2]
    assert ids(read_published(spark, path, number=1)) == [0, 1]
    third = publish(read_published(spark, path).union(spark.range(10, 11)), path, keep=2)  # reads what it replaces
    assert ids(third) == [0, 1, 2, 10] and ids(second) == [0, 1, 2]
    assert [v.number for v in published.published(spark, path)] == [2, 3]
    assert len([f for f in os.listdir(f"{path}/versions") if f.startswith("v-")]) == 2
    with pytest.raises(FileNotFoundError):
        read_published(spark, path, number=1)
    with pytest.raises(FileNotFoundError):
        read_published(spark, place())


def test_two_publications_at_once_take_two_numbers(spark, monkeypatch):
    path = place()
    publish(spark.range(1), path)
    stale = published.published(spark, path)
    real, calls = published.published, []

    def late(*args):
        calls.append(1)
        return stale[:0] if len(calls) == 1 else real(*args)  # does not see the other's manifest yet

    monkeypatch.setattr(published, "published", late)
    publish(spark.range(2), path)
    monkeypatch.undo()
    assert [v.number for v in published.published(spark, path)] == [1, 2]
    assert ids(read_published(spark, path)) == [0, 1]


def mine(spark):
    return [p.removeprefix("file:") for p in intermediates.held(spark) if "lifetime" in p]


def test_intermediates_go_with_their_last_reader(spark):
    def call():
        return materialize(spark.range(4), "lifetime").filter("id > 1").select((F.col("id") * 2).alias("id"))

    intermediates.release(spark, collect=True)
    one, two = call(), call()
    folders = mine(spark)
    assert len(folders) == 2 and all(os.path.isdir(f) for f in folders)
    del one
    for _ in range(20):
        if intermediates.release(spark, collect=True) and len(mine(spark)) == 1:
            break
    assert mine(spark) == folders[1:]
    assert not os.path.exists(folders[0]) and ids(two) == [4, 6]  # a derived reader keeps its own
    joined = two.join(spark.range(7), "id")
    del two
    intermediates.release(spark, collect=True)
    assert ids(joined) == [4, 6]


def test_calls_of_a_query_leave_no_folders(spark):
    from stayflow.plans import registry
    query = registry.QUERIES["flowsheet_catalog"]
    registry.build_shared(spark, "/root/testdata/sf0.001")  # the published cohort stays

    def folders():
        for _ in range(4):  # handles go one after the other
            intermediates.release(spark, collect=True)
            time.sleep(0.3)
        return len(intermediates.held(spark))

    before = folders()
    for _ in range(4):
        query(spark, "/root/testdata/sf0.001").collect()
    # Spark itself may still hold the last call's plan
    assert folders() <= before + 1


def test_the_end_of_a_session_removes_the_rest(spark):
    df = materialize(spark.range(3), "lifetime-end")
    assert df.count() == 3
    folder = [p for p in intermediates.held(spark) if "lifetime-end" in p][0]
    kept = intermediates._OWNED.pop(spark.sparkContext.applicationId)
    try:
        intermediates._OWNED[spark.sparkContext.applicationId] = [e for e in kept if e[1] == folder]
        intermediates._end(spark.sparkContext)
    finally:
        intermediates._OWNED[spark.sparkContext.applicationId] = [e for e in kept if e[1] != folder]
    assert not os.path.exists(folder.removeprefix("file:")) and df is not None
