"""Interval containment by bins of time against the plain join, and the hot-key sketch."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from stayflow.operators import joins
from stayflow.operators.joins import within_interval
from stayflow.operators.stays import hot_keys

T0 = datetime(2020, 1, 1)


def frames(spark, kind, seed=1):
    rng = random.Random(seed)

    def at(x):
        return None if x is None else x - 5000 if kind == "bigint" else T0 + timedelta(minutes=x) \
            if kind != "date" else (T0 + timedelta(days=x % 300)).date()

    points, intervals = [], []
    for i in range(600):
        points.append((rng.choice(["hot", "hot", "a", "b", None]), i, at(rng.choice([None, *range(0, 9000, 30)]))))
    for i in range(150):
        start = rng.choice([None, *range(0, 9000, 30)])
        end = None if start is None or rng.random() < .03 else start + rng.choice([-30, 0, 30, 300, 3000, 9000])
        intervals.append((rng.choice(["hot"] * 8 + ["a", "c", None]), i, at(start), at(end)))
    p = spark.createDataFrame(points, f"k string, id long, t {kind}")
    return p, spark.createDataFrame(intervals, f"k string, id long, s {kind}, e {kind}")


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "date", "bigint"])
@pytest.mark.parametrize("paired", [0, 20])
def test_bins_equal_the_plain_join(spark, kind, paired):
    p, i = frames(spark, kind)
    plain = within_interval(p, i, "k", "t", "s", "e", paired=None)
    binned = within_interval(p, i, "k", "t", "s", "e", paired=paired)
    assert binned.columns == plain.columns == ["k", "id", "t", "k", "id", "s", "e"]
    assert binned.dtypes == plain.dtypes
    want = sorted(map(str, map(tuple, plain.collect())))
    assert len(want) > 1000 and sorted(map(str, map(tuple, binned.collect()))) == want


def test_a_hot_encounter_meets_few_candidates(spark):
    """2000 short stays and 20,000 measurements of one encounter: 40 million pairs by key."""
    stays = spark.range(2000).select(F.lit(1).alias("enc"), (F.col("id") * 3600).alias("s"),
                                     (F.col("id") * 3600 + 1800).alias("e"))
    points = spark.range(20_000).select(F.lit(1).alias("csn"), (F.col("id") * 360).alias("t"))
    met = []
    kept = joins._within_bins

    def seen(*args):
        met.append(True)
        return kept(*args)

    joins._within_bins = seen
    try:
        found = within_interval(points, stays, {"csn": "enc"}, "t", "s", "e")
    finally:
        joins._within_bins = kept
    assert met and found.count() == sum(1 for x in range(0, 20_000 * 360, 360) if x % 3600 <= 1800)
    # what a bin pairs before the residual: intervals of one level that touch the point's bin
    level = 6  # 4 ** 6 = 4096 >= 1801
    bins = points.select(F.floor(F.col("t") / 4 ** level).alias("b")).join(
        stays.select(F.explode(F.sequence(F.floor(F.col("s") / 4 ** level), F.floor(F.col("e") / 4 ** level))).alias("b")), "b")
    assert bins.count() < 5 * 20_000


def test_types_without_bins_are_joined_by_key(spark):
    p = spark.createDataFrame([("a", 1.5)], "k string, t double")
    i = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 3.0)], "k string, s double, e double")
    assert within_interval(p, i, "k", "t", "s", "e", paired=0).count() == 1


@pytest.mark.parametrize("counters", [1, 7, 1 << 14])
def test_the_sketch_finds_the_hot_keys(spark, counters):
    rows = [(k,) for k, n in (("a", 50), ("b", 11), ("c", 10), (None, 30), ("d", 1)) for _ in range(n)]
    df = spark.createDataFrame(rows, "k string").repartition(4)
    found = hot_keys(df, "k", 10, counters)
    assert sorted(map(str, (r.k for r in found.collect()))) == ["None", "a", "b"]
    none = hot_keys(df, "k", 1000, counters)
    assert none.isEmpty() and none.schema == df.schema
    assert hot_keys(df.limit(0), "k", 0, counters).isEmpty()
