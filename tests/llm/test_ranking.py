"""Quality ranking: pairs, the loss, held-out rows and held-out accuracy."""
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from stayflow.llm import quality_ranking as qr


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == 2


@pytest.fixture(scope="module")
def corpus(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    return docs, labels


def test_held_out_accuracy(corpus):
    docs, labels = corpus
    found = qr.quality_ranking(docs, labels)
    assert found.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    got = {r.doc_id: r for r in found.collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == held(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
               for i, r in got.items())
    right = [got[r.doc_id].predicted == r.quality for r in labels.collect() if held(r.doc_id) and r.doc_id in got]
    assert len(right) > 50 and np.mean(right) > 0.95


def test_held_out_labels_are_never_learnt_from(corpus):
    docs, labels = corpus
    turned = labels.withColumn("quality", F.when(
        F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    one, other = ({r.doc_id: r.score for r in qr.quality_ranking(docs, x).collect()} for x in (labels, turned))
    assert one == other


def test_pairs():
    for good, bad in ((7, 3), (3, 7), (1, 1), (5, 5)):
        one, other = qr.preference_pairs(good, bad, 2)
        assert set(one) == set(range(good)) and set(other) == set(range(bad))
        assert len(set(zip(one.tolist(), other.tolist()))) == len(one)
    assert len(qr.preference_pairs(0, 4)[0]) == 0


def test_the_descent_finds_the_least_loss():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(60, 4)).astype(np.float32)
    truth = rows @ [2.0, -1.0, 0.0, 0.5]
    better, worse = [], []
    for i, j in rng.integers(0, 60, (500, 2)):
        if i != j:
            first = rng.random() < 1 / (1 + np.exp(truth[j] - truth[i]))
            better.append(i if first else j)
            worse.append(j if first else i)
    better, worse = np.array(better), np.array(worse)
    w = qr.learn(rows, better, worse, penalty=0.0, steps=2000)
    d = rows[better] - rows[worse]
    slope = (d * (1 / (1 + np.exp(d @ w)))[:, None]).mean(0)
    assert np.abs(slope).max() < 1e-3 and np.corrcoef(rows @ w, truth)[0, 1] > 0.95


def test_defined_results(spark):
    good = "The quick brown fox jumps over the lazy dog and goes home. It was late.\nNobody saw it."
    rows = [(i, f"{good} Number {i}.") for i in range(40)]
    rows += [(i, "BUY%%% NOW!!! " * 20 + str(i)) for i in range(40, 60)]
    rows += [(100, None), (101, ""), (None, good), (102, "x"), (102, "x"), (103, "word " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn(
        "label", F.lit(1)).repartition(3)
    labels = spark.createDataFrame([(i, int(i < 40)) for i in range(60)] + [(0, 1), (100, None), (101, 7)],
                                   "doc_id long, quality int")
    got = qr.quality_ranking(docs, labels).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert not by_id[None].held_out and by_id[None].predicted == 1
    assert all(by_id[i].predicted == (i < 40) for i in range(60))
    assert all(r.score == r.score and 0 <= r.score <= 1 for r in got)
    for none in (labels.filter("quality = 1"), labels.limit(0)):
        assert {(r.score, r.predicted) for r in qr.quality_ranking(docs, none).collect()} == {(0.7, 1)}
    assert qr.quality_ranking(docs.limit(0), labels).count() == 0


def test_repetition_is_seen_in_one_stretch():
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcdefgh"), 6)) for _ in range(400)]
    plain, stuck = " ".join(words), " ".join(words[:300] + ["stuck"] * 60 + words[300:])
    at = 2 * qr.COLUMNS + 4
    assert qr.features(plain)[at] < 0.1 < 0.5 < qr.features(stuck)[at]
    assert len(qr.features("")) == len(qr.features(plain))
