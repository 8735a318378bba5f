"""The pipeline stage by stage against the operators' brute-force versions."""
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from stayflow.llm.personal_data import personal_data

from .test_duplicates import brute
from .test_texts import base_spans


@pytest.fixture(scope="module")
def stages(spark, docs_of, sample):
    """Every stage's output, written and read again, over the sample and odd rows."""
    from stayflow.llm.common import materialize

    words = [f"Word{i}ing" for i in range(60)]
    near = [(2 * 10 ** 6 + i, " ".join(words[:50 + i] + words[50 + i + 1:]), "en") for i in range(3)]
    odd = [(10 ** 6, None, None), (10 ** 6 + 1, "", "en"), sample[3], sample[3], (None, sample[4][1], "en"),
           (10 ** 6 + 2, " ".join(words) + " mail me@home.example.org", None),
           (10 ** 6 + 3, sample[5][1] + " \n", sample[5][2])]
    docs = docs_of(sample + near + odd).withColumn("ROW_KEY", F.lit("own")).withColumn("a.b", F.lit(7)).withColumn(
        "Told_Terms", F.lit("own"))
    out = [docs]
    for name, stage in pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], ""), f"test-{name}"))
    return out


def rows(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_order_and_columns(stages):
    assert [n for n, _ in pipeline.STAGES] == [
        "quality_rules", "exact_dedup", "jaccard_join", "personal_data", "best_fit_packing"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns


def test_other_columns_stay_as_they_are(stages):
    for df in stages[:-1]:
        assert {(r["ROW_KEY"], r["a.b"], r["Told_Terms"]) for r in df.collect()} == {("own", 7, "own")}


def test_quality_stage_follows_the_verdicts(stages):
    from stayflow.llm.quality_rules import quality_rules

    verdict = Counter((r.doc_id, r.kept) for r in quality_rules(stages[0]).collect())
    assert Counter(i for i, _ in rows(stages[1])) == Counter(
        {i: n for (i, kept), n in verdict.items() if kept})


def test_exact_stage_keeps_one_of_each_text(stages):
    groups = {}
    for i, t in rows(stages[1]):
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        groups.setdefault(norm, []).append((-len(t or ""), i is None, i))
    assert sorted(str(min(g)[2]) for g in groups.values()) == sorted(str(i) for i, _ in rows(stages[2]))


def test_near_stage_keeps_the_smallest_of_a_group(stages):
    named = [(i, t) for i, t in rows(stages[2]) if i is not None]
    group = brute(named, pipeline.NEAR)
    left = [i for i, _ in rows(stages[3])]
    assert sorted(i for i in left if i is not None) == sorted({g for _, g in group.values()})
    assert None in left or None not in [i for i, _ in rows(stages[2])]


def test_personal_stage_leaves_other_texts_alone(stages):
    before = dict(rows(stages[3]))
    after = dict(rows(stages[4]))
    assert before.keys() == after.keys()
    told = {r.doc_id: len(r.terms) for r in personal_data(stages[3]).collect()}
    assert sum(bool(told[i]) for i in told if not base_spans(before[i])) < len(told) / 20
    for i, text in before.items():
        if base_spans(text) or told[i]:
            assert after[i] != text
        else:
            assert after[i] == text


def test_packing_stage_packs_every_document(stages):
    packed = stages[5]
    assert packed.filter("piece = 0").count() == stages[4].count()
    total = packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(
        F.max("n").alias("most"), F.count("*").alias("bins"), F.sum("n").alias("all")).first()
    assert total["most"] <= 2048 and total["bins"] <= total["all"] / 2048 + 2


def test_empty_table(spark, stages):
    docs = stages[0].limit(0)
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


def test_python_workers_get_small_batches(spark):
    from stayflow.llm.common import BATCH_BYTES, map_arrow

    def sizes(batches):
        import pyarrow as pa

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    docs = spark.range(0, 2000, 1, 1).withColumn("text", F.expr("repeat('word ', 2000)"))   # 20 MB
    stage = pipeline._released(lambda spark, docs, sf_dir: map_arrow(docs, sizes, "n long"))
    found = [r.n for r in stage(spark, docs, "").collect()]
    assert sum(found) > 20_000_000 and max(found) < BATCH_BYTES + 100_000
