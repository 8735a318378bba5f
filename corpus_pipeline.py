"""The corpus pipeline: quality rules, exact duplicates, near duplicates, personal data and
packing over ``documents``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which the next one reads
again from Parquet. All but the last return the columns of their input.

Defined results: rows without an id are judged and kept like others, except that the Jaccard
join, which names groups by id, leaves them in. Repeated rows are exact duplicates; one stays.
An empty table passes through. Columns beyond those of ``documents`` are kept as they are,
whatever their names (in any case, with dots).
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayflow.llm.common import (
    free_name, materialize, quoted, released_workers, sent, small_batches, table)
from stayflow.llm.exact_dedup import exact_dedup
from stayflow.llm.jaccard_join import Similarity, jaccard_classes
from stayflow.llm.packing import best_fit_packing
from stayflow.llm.personal_data import sanitised
from stayflow.llm.quality_rules import quality_rules

#: Near duplicates share 80 of 100 shingles of five words.
NEAR = Similarity(words=5, part=80, of=100)


def _released(stage):
    """The stage, with small batches to Python workers that let go of their tables: the next
    stage runs in the same executors."""
    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        with released_workers():
            return stage(spark, docs, sf_dir)

    return run


def _same_columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*map(quoted, docs.columns))


def _without(docs: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose ``key`` is in ``keys`` (one column of that name)."""
    return docs.join(sent(materialize(keys.distinct(), "dropped")), key, "left_anti")


@_released
def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counting rules and their language's perplexity band accept."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "lang", "text"))
    bad = quality_rules(keyed, id_col=key).filter(~F.col("kept")).select(F.col("doc_id").alias(key))
    return _same_columns(_without(keyed, bad, key), docs)


@_released
def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each set of equal texts."""
    key = free_name(docs, "row_key")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    found = materialize(exact_dedup(docs, with_key=True).select("kept", F.col("key").alias(key)),
                        "exact-verdicts")
    stay = found.filter("kept").select(key)
    gone = found.filter(~F.col("kept")).select(key)
    rest = _without(keyed, gone.join(stay, key, "left_anti"), key)
    twice = materialize(gone.join(stay, key, "left_semi").distinct(), "repeated-rows")
    if not twice.isEmpty():  # repeats of a row that stays
        rest = rest.join(twice, key, "left_anti").unionByName(
            rest.join(twice, key, "left_semi").dropDuplicates([key]))
    return _same_columns(rest, docs)


@_released
def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    found = jaccard_classes(docs, NEAR)
    gone = found.filter(F.col("component_id") != F.col("doc_id")).select("doc_id")
    return _same_columns(_without(docs, gone, "doc_id"), docs)


def personal_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced and telling terms generalised or removed."""
    return sanitised(docs)


@_released
def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces and their places in sequences of 2048 tokens."""
    return best_fit_packing(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("exact_dedup", exact_stage),
    ("jaccard_join", near_stage),
    ("personal_data", personal_stage),
    ("best_fit_packing", packing_stage),
]

#: Tokenizing, near duplicates and the perplexity model have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = table(spark, sf_dir, "documents")
    for at, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if at + 1 < len(STAGES):
            docs = materialize(docs, f"pipeline-{name}")
    return docs
