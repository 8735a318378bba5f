"""Linking medication ids to standard nomenclatures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions.expr import typed_null

LINK_COLUMNS = ["medID", "line", "nomenclature", "code", "name", "rxNormCodeLevel",
                "rxNormTermType"]


def unpivot_ids(df: DataFrame, cols: Sequence[str], out: str = "MEDICATION_ID") -> DataFrame:
    """Distinct values found in any of ``cols`` (one NULL row kept if any is NULL)."""
    return df.select(F.explode(F.array(*[F.col(c) for c in cols])).alias(out)).distinct()


def link_rows(df: DataFrame, nomenclature: str, *, med: str, code: Column,
              line: Column | None = None, name: Column | None = None,
              level: Column | None = None, term_type: Column | None = None,
              id_type: str = "bigint", line_type: str = "int") -> DataFrame:
    """Shape one branch into the link layout; ``code`` is always text."""
    return df.select(
        F.col(med).cast(id_type).alias("medID"),
        (line if line is not None else typed_null(line_type)).cast(line_type).alias("line"),
        F.lit(nomenclature).alias("nomenclature"),
        code.cast("string").alias("code"),
        (name if name is not None else typed_null("string")).cast("string").alias("name"),
        (level if level is not None else typed_null("string")).cast("string")
        .alias("rxNormCodeLevel"),
        (term_type if term_type is not None else typed_null("string")).cast("string")
        .alias("rxNormTermType"),
    )


def class_links_shared(ids: DataFrame, master: DataFrame,
                       specs: Sequence[tuple[str, str, DataFrame, str]],
                       id_col: str = "MEDICATION_ID") -> DataFrame:
    """ids -> medication master -> category (code = its INTERNAL_ID, name = its NAME) for
    several class columns, with ONE join of ids to the medication master.

    ``specs`` are (nomenclature, master class column, category table, category key).
    The class columns are stacked into (nomenclature, class code) rows and joined to
    the categories tagged by nomenclature, so the master is scanned and joined once
    instead of once per class.
    """
    m = master.select(F.col("MEDICATION_ID").alias("__mid"),
                      *[F.col(col).alias(f"__c{i}") for i, (_, col, _, _) in enumerate(specs)])
    stacked = ids.join(m, F.col(id_col) == F.col("__mid"), "inner").select(
        F.col(id_col), F.explode(F.array(*[
            F.struct(F.lit(nom).alias("nom"), F.col(f"__c{i}").alias("cls"))
            for i, (nom, _, _, _) in enumerate(specs)])).alias("__k"))
    cats = None
    for nom, _, category, key in specs:
        c = category.select(F.lit(nom).alias("__nom"), F.col(key).alias("__cls"),
                            F.col("INTERNAL_ID").alias("__iid"), F.col("NAME").alias("__cname"))
        cats = c if cats is None else cats.unionByName(c)
    j = stacked.join(cats, (F.col("__k.nom") == F.col("__nom"))
                     & (F.col("__k.cls") == F.col("__cls")), "inner")
    return j.select(
        F.col(id_col).cast("bigint").alias("medID"), typed_null("int").alias("line"),
        F.col("__nom").alias("nomenclature"), F.col("__iid").cast("string").alias("code"),
        F.col("__cname").cast("string").alias("name"), typed_null("string").alias("rxNormCodeLevel"),
        typed_null("string").alias("rxNormTermType"))


def link_codes(branches: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of link branches, de-duplicated once."""
    out = branches[0].select(*LINK_COLUMNS)
    for b in branches[1:]:
        out = out.unionByName(b.select(*LINK_COLUMNS))
    return out.distinct()


def best_code(codes: DataFrame, key: str, rank: str, code: str, eligible: Column) -> DataFrame:
    """Per ``key``: highest ``rank`` among ``eligible`` rows, then the max ``code``
    over ALL rows of that key having that rank (eligibility is not re-applied).

    Both aggregates combine map-side, and the per-key maximum (one row per key) is
    joined back on (key, rank); a NULL maximum never matches.
    """
    best = (codes.filter(eligible).groupBy(key)
            .agg(F.max(rank).alias("__best_rank"))
            .withColumnRenamed(key, "__best_key"))
    picked = codes.select(key, rank, code).join(
        best, (F.col(key) == F.col("__best_key")) & (F.col(rank) == F.col("__best_rank")),
        "inner")
    return picked.groupBy(key).agg(F.max(code).alias(code))
