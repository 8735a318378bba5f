"""How much of the principal medications can be linked to RxNorm, directly or
through a related id (ingredient, component, production drug)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.functions.expr import typed_null
from stayflow.operators.linkage import LINK_COLUMNS

VIA = ["proxyMedID", "componentMedID", "productionMedID"]


def _links(links: DataFrame, nomenclature: str) -> DataFrame:
    return links.filter(F.col("nomenclature") == nomenclature).select(
        *[F.col(c).alias("__l_" + c) for c in LINK_COLUMNS])


def _layout(df: DataFrame, id_type: str, via: str | None) -> DataFrame:
    cols = [F.col("ORIG_MED_ID"), F.col("CLARITY_NAME")]
    for c in VIA:
        cols.append((F.col(c) if c == via else typed_null(id_type)).cast(id_type).alias(c))
    cols += [F.col("__l_" + c).alias(c) for c in LINK_COLUMNS]
    return df.select(*cols)


def coverage_waterfall(unique_meds: DataFrame, hierarchy: DataFrame, links: DataFrame,
                       nomenclature: str = "RXNORM", id_type: str = "bigint") -> DataFrame:
    """Match rows: direct links of each principal id, and for ids without one, links
    reached through each related id of the hierarchy. Only rows with a code.

    unique_meds: ORIG_MED_ID, CLARITY_NAME (distinct principal ids with names)

    The three fallbacks (ingredient, component, production drug) are one join: the
    hierarchy's related-id columns are stacked into (medID, kind, related id) rows,
    joined to the unmatched ids and then to the links, and spread back into their
    own columns by kind.
    """
    rx = _links(links, nomenclature)
    direct = unique_meds.join(rx, F.col("ORIG_MED_ID") == F.col("__l_medID"), "left")
    unmatched = (direct.filter(F.col("__l_code").isNull())
                 .select("ORIG_MED_ID", "CLARITY_NAME").distinct())
    related = hierarchy.select(
        F.col("medID").alias("__h_med"),
        F.explode(F.array(*[F.struct(F.lit(v).alias("kind"), F.col(v).alias("rel"))
                            for v in VIA])).alias("__v")
    ).filter(F.col("__v.rel").isNotNull())
    via = (unmatched.join(related, F.col("ORIG_MED_ID") == F.col("__h_med"), "inner")
           .join(rx, F.col("__v.rel") == F.col("__l_medID"), "left"))
    via = via.select(
        "ORIG_MED_ID", "CLARITY_NAME",
        *[F.when(F.col("__v.kind") == v, F.col("__v.rel")).cast(id_type).alias(v) for v in VIA],
        *[F.col("__l_" + c).alias(c) for c in LINK_COLUMNS])
    out = _layout(direct, id_type, None).unionByName(via)
    return out.filter(F.col("code").isNotNull())


def unmatched_ids(principal_ids: DataFrame, matches: DataFrame) -> DataFrame:
    """Distinct principal ids (column medID) with no match row; a NULL id is kept."""
    ids = principal_ids.select("medID").distinct()
    return ids.join(matches.select(F.col("ORIG_MED_ID").alias("medID")), "medID", "left_anti")


def coverage_summary(meds: DataFrame, matches: DataFrame) -> DataFrame:
    """(DESCRIP, CNT) rows: unique principal ids, unique unmatched ids, all
    administrations, administrations of unmatched ids (a NULL id is never one).

    One pass over the administrations: they are first reduced to one row per id
    with its administration count (map-side combined, so a hot id costs nothing
    extra), then flagged against the matched ids (catalog-sized) and summed.
    """
    per_id = meds.groupBy("medID").agg(F.count(F.lit(1)).alias("__n"))
    matched = matches.select(F.col("ORIG_MED_ID").alias("__mid")).distinct()
    flagged = per_id.join(matched, F.col("medID") == F.col("__mid"), "left")
    unmatched = F.col("__mid").isNull()
    counts = flagged.agg(
        F.count(F.lit(1)).alias("a"),
        F.count(F.when(unmatched, F.lit(1))).alias("b"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("c"),
        F.coalesce(F.sum(F.when(unmatched & F.col("medID").isNotNull(), F.col("__n"))),
                   F.lit(0)).alias("d"))
    # fixed values: the four descriptions
    return counts.select(F.expr(
        "stack(4, 'All Unique Principle Med IDs', a, 'Unique Unmatched Principle Med IDs', b, "
        "'All Med Admins', c, 'Unmatched Med Admins', d) AS (DESCRIP, CNT)"))
