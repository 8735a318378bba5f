"""Unions with provenance and per-key text aggregation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tagged_union(branches: Mapping[str, DataFrame], tag_col: str = "SOURCE") -> DataFrame:
    """UNION ALL of same-shaped frames, each tagged with its branch name.

    Columns are matched by name, so every branch must produce the same names and
    types (use ``typed_null`` for the columns a branch lacks).
    """
    out = None
    for tag, df in branches.items():
        tagged = df.withColumn(tag_col, F.lit(tag))
        out = tagged if out is None else out.unionByName(tagged)
    if out is None:
        raise ValueError("tagged_union needs at least one branch")
    return out


def tagged_rows(df: DataFrame, branches: Mapping[str, Mapping[str, Column]],
                where: Mapping[str, Column] | None = None, keep: Sequence[str] = (),
                tag_col: str = "SOURCE") -> DataFrame:
    """``tagged_union`` of projections of one frame, which is read only once: every row
    becomes an array of tagged structs (of the branches whose ``where`` holds), exploded.

    All branches give the same column names and types; ``keep`` are columns of ``df``
    carried along.
    """
    where = where or {}
    made = [F.when(where.get(tag, F.lit(True)),
                   F.struct(F.lit(tag).alias(tag_col), *[c.alias(n) for n, c in cols.items()]))
            for tag, cols in branches.items()]
    rows = F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("__row")
    return df.select(*keep, rows).select(*keep, "__row.*")


def listagg_sorted(value: str, sep: str = "|") -> Column:
    """``STRING_AGG(value, sep)`` ordered by the value (deterministic), NULLs skipped.

    Duplicates are kept. Only for groups of bounded size (a patient's races), as
    the whole group's text is built in one aggregate buffer.
    """
    sep_sql = sep.replace("'", "''")
    return F.expr(f"listagg(`{value}`, '{sep_sql}') WITHIN GROUP (ORDER BY `{value}`)")
