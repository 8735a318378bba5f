"""Fixed-depth expansion of a medication into its related medication ids.

One edge table holds every one-to-many relation of a medication (ingredient, mixture
component, production drug), tagged by kind. A list of allowed paths of one or two kinds
says what is followed, and which columns of the result a path fills:

  principal -> ingredient | component | production
  principal -> ingredient -> ingredient       (the last ingredient)
  principal -> component  -> ingredient       (keeps the component id and type)
  principal -> production -> component        (keeps the production id)

Depth is deliberately not recursive. The edges are catalog-sized; all paths of a length are
followed by one join, and the rows are de-duplicated once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.functions.expr import typed_null
from stayflow.operators.joins import lookup

HIERARCHY_COLUMNS = ["medID", "proxyMedID", "componentMedID", "productionMedID",
                     "line", "componentType"]


@dataclass(frozen=True)
class EdgeSpec:
    """A relation: its table's source and target columns, and the output column of targets."""

    kind: str
    source: str
    target: str
    output: str
    typed: bool = False     # carries a component type


EDGES = (EdgeSpec("ingredient", "MEDICATION_ID", "INGRED_ID", "proxyMedID"),
         EdgeSpec("component", "MEDICATION_ID", "DRUG_ID", "componentMedID", typed=True),
         EdgeSpec("production", "MEDICATION_ID", "DRUG_PRODUCTION_ID", "productionMedID"))

#: Second steps allowed after a first one, and whether the first target stays in the result.
SECOND = {("ingredient", "ingredient"): False, ("component", "ingredient"): True,
          ("production", "component"): True}


def edge_table(tables: dict[str, DataFrame], component_types: DataFrame | None,
               id_type: str, line_type: str) -> DataFrame:
    """kind, source, target, line, type of every relation of ``EDGES``."""
    rows = []
    for e in EDGES:
        df = tables[e.kind]
        name = typed_null("string")
        if e.typed and component_types is not None:
            df = lookup(df, component_types, {"TYPE_C": "DISP_CTYPE_C"}, {"NAME": "__type"})
            name = F.col("__type")
        rows.append(df.select(
            F.lit(e.kind).alias("kind"), F.col(e.source).cast(id_type).alias("source"),
            F.col(e.target).cast(id_type).alias("target"), F.col("LINE").cast(line_type).alias("line"),
            name.alias("type")))
    return reduce(DataFrame.unionByName, rows)


def expand_hierarchy(principal: DataFrame, ingredients: DataFrame, components: DataFrame,
                     productions: DataFrame, component_types: DataFrame | None = None,
                     id_type: str = "bigint", line_type: str = "int") -> DataFrame:
    """Distinct (medID, proxyMedID, componentMedID, productionMedID, line, componentType).

    principal:       medID (NULL allowed: it survives only as its own row)
    ingredients:     MEDICATION_ID, INGRED_ID, LINE
    components:      MEDICATION_ID, DRUG_ID, LINE, TYPE_C
    productions:     MEDICATION_ID, DRUG_PRODUCTION_ID, LINE
    component_types: DISP_CTYPE_C, NAME

    The line is the last step's; the type is that of the component on the path.
    """
    edges = edge_table({"ingredient": ingredients, "component": components,
                        "production": productions}, component_types, id_type, line_type)
    med = principal.select(F.col("medID").cast(id_type).alias("medID")).distinct()
    one = med.join(edges.select(F.col("source").alias("medID"), F.col("kind").alias("k1"),
                                F.col("target").alias("t1"), "line", "type"), "medID")
    allowed = F.array(*[F.concat_ws(">", F.lit(a), F.lit(b)) for a, b in SECOND])
    two = one.drop("line").join(
        edges.select(F.col("source").alias("t1"), F.col("kind").alias("k2"),
                     F.col("target").alias("t2"), "line", F.col("type").alias("type2")), "t1")
    two = two.filter(F.array_contains(allowed, F.concat_ws(">", "k1", "k2")))

    def placed(steps: list[tuple[Column, Column, Column]]) -> list[Column]:
        """The output columns: a target goes to its kind's column if its step is kept."""
        out = []
        for e in EDGES:
            hits = [F.when(keep & (kind == e.kind), target) for kind, target, keep in steps]
            out.append(F.coalesce(*hits).cast(id_type).alias(e.output))
        return out

    stays = F.concat_ws(">", "k1", "k2").isin([f"{a}>{b}" for (a, b), keep in SECOND.items() if keep])
    every = F.lit(True)
    none = typed_null(id_type)
    branches = [
        med.select("medID", *[none.alias(e.output) for e in EDGES],
                   typed_null(line_type).alias("line"), typed_null("string").alias("componentType")),
        one.select("medID", *placed([(F.col("k1"), F.col("t1"), every)]), "line",
                   F.col("type").alias("componentType")),
        two.select("medID", *placed([(F.col("k1"), F.col("t1"), stays), (F.col("k2"), F.col("t2"), every)]),
                   "line", F.coalesce("type2", "type").alias("componentType")),
    ]
    return reduce(DataFrame.unionByName, branches).select(*HIERARCHY_COLUMNS).distinct()
