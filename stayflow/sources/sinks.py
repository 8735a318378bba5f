"""Writing extracts and materialising reused intermediates.

Extracts are written as CSV (the reference's hand-saved files) or parquet, always in
overwrite mode (the reference drops and recreates every table). Reused intermediates
(the published cohort, the administration set read four times) are written to the
shared checkpoint folder and read back, which cuts lineage: a lost executor then
recomputes from that file instead of from the base tables. A published table
(:func:`publish`) is replaced version by version, so readers never see half of one.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame

from stayflow.session import checkpoint_dir
from stayflow.sources.intermediates import owned
from stayflow.sources.published import publish, published, read_published

__all__ = ["write_extract", "read_extract", "publish", "read_published", "published", "materialize"]

CSV_OPTIONS = {
    "header": "true",
    "escape": '"',          # RFC-4180 quoting ("" inside quotes), not backslashes
    "nullValue": "NULL",
    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSS",
    "timestampFormat": "yyyy-MM-dd HH:mm:ss.SSS",
    "dateFormat": "yyyy-MM-dd",
}


def write_extract(df: DataFrame, name: str, out_dir: str, fmt: str = "csv",
                  order_by: list[str] | None = None, single_file: bool = False) -> str:
    """Write one extract to ``<out_dir>/<name>`` and return the path.

    ``order_by`` sorts the output (a range-partitioned global sort, so files are in
    order); ``single_file`` is for small reports only (it funnels through one task).
    """
    path = os.path.join(out_dir, name)
    if order_by:
        df = df.orderBy(*order_by)
    if single_file:
        df = df.coalesce(1)
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer.options(**CSV_OPTIONS).csv(path)
    elif fmt == "parquet":
        writer.parquet(path)
    else:
        writer.format(fmt).save(path)
    return path


def read_extract(spark, path: str, schema: str | None = None, fmt: str = "csv") -> DataFrame:
    if fmt == "csv":
        # values may hold line ends; a part file is then read by one task
        reader = spark.read.options(**CSV_OPTIONS).option("multiLine", "true")
        if schema:
            reader = reader.schema(schema)
        return reader.csv(path)
    return spark.read.format(fmt).load(path)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the session's shared checkpoint folder and return it read back
    (lineage cut). The folder belongs to the DataFrames that read it: it is removed when no
    DataFrame's plan refers to it any more, and at the session's end (:mod:`.intermediates`)."""
    base = checkpoint_dir(df.sparkSession)
    path = os.path.join(base, f"stayflow-{name}-{uuid.uuid4().hex[:12]}")
    df.write.parquet(path)
    return owned(df.sparkSession.read.parquet(path), path)
