"""The extract sinks on the driver tables: write, overwrite, read back."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.plans.testdata_common import _read
from stayflow.session import checkpoint_dir
from stayflow.sources.sinks import read_extract, write_extract

# quotes, separators, line ends, empty strings, NULLs, decimals and timestamps
_ROWS = """
SELECT o_orderkey AS id, o_orderdate AS placed, o_totalprice AS price,
  CASE o_orderstatus WHEN 'F' THEN '' WHEN 'P' THEN NULL
       ELSE CONCAT('"', o_orderpriority, '", x', {newline}, 'é') END AS note,
  o_orderpriority AS priority
FROM {orders}"""


def _roundtrip(spark, d: str, fmt: str) -> DataFrame:
    rows = spark.sql(_ROWS.replace("{newline}", "'\\n'"), orders=_read(spark, d, "orders"))
    out = os.path.join(checkpoint_dir(spark), f"stayflow-sink-{uuid.uuid4().hex[:12]}")
    # the second write replaces the first, half as long
    write_extract(rows.filter(F.col("id") % 2 == 0), "extract", out, fmt)
    path = write_extract(rows, "extract", out, fmt, order_by=["placed", "id"])
    return read_extract(spark, path, schema=", ".join(f"{n} {t}" for n, t in rows.dtypes), fmt=fmt)


QUERIES = {
    "csv_roundtrip": lambda spark, d: _roundtrip(spark, d, "csv"),
    "parquet_roundtrip": lambda spark, d: _roundtrip(spark, d, "parquet"),
}
_SQL = _ROWS.replace("{newline}", "chr(10)").format(orders="orders")
ORACLE = {"csv_roundtrip": _SQL, "parquet_roundtrip": _SQL}
