"""Resolve base-table names to DataFrames.

Names are case-insensitive and may carry a database prefix (``Clarity..ORDER_PROC``),
as in the reference's scripts. A table is looked up, in order, among explicitly
registered DataFrames, a parquet directory (``<dir>/<NAME>.parquet`` or
``<dir>/<NAME>/``), a catalog database, then a JDBC source.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def normalize(name: str) -> str:
    """``Clarity..ORDER_PROC`` / ``clarity.dbo.order_proc`` -> ``ORDER_PROC``."""
    return name.replace("..", ".").split(".")[-1].strip("[]").upper()


@dataclass
class JdbcSource:
    """Caller-supplied JDBC connection. ``partitioning`` maps a table name to the
    ``partitionColumn/lowerBound/upperBound/numPartitions`` options so that big fact
    tables are read by many tasks in parallel; only tables named in ``small_tables`` may be
    read by a single one."""

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    schema: str | None = None
    partitioning: Mapping[str, Mapping[str, str]] = field(default_factory=dict)
    small_tables: frozenset[str] = frozenset()


class SourceCatalog:
    """Name -> DataFrame resolver.

    ``category_collation`` (e.g. ``"UTF8_LCASE_RTRIM"``) reproduces a
    case-insensitive, trailing-blank-insensitive database collation for the
    category tables' ``NAME`` columns, which the extracts compare with literals such as
    'Canceled' or 'Transfer In'. Only those name columns are collated, never keys.
    """

    def __init__(self, spark: SparkSession, parquet_dir: str | None = None,
                 database: str | None = None, jdbc: JdbcSource | None = None,
                 tables: Mapping[str, DataFrame] | None = None,
                 category_collation: str | None = None):
        self.spark = spark
        self.parquet_dir = parquet_dir
        self.database = database
        self.jdbc = jdbc
        self.category_collation = category_collation
        self._tables = {normalize(k): v for k, v in (tables or {}).items()}

    def register(self, name: str, df: DataFrame) -> "SourceCatalog":
        self._tables[normalize(name)] = df
        return self

    def replaced(self, tables: Mapping[str, DataFrame]) -> "SourceCatalog":
        """This catalogue with other sources for some tables."""
        return SourceCatalog(self.spark, self.parquet_dir, self.database, self.jdbc,
                             {**self._tables, **{normalize(k): v for k, v in tables.items()}},
                             self.category_collation)

    def table(self, name: str) -> DataFrame:
        key = normalize(name)
        df = self._resolve(key, name)
        if self.category_collation and key.startswith("ZC_") and "NAME" in df.columns:
            df = df.withColumn("NAME", F.collate(F.col("NAME"), self.category_collation))
        return df

    def _resolve(self, key: str, name: str) -> DataFrame:
        if key in self._tables:
            return self._tables[key]
        if self.parquet_dir:
            for cand in (key, key.lower()):
                for path in (f"{self.parquet_dir.rstrip('/')}/{cand}.parquet",
                             f"{self.parquet_dir.rstrip('/')}/{cand}"):
                    try:  # Spark's file system decides, not this machine's
                        return self.spark.read.parquet(path)
                    except AnalysisException as missing:
                        if missing.getCondition() != "PATH_NOT_FOUND":
                            raise
        if self.database:
            return self.spark.table(f"{self.database}.{key}")
        if self.jdbc:
            if key not in self.jdbc.partitioning and key not in self.jdbc.small_tables:
                raise ValueError(f"table {key} would be read by one task: give its partitioning "
                                 "or name it in small_tables")
            options = {"url": self.jdbc.url,
                       "dbtable": f"{self.jdbc.schema}.{key}" if self.jdbc.schema else key,
                       **self.jdbc.properties, **self.jdbc.partitioning.get(key, {})}
            return self.spark.read.format("jdbc").options(**options).load()
        raise KeyError(f"no source for table {name!r}")

    __getitem__ = table
