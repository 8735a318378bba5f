"""Fact tables laid out for the extracts: bucketed by the key that they are joined on.

The extracts restrict every fact to the cohort (by encounter, or by the record or order that
belongs to one) and join it to others on the same key. From a flat scan such a join moves the
whole fact; from a table bucketed and sorted by that key only the other side is moved, to the
fact's buckets. Laying out costs one shuffle of each fact, once, for all extracts after it.
"""

from __future__ import annotations

import warnings
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayflow.operators.stays import hot_keys
from stayflow.sources.catalog import SourceCatalog, normalize

#: Facts of the extracts and the key that they are joined on.
FACT_KEYS: Mapping[str, str] = {
    "CLARITY_ADT": "PAT_ENC_CSN_ID", "PAT_ENC_HSP": "PAT_ENC_CSN_ID", "PAT_ENC": "PAT_ENC_CSN_ID",
    "PAT_ENC_DX": "PAT_ENC_CSN_ID", "PAT_ENC_HOSP_PROB": "PAT_ENC_CSN_ID",
    "F_ED_ENCOUNTERS": "PAT_ENC_CSN_ID", "ORDER_RESULTS": "PAT_ENC_CSN_ID",
    "ORDER_MED": "PAT_ENC_CSN_ID", "MAR_ADMIN_INFO": "ORDER_MED_ID",
    "IP_FLWSHT_REC": "INPATIENT_DATA_ID", "IP_FLWSHT_MEAS": "FSD_ID",
}

#: A key that fills more than so many ordinary buckets leaves its table unbucketed.
HOT_BUCKETS = 4


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as ``table`` in ``buckets`` buckets by ``key``, sorted, one file each.

    A key whose rows would fill HOT_BUCKETS buckets would make one task of each later join as
    long; such a table is written plain (with a warning), where adaptive joins can split it.
    """
    spark = df.sparkSession
    if buckets <= HOT_BUCKETS or hot_keys(df, key, max(1, HOT_BUCKETS * df.count() // buckets)).isEmpty():
        # the writer's buckets are the hash partitions of as many partitions
        df.repartition(buckets, F.col(key)).write.mode("overwrite").format("parquet").bucketBy(
            buckets, key).sortBy(key).saveAsTable(table)
    else:
        warnings.warn(f"{table}: one {key} holds the rows of more than {HOT_BUCKETS} buckets; "
                      "not bucketed", stacklevel=2)
        df.write.mode("overwrite").format("parquet").saveAsTable(table)
    return spark.table(table)


def lay_out(src: SourceCatalog, database: str, buckets: int,
            keys: Mapping[str, str] = FACT_KEYS) -> SourceCatalog:
    """A catalogue that reads the facts of ``src`` from bucketed tables in ``database`` (which
    must exist, in a warehouse that the cluster shares) and everything else from ``src``.
    ``buckets`` should make a bucket of the largest fact some hundred MB; facts that ``src``
    does not have are left out."""
    tables = {}
    for name, key in keys.items():
        try:
            fact = src.table(name)
        except KeyError:
            continue
        tables[name] = write_bucketed(fact, f"{database}.{normalize(name)}", key, buckets)
    return src.replaced(tables)
