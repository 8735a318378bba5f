"""Exact duplicates by a tree-merge of sorted digest runs.

Each input partition gives one run: its rows' digests, merged to one entry per digest. Runs
meet in binomial rounds: in a round, ``fan`` neighbouring runs are brought together (one
shuffle of digests, dealt by digest range so that no task holds a whole run), sorted and
merged, and every merge keeps the best row of a digest. After log_fan(runs) rounds one run
is left, still dealt by range. Only digests, lengths and ids move; texts are read once.

Every entry is verified: rows are equal only if the SHA-256, the length and a second,
independent 64-bit hash of the normalised texts all agree.

Defined results: null text counts as empty, so null, empty and white-space-only texts are
all equal; of equal texts the row with the most code points in its original text stays, then
the smallest id (a null id after all others), and of repeated rows with one id exactly one
has ``kept``. Ids may be any 64-bit numbers. Texts are hashed whole, however long, and do not
move. An empty table gives an empty table. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayflow.llm.common import materialize, table

#: Deleted before texts are compared: space and U+0009 to U+000D.
WHITE = r"[\x20\x09-\x0D]+"
#: Runs that meet in one merge.
FAN = 8

_KEY = ["sha", "second", "n_norm"]


def _best() -> Column:
    """The least is the row that stays: most code points, then smallest id (null last), then
    first place."""
    return F.struct((-F.col("n_orig")).alias("shorter"), F.col("doc_id").isNull().alias("no_id"),
                    "doc_id", "row")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of digests per document, with the run (input partition) that it came from."""
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("raw"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    norm = F.regexp_replace("text", WHITE, "")
    return text.select(
        "doc_id", F.xxhash64("doc_id", F.col("raw")).alias("key"), F.length("text").alias("n_orig"), norm.alias("norm"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
    ).select(
        "doc_id", "key", "n_orig", "run", "row", F.unhex(F.sha2("norm", 256)).alias("sha"),
        F.xxhash64("norm").alias("second"), F.length("norm").alias("n_norm"))


def merge_runs(rows: DataFrame, fan: int = FAN) -> DataFrame:
    """Merge the runs of ``rows`` (from :func:`digests`) to one row per digest:
    the key, ``best`` (of the row that stays) and ``n`` (rows with the digest)."""
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    level = rows.select(*_KEY, "run", _best().alias("best"), F.lit(1).cast("long").alias("n"))
    level = level.groupBy("run", *_KEY).agg(F.min("best").alias("best"), F.sum("n").alias("n"))
    runs = (rows.agg(F.max("run").alias("m")).first()["m"] or 0) + 1
    first_of_digest = F.conv(F.hex(F.substring("sha", 1, 4)), 16, 10).cast("long")
    while True:
        level = level.select(*_KEY, "best", "n", F.floor(F.col("run") / fan).alias("run"),
                             F.shiftright(first_of_digest * ranges, 32).alias("part"))
        level = (level.repartition(ranges, "run", "part")
                 .sortWithinPartitions("run", "part", *_KEY)
                 .groupBy("run", "part", *_KEY)
                 .agg(F.min("best").alias("best"), F.sum("n").alias("n")))
        runs = -(-runs // fan)
        if runs <= 1:
            return level.select(*_KEY, "best", "n")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                fan: int = FAN, with_key: bool = False) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of ``docs`` (and ``key``,
    xxhash64 of id and text, by which a caller finds the row again)."""
    rows = materialize(digests(docs, id_col, text_col), "digests")
    merged = merge_runs(rows, fan).select(*_KEY, "best", "n")
    return rows.join(merged, _KEY).select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), F.col("n").alias("group_size"),
        (F.col("row") == F.col("best.row")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), *["key"] * with_key)


def op9_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = first_value(doc_id) OVER w AS kept,
       sha256(norm) AS text_sha256
FROM t WINDOW w AS (PARTITION BY norm ORDER BY length(text) DESC, doc_id)
"""
