"""Helpers shared by the corpus operators: table access, words, tokenizer files, Arrow maps."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import re
import sys
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import stayflow
from stayflow.sources.sinks import materialize

__all__ = ["table", "materialize", "words", "map_arrow", "group_arrow", "tokenizer_path",
           "bounded_batches", "partitions_for", "id_text", "sent", "ship", "quoted", "free_name",
           "released_workers", "small_batches"]

#: White space of the word contracts: space and U+0009 to U+000D.
WORD = re.compile(r"[^ \t-\r]+")
#: Characters that str.split() also cuts at, although the word contracts do not.
_OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: str) -> list[str]:
    """Maximal runs of characters other than space and U+0009 to U+000D."""
    if _OTHER_SPACE.search(text) is None:
        return text.split()
    return WORD.findall(text)


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file (the default of the ``path`` parameters)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def bounded_batches(batches: Iterator[pa.RecordBatch], text: int, most: int = 8 << 20,
                    ) -> Iterator[pa.RecordBatch]:
    """Slice Arrow batches so that no slice holds more than ``most`` bytes of column ``text``
    (or a single row), which bounds what a task turns into Python objects at once."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        rows = n
        size = batch.column(text).nbytes
        if size > most:
            rows = max(1, n * most // size)
        for at in range(0, n, rows):
            yield batch.slice(at, rows)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application (it need not be
    installed there, and module-level tables stay with a worker from task to task)."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        root = Path(stayflow.__file__).parent
        path = os.path.join(tempfile.mkdtemp(prefix="stayflow-py-"), "stayflow.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
            for f in sorted(root.rglob("*.py")):
                z.write(f, str(Path(root.name, f.relative_to(root))))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)


#: Whether what is planned now lets go of its workers' tables (released_workers).
_RELEASED = False
#: Module-level tables that a worker keeps from task to task.
_TABLES = [("stayflow.llm.hashing", "_HASH"), ("stayflow.llm.packing", "_WORDS"),
           ("stayflow.llm.token_counts", "_COUNTERS")]


@contextmanager
def released_workers():
    """Python workers of what is planned inside empty their tables when a task ends and give
    the memory back, for jobs whose stages follow one another in the same workers."""
    global _RELEASED
    before, _RELEASED = _RELEASED, True
    try:
        yield
    finally:
        _RELEASED = before


#: Bytes of an Arrow batch in jobs whose stages follow one another in the same executors.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From here on, executors fill Arrow batches for Python workers with ``BATCH_BYTES`` at most
    (or one row). Up to Spark's own 64 MB, a batch of texts takes as much again while it grows,
    outside the heap, and the process keeps much of that for good."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def _let_go() -> None:
    for module, name in _TABLES:
        if module in sys.modules:
            getattr(sys.modules[module], name).clear()
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def _releasing_map(fn: Callable) -> Callable:
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            _let_go()

    return run


def map_arrow(df: DataFrame, fn: Callable, schema: str) -> DataFrame:
    """``fn`` over the Arrow batches of each partition."""
    ship(df.sparkSession)
    return df.mapInArrow(_releasing_map(fn) if _RELEASED else fn, schema)


def _releasing_group(fn: Callable) -> Callable:
    def run(tbl: pa.Table) -> pa.Table:
        found = fn(tbl)
        pa.default_memory_pool().release_unused()
        return found

    return run


def group_arrow(df: DataFrame, keys: list[str], fn: Callable, schema) -> DataFrame:
    """``fn`` over the Arrow table of each group; groups must be of bounded size."""
    ship(df.sparkSession)
    return df.groupBy(*keys).applyInArrow(_releasing_group(fn) if _RELEASED else fn, schema)


def partitions_for(spark: SparkSession, rows: int, rows_each: int) -> int:
    """Partitions that keep each at about ``rows_each`` rows, never fewer than configured."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // rows_each), 1)


#: Rows (of a few numbers each) up to which a list is sent to every executor.
SENT_ROWS = 1_000_000


def sent(rows: DataFrame) -> DataFrame:
    """``rows`` marked for broadcast if they are few (they are counted, so they should be
    materialised); a longer list is left to a shuffled join."""
    return F.broadcast(rows) if rows.count() <= SENT_ROWS else rows


def quoted(name: str) -> F.Column:
    """A column by its literal name (which may hold dots)."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns that most operators read; other columns are never scanned."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
