"""Who owns the written intermediates, and when they are removed.

A materialised intermediate is read through DataFrames, which are lazy: its folder has to
stay for as long as any DataFrame, however derived, can still be run. Every plan that reads
the folder holds the same file relation object in the JVM, so the relation owns the folder:
it is watched by a weak reference, and once the JVM has collected it, no plan can read the
folder and it is removed. Removal happens when the next intermediate is written, on
:func:`release`, and, for all that is left, at the end of the session.

An RDD made of a DataFrame does not count as a reader; keep the DataFrame beside it.
"""

from __future__ import annotations

import atexit
import contextlib

from py4j.protocol import Py4JError
from pyspark.sql import DataFrame, SparkSession

#: application id -> list of (weak reference to the relation, folder)
_OWNED: dict[str, list] = {}


def _delete(context, path: str) -> None:
    folder = context._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def owned(df: DataFrame, path: str) -> DataFrame:
    """``df``, a plain read of ``path``, which is removed when no plan reads it any more."""
    context = df.sparkSession.sparkContext
    release(df.sparkSession)
    relation = df._jdf.queryExecution().analyzed().relation()
    watched = context._jvm.java.lang.ref.WeakReference(relation)
    if context.applicationId not in _OWNED:
        _OWNED[context.applicationId] = []
        atexit.register(_end, context)
    _OWNED[context.applicationId].append((watched, path))
    return df


def held(spark: SparkSession) -> list[str]:
    """Folders of intermediates that have not been removed."""
    return [path for _, path in _OWNED.get(spark.sparkContext.applicationId, [])]


def release(spark: SparkSession, collect: bool = False) -> int:
    """Remove the intermediates that no DataFrame reads any more; how many they were.

    ``collect`` asks the JVM to collect its garbage first, which finds those that went out
    of use since it last did.
    """
    context = spark.sparkContext
    if collect:
        import gc

        gc.collect()  # Python's handles of JVM objects
        context._jvm.System.gc()
    kept, gone = [], []
    for entry in _OWNED.get(context.applicationId, []):
        (gone if entry[0].refersTo(None) else kept).append(entry)
    if gone:
        _OWNED[context.applicationId] = kept
        for _, path in gone:
            _delete(context, path)
    return len(gone)


def _end(context) -> None:
    """All intermediates of an application, at the end of its Python process. A JVM that is
    gone already leaves them to whoever owns the checkpoint folder."""
    with contextlib.suppress(Py4JError, OSError, AttributeError):
        for _, path in _OWNED.pop(context.applicationId, []):
            _delete(context, path)
