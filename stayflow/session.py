"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every plan relies on. Time zone: the boundary date differences are
# zone-free, but CSV/ISO rendering of zoned timestamps is not, so UTC is pinned.
_REQUIRED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Plans that reuse cached or materialised intermediates several times can have
    # very long plan strings; AQE renders them on every stage update.
    "spark.sql.maxPlanStringLength": "2000000",
}


def get_session(master: str | None = None, app_name: str = "stayflow",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Return (or create) a session with the settings the plans assume.

    On a cluster the master and sizing come from ``spark-submit``; ``master`` is only
    for local runs and tests. ``shuffle_partitions`` should be sized so one shuffle
    partition is ~128-256 MB at the target scale (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_REQUIRED)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    for k, v in _REQUIRED.items():
        spark.conf.set(k, v)
    return spark


_RUN_FOLDERS: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates.

    Uses the folder of the current run (:func:`run_folder`), else the cluster's
    ``spark.checkpoint.dir``. Only where neither is set and Spark runs in this process
    alone (local runs, tests) a private folder under the system temp dir is made; on a
    cluster its executors could not see one another's files there, so that is an error.
    """
    context = spark.sparkContext
    if context.applicationId in _RUN_FOLDERS:
        return _RUN_FOLDERS[context.applicationId]
    path = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not re.fullmatch(r"local(\[.*\])?", context.master):
        raise RuntimeError("intermediates need a folder that all executors share: set "
                           "spark.checkpoint.dir or call setCheckpointDir")
    path = os.path.join(tempfile.gettempdir(), f"stayflow-ckpt-{uuid.uuid4().hex[:8]}")
    context.setCheckpointDir(path)
    return path


@contextmanager
def run_folder(spark: SparkSession):
    """Intermediates made inside go to one folder of their own, removed at the end; what
    still reads them must be written out before."""
    context = spark.sparkContext
    path = os.path.join(checkpoint_dir(spark), f"stayflow-run-{uuid.uuid4().hex[:12]}")
    before = _RUN_FOLDERS.get(context.applicationId)
    _RUN_FOLDERS[context.applicationId] = path
    try:
        yield path
    finally:
        if before is None:
            del _RUN_FOLDERS[context.applicationId]
        else:
            _RUN_FOLDERS[context.applicationId] = before
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
