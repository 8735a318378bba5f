"""Published tables: versions beside each other and a manifest that names the current one.

``publish`` writes the rows to a folder of their own and then, as the last step, a manifest
with the next number; readers follow the manifest with the highest number. A publication that
fails leaves the manifests as they were, so readers keep the version before; one that succeeds
changes what readers see in a single step, and a DataFrame made before goes on reading its
own version. Manifests are created, never overwritten: of two publications at once the later
one takes the next number.

    <path>/versions/v-<id>/part-*.parquet
    <path>/manifests/<number>.json
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

#: Versions that stay: the current one and those that running readers may still hold.
KEPT_VERSIONS = 3


@dataclass(frozen=True)
class Version:
    number: int
    folder: str


class _Files:
    """The few file operations that manifests need, on the path's own file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        if not self.fs.exists(self.path(folder)):
            return []
        return sorted(s.getPath().getName() for s in self.fs.listStatus(self.path(folder)))

    def create(self, path: str, text: str) -> None:
        """A new file, complete or not at all: written aside and moved into place, which
        fails if the place is taken."""
        aside = self.path(f"{path}.{uuid.uuid4().hex[:12]}.tmp")
        out = self.fs.create(aside, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        if self.fs.exists(self.path(path)) or not self.fs.rename(aside, self.path(path)):
            self.fs.delete(aside, False)
            raise FileExistsError(path)

    def read(self, path: str) -> str:
        found = self.fs.open(self.path(path))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(found, "UTF-8")
        finally:
            found.close()

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


def published(spark: SparkSession, path: str) -> list[Version]:
    """The readable versions of a published table, oldest first."""
    files, found = _Files(spark, path), []
    for name in files.names(f"{path}/manifests"):
        number = re.fullmatch(r"(\d+)\.json", name)
        if number:
            try:
                found.append(Version(int(number[1]), json.loads(files.read(f"{path}/manifests/{name}"))["folder"]))
            except Py4JJavaError:  # removed by a publication meanwhile
                if name in files.names(f"{path}/manifests"):
                    raise
    return sorted(found, key=lambda v: v.number)


def read_published(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The current version of the table published at ``path``, or version ``number``."""
    found = [v for v in published(spark, path) if number in (None, v.number)]
    if not found:
        raise FileNotFoundError(f"nothing is published at {path}" + (f" as version {number}" if number else ""))
    return spark.read.parquet(f"{path}/versions/{found[-1].folder}")


def publish(df: DataFrame, path: str, keep: int = KEPT_VERSIONS) -> DataFrame:
    """Write ``df`` as the next version of the table at ``path`` and return it read back.

    The ``keep`` newest versions stay; older ones are removed once the new one is current,
    manifest first. ``df`` may read the version that it replaces.
    """
    if keep < 1:
        raise ValueError("the current version has to stay")
    spark = df.sparkSession
    files = _Files(spark, path)
    mark = uuid.uuid4().hex[:12]
    folder = f"v-{mark}"
    try:
        df.write.parquet(f"{path}/versions/{folder}")
    except BaseException:
        files.delete(f"{path}/versions/{folder}")
        raise
    while True:
        number = max((v.number for v in published(spark, path)), default=0) + 1
        try:
            files.create(f"{path}/manifests/{number:09d}.json", json.dumps({"folder": folder}))
            break
        except FileExistsError:  # another publication took the number
            continue
    for old in published(spark, path)[:-keep]:
        files.delete(f"{path}/manifests/{old.number:09d}.json")
        files.delete(f"{path}/versions/{old.folder}")
    return spark.read.parquet(f"{path}/versions/{folder}")
