"""Outputs that are replaced whole: a reader finds the old version or the new one, never parts of either.

Versions stand side by side in folders of their own. Which one counts is said by one small file, the manifest, that is written under
another name and put in place by a single rename, the one step a file system does at once. A job that fails before it leaves the old
version current; its own folder is removed. Versions that are no longer current stay until `prune`, as readers may still hold them.
"""

from __future__ import annotations

import contextlib
import json
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

_MANIFEST = "_current.json"
_VERSIONS = "_versions"


class NoVersion(FileNotFoundError):
    """Nothing has been committed under this path."""


def _place(spark: SparkSession, path: str):
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(conf), p


def _versions(spark: SparkSession, path: str) -> str | None:
    jvm, place, p = _place(spark, f"{path}/{_MANIFEST}")
    if not place.exists(p):
        return None
    stream = place.open(p)
    try:
        text = jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)
    finally:
        stream.close()
    return json.loads(bytes(text).decode("utf-8"))["version"]


def current(spark: SparkSession, path: str) -> str:
    """Folder of the version that counts."""
    version = _versions(spark, path)
    if version is None:
        raise NoVersion(path)
    return f"{path}/{_VERSIONS}/{version}"


@contextlib.contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """A folder to write the new version to; it counts once the block has ended without an error.

    Of two writers the one that commits against a version it did not start from is refused: it would undo the other's work.
    """
    began = _versions(spark, path)
    version = uuid.uuid4().hex
    target = f"{path}/{_VERSIONS}/{version}"
    jvm, place, _ = _place(spark, path)
    try:
        yield target
        if _versions(spark, path) != began:
            raise RuntimeError(f"{path} was replaced by another writer")
        staged = jvm.org.apache.hadoop.fs.Path(f"{path}/_staged-{version}.json")
        stream = place.create(staged, False)
        stream.write(bytearray(json.dumps({"version": version, "replaces": began}), "utf-8"))
        stream.close()
        options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
        files.rename(staged, jvm.org.apache.hadoop.fs.Path(f"{path}/{_MANIFEST}"), options)
    except BaseException:
        place.delete(jvm.org.apache.hadoop.fs.Path(target), True)
        raise


def prune(spark: SparkSession, path: str) -> int:
    """Removes versions that do not count; the number of them. Not while readers may hold one."""
    jvm, place, folder = _place(spark, f"{path}/{_VERSIONS}")
    kept, gone = _versions(spark, path), 0
    if kept is None or not place.exists(folder):
        return 0
    for status in place.listStatus(folder):
        if status.getPath().getName() != kept:
            gone += bool(place.delete(status.getPath(), True))
    return gone
