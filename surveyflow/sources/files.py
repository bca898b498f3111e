"""Small files next to the data, by the file system that Spark itself uses."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def listing(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, size and time of every file below a path: what tells whether a table has changed."""
    system, root = _resolve(spark, path)
    files = system.listFiles(root, True)
    found = []
    while files.hasNext():
        status = files.next()
        found.append((status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return tuple(sorted(found))


def names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; none if there is no such folder."""
    system, root = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(root)) if system.exists(root) else []


def write_once(spark: SparkSession, path: str, text: str) -> None:
    """A file that appears whole or not at all: written aside and renamed."""
    aside = f"{path}.{uuid.uuid4().hex}.tmp"
    system, temporary = _resolve(spark, aside)
    stream = system.create(temporary, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if not system.rename(temporary, _resolve(spark, path)[1]):
        system.delete(temporary, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())


def remove(spark: SparkSession, path: str) -> None:
    system, where = _resolve(spark, path)
    system.delete(where, True)
