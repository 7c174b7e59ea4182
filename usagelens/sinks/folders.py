"""Folders of any store that Spark's Hadoop client reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _store(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    store, where = _store(spark, path)
    return store.exists(where)


def move(spark: SparkSession, source: str, target: str) -> None:
    store, where = _store(spark, source)
    if not store.rename(where, _store(spark, target)[1]):
        raise OSError(f"{source} could not be moved to {target}")


def remove(spark: SparkSession, path: str) -> None:
    store, where = _store(spark, path)
    store.delete(where, True)


def create(spark: SparkSession, path: str, text: str) -> bool:
    """A new file of one line; False, and nothing done, if there is one."""
    store, where = _store(spark, path)
    try:
        out = store.create(where, False)
    except Exception:
        if store.exists(where):
            return False
        raise
    out.write(bytearray(f"{text}\n".encode()))
    out.close()
    return True
