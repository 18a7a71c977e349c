"""Small files that the driver reads and writes, on any file system that Spark knows."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

from covoxel.sources import objects


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, store = _at(spark, path)
    return store.exists(p)


def names(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, none if it doesn't exist."""
    p, store = _at(spark, folder)
    return [f.getPath().getName() for f in store.listStatus(p)] if store.exists(p) else []


def text(spark: SparkSession, path: str) -> str:
    p, store = _at(spark, path)
    stream = store.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def remove(spark: SparkSession, path: str) -> None:
    p, store = _at(spark, path)
    store.delete(p, True)


def create(spark: SparkSession, path: str, content: str) -> bool:
    """Write a new file; false, and nothing done, if there is one of this name. Of several that try at once one succeeds: on local and mounted
    file systems by a hard link, which can't replace anything; elsewhere as far as the store's create-if-absent is atomic, as hdfs's."""
    if (local := objects.local_path(path)) is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        draft = f"{os.path.dirname(local)}/.{uuid.uuid4().hex}"
        with open(draft, "w") as f:
            f.write(content)
        try:
            os.link(draft, local)
        except FileExistsError:
            return False
        finally:
            os.remove(draft)
        return True
    p, store = _at(spark, path)
    if store.exists(p):
        return False
    stream = store.create(p, False)
    try:
        stream.write(bytearray(content.encode()))
    finally:
        stream.close()
    return True
