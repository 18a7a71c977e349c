"""Rows (name, content) as files of these names: df.write.format("covoxel_files").mode("append").save(folder).

Tasks write below a hidden folder; only when all have ended are the files moved to their names, so what a failed or repeated task
leaves is never seen, and a file appears whole or not at all. With the option gzip they are compressed as they are written.
"""

from __future__ import annotations

import gzip
import os
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from covoxel.sources import objects

FILES = "name string, content binary"
#: What a task's Python is handed at once; without it that would be 10,000 files. A batch ends with the file that passes the bytes.
BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20)}


@dataclass
class Written(WriterCommitMessage):
    """Where a task's attempt has put its files, and their names."""

    folder: str
    names: list[str]


class Writer(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, zipped: bool):
        self.path, self.overwrite, self.zipped = path.rstrip("/"), overwrite, zipped
        self.pending = f"{self.path}/_pending-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        folder, names = f"{self.pending}/{task.partitionId()}-{task.taskAttemptId()}", []
        for b in batches:
            for name, content in zip(b.column("name"), b.column("content"), strict=True):
                name = name.as_py()
                if not name or name.startswith(("/", "_", ".")) or ".." in name.split("/"):
                    raise ValueError(f"{name}: no name of a file")
                data = content.as_py() or b""
                objects.write(f"{folder}/{name}", gzip.compress(data, mtime=0) if self.zipped else data)
                names.append(name)
        return Written(folder, names)

    def commit(self, messages: list[Written | None]) -> None:
        done = [m for m in messages if m is not None]
        if self.overwrite:  # what was there goes only now that its successor is complete
            keep = os.path.basename(self.pending)
            for found in objects.listed(self.path):
                if found != keep:
                    objects.remove(f"{self.path}/{found}")
        for m in done:
            for name in m.names:
                objects.move(f"{m.folder}/{name}", f"{self.path}/{name}")
        objects.remove(self.pending)

    def abort(self, messages: list[Written | None]) -> None:
        objects.remove(self.pending)


class FileSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "covoxel_files"

    def schema(self) -> str:
        return FILES

    def writer(self, schema, overwrite: bool) -> Writer:
        if schema.names != ["name", "content"]:
            raise ValueError("the columns name and content are needed")
        return Writer(self.options["path"], overwrite, self.options.get("gzip") == "true")


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """BATCH for what runs meanwhile, so that the memory of a task's Python doesn't follow its number of files."""
    old = {k: spark.conf.get(k) for k in BATCH}
    try:
        for k, v in BATCH.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def write_files(rows: DataFrame, path: str, overwrite: bool = False, zipped: bool = False) -> None:
    """rows (name, content) to files below path, compressed if zipped. Names occur once; with overwrite, files that aren't among them go."""
    if not objects.can_open(path) or objects.is_web(path):
        raise ValueError(f"{path}: tasks can't write there; use a file, s3, gs or hdfs location")
    rows.sparkSession.dataSource.register(FileSink)
    with small_batches(rows.sparkSession):
        rows.select("name", "content").write.format("covoxel_files").mode("overwrite" if overwrite else "append").option("gzip", zipped).save(path)
