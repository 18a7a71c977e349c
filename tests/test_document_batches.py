"""Tile documents are handed to Python in batches bounded by bytes, however many a task has, and come back whole."""

import gzip
import os
import uuid

import pytest
from pyspark.sql import functions as F

from covoxel.sinks import named_files


@pytest.fixture
def sizes(spark, tmp_path, monkeypatch):
    """Bytes of the files of each batch that a writer gets, written by the tasks to a folder."""
    seen = tmp_path / "seen"
    seen.mkdir()

    folder = str(seen)

    class Seen(named_files.Writer):
        def write(self, batches):
            def noted():
                for b in batches:
                    with open(f"{folder}/{uuid.uuid4().hex}", "w") as f:
                        f.write(str(sum(len(x.as_py()) for x in b.column("content"))))
                    yield b

            return named_files.Writer.write(self, noted())

    FileSink = named_files.FileSink

    class Sink(named_files.FileSink):
        def writer(self, schema, overwrite):
            out = FileSink.writer(self, schema, overwrite)
            out.__class__ = Seen
            return out

    monkeypatch.setattr(named_files, "FileSink", Sink)
    return lambda: [int(f.read_text()) for f in seen.iterdir()]


def test_batches_of_files_are_bounded_by_bytes(spark, tmp_path, sizes):
    settings = ["spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch"]
    before = {k: spark.conf.get(k) for k in settings}
    n, each = 600, 20_000
    rows = spark.range(0, n, 1, 1).select(F.format_string("f%04d.gz", "id").alias("name"), F.repeat(F.format_string("%04d", "id"), each // 4).cast("binary").alias("content"))
    named_files.write_files(rows, f"file://{tmp_path}/out", zipped=True)
    got = sizes()
    assert sum(got) == n * each and max(got) <= (4 << 20) + (1 << 20)
    files = sorted(os.listdir(tmp_path / "out"))
    assert files == [f"f{i:04d}.gz" for i in range(n)]
    assert all(gzip.decompress((tmp_path / "out" / f).read_bytes()) == f[1:5].encode() * (each // 4) for f in files)
    assert {k: spark.conf.get(k) for k in settings} == before
