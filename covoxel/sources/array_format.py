"""Chunked arrays as a Spark data source: spark.read.format("covoxel_arrays").load(location).

Comparisons of channel, z, y and x with numbers become ranges of chunks: no other chunk is opened. A partition is a run of chunks.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualNullSafe, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual

from covoxel.sources import objects

VOXEL = "channel int, z int, y int, x int, value double"
AXES = ("channel", "z", "y", "x")
#: Decoded bytes of the chunks of one partition, about, and partitions at most.
PARTITION_BYTES, MOST_PARTITIONS = 64 << 20, 10_000


@dataclass(frozen=True)
class Run(InputPartition):
    """Chunks of the region, by their number in it."""

    first: int
    end: int


class Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        from covoxel.sources.zarr import Array

        at = options["path"].rstrip("/")
        self.absent = tuple(int(c) for c in options.get("absent", ",".join(map(str, objects.ABSENT))).split(","))
        self.bytes = int(options.get("partitionBytes", PARTITION_BYTES))
        text = objects.read(f"{at}/.zarray", self.absent)
        if text is None:
            raise FileNotFoundError(at)
        self.array = Array.parse(at, text.decode())
        self.spans = [[0, n] for n in self.array.shape[1:]]
        self.channels: set[int] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if not self._take(f):
                yield f

    def _take(self, f: Filter) -> bool:
        """Narrow the region by a filter; whether nothing is left of it to do."""
        name = ".".join(getattr(f, "attribute", ()))
        if name not in AXES:
            return False
        if isinstance(f, IsNotNull):
            return True
        span = self.spans[AXES.index(name)]
        whole = lambda v: isinstance(v, int) and not isinstance(v, bool)
        if isinstance(f, In):
            found = {v for v in f.value if whole(v)}
            if len(found) < len(f.value):
                return False
            span[:] = max(span[0], min(found)), min(span[1], max(found) + 1)
            if name == "channel":
                self.channels = found if self.channels is None else self.channels & found
            return name == "channel"
        if not whole(getattr(f, "value", None)):
            return False
        v = f.value
        narrowed = {EqualTo: (v, v + 1), EqualNullSafe: (v, v + 1), GreaterThan: (v + 1, span[1]), GreaterThanOrEqual: (v, span[1]), LessThan: (span[0], v), LessThanOrEqual: (span[0], v + 1)}.get(type(f))
        if narrowed is None:
            return False
        span[:] = max(span[0], narrowed[0]), min(span[1], narrowed[1])
        return True

    def _chunks(self) -> list[np.ndarray]:
        """The numbers of the chunks that the region touches, by axis."""
        out = [np.arange(lo // n, -(-hi // n)) if hi > lo else np.arange(0) for (lo, hi), n in zip(self.spans, self.array.chunks[1:], strict=True)]
        if self.channels is not None:
            out[0] = out[0][np.isin(out[0], [c // self.array.chunks[1] for c in self.channels])]
        return out

    def partitions(self) -> list[Run]:
        n = prod(map(len, self._chunks()))
        each = max(1, self.bytes // max(1, prod(self.array.chunks) * np.dtype(self.array.dtype).itemsize), -(-n // MOST_PARTITIONS))
        return [Run(s, min(n, s + each)) for s in range(0, n, each)] or [Run(0, 0)]

    def read(self, partition: Run) -> Iterator[pa.RecordBatch]:
        a, chunks = self.array, self._chunks()
        spans, channels = [tuple(s) for s in self.spans], tuple(sorted(self.channels)) if self.channels is not None else ()
        for k in range(partition.first, partition.end):
            place = tuple(int(of[i]) for of, i in zip(chunks, np.unravel_index(k, [len(c) for c in chunks]), strict=True))
            raw = objects.read(f"{a.location}/{a.separator.join(map(str, (0, *place)))}", self.absent)
            if raw is not None or a.fill:
                rows = a.rows(place, a.decode(raw) if raw is not None else a.empty(), spans, channels)
                if rows.num_rows:
                    yield rows


class ArraySource(DataSource):
    """Options: path, the array's folder; absent, the web answers that mean that a chunk isn't stored (404; give 404,403 for stores that hide what is
    missing); partitionBytes."""

    @classmethod
    def name(cls) -> str:
        return "covoxel_arrays"

    def schema(self) -> str:
        return VOXEL

    def reader(self, schema) -> Reader:
        return Reader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(ArraySource)
