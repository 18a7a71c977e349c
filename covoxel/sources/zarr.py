"""Chunked array folders (array format version 2) of five axes (t, c, z, y, x), alone or as a group of levels.

Where tasks can open objects by themselves (files, web servers, s3, gs, hdfs) they are read by the data source of array_format, to which filters on the axes
come down; elsewhere by Spark's binaryFile source, for a region given beforehand. Voxels of value 0 aren't rows.
"""

from __future__ import annotations

import bz2
import json
import lzma
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import prod

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covoxel.operators.tiling import Shape
from covoxel.sinks.named_files import FILES, write_files
from covoxel.sources import array_format, objects
from covoxel.sources.array_format import VOXEL
from covoxel.sources.pyramid import ROOT, Level, Pyramid

Span = tuple[int, int]


@dataclass(frozen=True)
class Array:
    """What an array's own description says."""

    location: str
    shape: tuple[int, ...]
    chunks: tuple[int, ...]
    dtype: str
    codec: str | None
    fill: float
    order: str = "C"
    separator: str = "."

    @classmethod
    def parse(cls, location: str, text: str) -> Array:
        m = json.loads(text)
        if m.get("zarr_format") != 2 or len(m["shape"]) != 5:
            raise ValueError(f"{location}: an array of format 2 with five axes (t, c, z, y, x) is needed")
        codec = (m.get("compressor") or {}).get("id")
        if codec not in CODECS or m.get("filters"):
            raise ValueError(f"{location}: chunks compressed by {codec} or filtered can't be read here")
        return cls(location.rstrip("/"), tuple(m["shape"]), tuple(m["chunks"]), m["dtype"], codec, m.get("fill_value") or 0, m.get("order", "C"), m.get("dimension_separator", "."))

    def decode(self, raw: bytes) -> np.ndarray:
        """A chunk's first time point: (c, z, y, x)."""
        data = CODECS[self.codec](raw, prod(self.chunks) * np.dtype(self.dtype).itemsize)
        return np.frombuffer(data, dtype=np.dtype(self.dtype)).reshape(self.chunks, order=self.order)[0]

    def empty(self) -> np.ndarray:
        return np.full(self.chunks[1:], self.fill, dtype=np.dtype(self.dtype))

    def rows(self, at: tuple[int, ...], block: np.ndarray, spans: list[Span], channels: tuple[int, ...]) -> pa.RecordBatch:
        """The voxels of the chunk at a place that lie in the array and in the region."""
        place = list(np.nonzero(block))
        value = block[tuple(place)].astype(np.float64)
        place = [p + i * n for p, i, n in zip(place, at, self.chunks[1:], strict=True)]
        keep = np.logical_and.reduce([(p >= lo) & (p < hi) for p, (lo, hi) in zip(place, spans, strict=True)])
        if channels:
            keep &= np.isin(place[0], channels)
        return pa.RecordBatch.from_arrays([*(pa.array(p[keep].astype(np.int32)) for p in place), pa.array(value[keep])], names=["channel", "z", "y", "x", "value"])


def _lz4(raw: bytes, size: int) -> bytes:
    return pa.decompress(raw[4:], decompressed_size=int.from_bytes(raw[:4], "little"), codec="lz4_raw", asbytes=True)


def _zstd(raw: bytes, size: int) -> bytes:
    return pa.decompress(raw, decompressed_size=size, codec="zstd", asbytes=True)


def _short_lz(raw: bytes, size: int) -> bytes:
    """The byte-oriented LZ code of short matches. A control byte below 32 is followed by that many literals and one more; the others hold, from the
    top, three bits of the match's length less 2 and five of its distance. Length 7 is continued by bytes as long as they are 255, distance
    8191 by two bytes more."""
    out, at, control = bytearray(), 1, raw[0] & 31
    while True:
        if control < 32:
            out += raw[at : at + control + 1]
            at += control + 1
        else:
            length, back = (control >> 5) + 2, (control & 31) << 8
            if control >> 5 == 7:
                while True:
                    more, at = raw[at], at + 1
                    length += more
                    if more < 255:
                        break
            back, at = back + raw[at], at + 1
            if back == 8191:
                back, at = back + (raw[at] << 8 | raw[at + 1]), at + 2
            start = len(out) - back - 1
            if start < 0:
                raise ValueError("a match begins before its block")
            piece = out[start : start + length]
            out += (piece * -(-length // len(piece)))[:length]  # a match may reach into what it writes
        if at >= len(raw) or len(out) >= size:
            return bytes(out)
        control, at = raw[at], at + 1


def _bits_together(data: bytes, width: int) -> bytes:
    """Undo a shuffle of bits: stored are the planes of bit 0 of all elements, then of bit 1, and so on."""
    n = len(data) // width
    if n % 8:
        return data  # such blocks are stored as they are
    planes = np.unpackbits(np.frombuffer(data, np.uint8).reshape(8 * width, n // 8), axis=1, bitorder="little")
    return np.packbits(planes.T, axis=1, bitorder="little").tobytes()


def _arrow(codec: str):
    return lambda b, n: pa.decompress(b, decompressed_size=n, codec=codec, asbytes=True)


#: Codecs of a container's streams by their number.
INNER = {0: _short_lz, 1: _arrow("lz4_raw"), 2: _arrow("snappy"), 3: lambda b, n: zlib.decompress(b), 4: _zstd}


def _blosc(raw: bytes, size: int) -> bytes:
    """A container of blocks, each cut into streams of one byte position or not, shuffled by bytes or bits."""
    flags, width = raw[2], raw[3]
    total, block = (int.from_bytes(raw[i : i + 4], "little") for i in (4, 8))
    if flags & 2:
        return raw[16 : 16 + total]
    inner = INNER.get(flags >> 5)
    if inner is None:
        raise ValueError("this inner codec can't be read here")
    out = []
    for k in range(-(-total // block) if block else 0):
        here = min(block, total - k * block)
        at = int.from_bytes(raw[16 + 4 * k : 20 + 4 * k], "little")
        streams = width if not flags & 16 and width <= 16 and block // width >= 128 and here == block else 1
        data = b""
        for _ in range(streams):
            n = int.from_bytes(raw[at : at + 4], "little")
            part = raw[at + 4 : at + 4 + n]
            data += part if n == here // streams else inner(part, here // streams)
            at += 4 + n
        if flags & 4:
            whole = here // width * width
            data = _bits_together(data[:whole], width) + data[whole:]
        elif flags & 1 and width > 1:
            whole = here // width * width
            data = np.frombuffer(data[:whole], np.uint8).reshape(width, -1).T.tobytes() + data[whole:]
        out.append(data)
    return b"".join(out)


#: By the name in an array's description: a chunk's bytes from those stored and their number.
CODECS = {
    None: lambda raw, size: raw,
    "zlib": lambda raw, size: zlib.decompress(raw),
    "gzip": lambda raw, size: zlib.decompress(raw, 47),
    "bz2": lambda raw, size: bz2.decompress(raw),
    "lzma": lambda raw, size: lzma.decompress(raw),
    "zstd": _zstd,
    "lz4": _lz4,
    "blosc": _blosc,
}


def _described(spark: SparkSession, location: str, absent: tuple[int, ...] = objects.ABSENT) -> Array | None:
    """The array at a location, none if there is no description."""
    at = f"{location.rstrip('/')}/.zarray"
    if objects.can_open(at):
        raw = objects.read(at, absent)
        return None if raw is None else Array.parse(location, raw.decode())
    p = spark._jvm.org.apache.hadoop.fs.Path(at)
    files = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(p):
        return None
    stream = files.open(p)  # Spark's own sources pass over names that begin with a dot
    try:
        return Array.parse(location, spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def open_arrays(spark: SparkSession, location: str, components: list[str] | None = None, absent: tuple[int, ...] = objects.ABSENT) -> Pyramid:
    """The levels at a location: an array itself, or those of the arrays 0 to 6 (or the given ones) below that exist."""
    alone = _described(spark, location, absent)
    found = {ROOT: alone} if alone else {k: _described(spark, f"{location.rstrip('/')}/{k}", absent) for k in components or map(str, range(7))}
    return Pyramid(location, tuple(Level(k, Shape(*a.shape[2:]), a.shape[1], a.chunks[3:]) for k, a in found.items() if a))


def read_array(spark: SparkSession, location: str, key: str = ROOT, *, channels: tuple[int, ...] = (), z: Span | None = None, y: Span | None = None, x: Span | None = None, absent: tuple[int, ...] = objects.ABSENT) -> DataFrame:
    """Voxels (channel, z, y, x, value) of one level, or of a region of it: spans are first and end. A chunk that isn't
    stored holds the array's fill value. absent: the web answers that mean that."""
    at = location if key == ROOT else f"{location.rstrip('/')}/{key}"
    if not objects.can_open(at):
        return _read_files(spark, at, channels, z, y, x)
    array_format.register(spark)
    out = spark.read.format("covoxel_arrays").option("absent", ",".join(map(str, absent))).load(at)
    for axis, span in (("z", z), ("y", y), ("x", x)):
        if span:
            out = out.where((F.col(axis) >= span[0]) & (F.col(axis) < span[1]))
    return out.where(F.col("channel").isin(list(channels))) if channels else out


def _read_files(spark: SparkSession, at: str, channels: tuple[int, ...], z: Span | None, y: Span | None, x: Span | None) -> DataFrame:
    """The same from a file system that only Spark opens: one row of the plan is a chunk."""
    a = _described(spark, at)
    if a is None:
        raise FileNotFoundError(at)
    spans = [(max(0, s[0]), min(n, s[1])) if s else (0, n) for s, n in zip((None, z, y, x), a.shape[1:], strict=True)]
    chunks = [sorted({c // a.chunks[1] for c in channels}) if channels else list(range(-(-a.shape[1] // a.chunks[1])))]
    chunks += [list(range(lo // n, -(-hi // n))) if hi > lo else [] for (lo, hi), n in zip(spans[1:], a.chunks[2:], strict=True)]
    if not all(chunks):
        return spark.createDataFrame([], VOXEL)

    def every() -> DataFrame:
        """c, z, y, x of all chunks of the region."""
        out, step = spark.range(prod(map(len, chunks))), 1
        cols = []
        for name, of in reversed(list(zip("czyx", chunks, strict=True))):
            cols.append(F.get(F.array(*map(F.lit, of)) if len(of) < 1000 else F.sequence(F.lit(of[0]), F.lit(of[-1])), (F.floor(F.col("id") / step) % len(of)).cast("int")).cast("int").alias(name))
            step *= len(of)
        return out.select(*cols[::-1])

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            places = zip(*(b.column(c).to_pylist() for c in "czyx"), strict=True)
            for i, place in enumerate(places):
                raw = b.column("content")[i].as_py() if "content" in b.schema.names else None
                if raw is not None or a.fill:
                    yield a.rows(place, a.decode(raw) if raw is not None else a.empty(), spans, channels)

    full = [-(-n // c) for n, c in zip(a.shape[1:], a.chunks[1:], strict=True)]
    glob = a.separator.join(["0", *("*" if len(of) == n else "{" + ",".join(map(str, of)) + "}" for of, n in zip(chunks, full, strict=True))])
    pattern = "/" + (r"\." if a.separator == "." else "/").join([r"(\d+)"] * 5) + "$"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(f"{a.location}/{glob}")
    if len(hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(hadoop) or []):
        files = spark.read.format("binaryFile").load(f"{a.location}/{glob}").where(F.col("path").rlike(pattern))
        held = files.select(*[F.regexp_extract("path", pattern, i + 2).cast("int").alias(n) for i, n in enumerate("czyx")], "content")
    else:  # no chunk is stored
        held = spark.createDataFrame([], "c int, z int, y int, x int, content binary")
    out = held.mapInArrow(decoded, VOXEL)
    if a.fill:
        out = out.unionAll(every().join(held.select(*"czyx"), list("czyx"), "left_anti").mapInArrow(decoded, VOXEL))
    return out


def write_array(voxels: DataFrame, location: str, shape: Shape, channels: int, chunks: tuple[int, int, int, int] = (1, 64, 128, 128), dtype: str = "<u2") -> None:
    """Store voxels (channel, z, y, x, value) as a chunked array that read_array() and other tools open: one task packs a chunk, zlib
    compressed; chunks without a voxel aren't stored. The description comes last, so an array that is there is whole."""
    size = (channels, shape.z, shape.y, shape.x)
    place = [F.expr(f"{axis} div {n}").cast("int").alias(f"c_{axis}") for axis, n in zip(("channel", "z", "y", "x"), chunks, strict=True)]

    def pack(rows: pa.Table) -> pa.Table:
        block = np.zeros(chunks, dtype)
        at = [rows.column(axis).to_numpy() % n for axis, n in zip(("channel", "z", "y", "x"), chunks, strict=True)]
        block[tuple(at)] = rows.column("value").to_numpy()
        name = ".".join(str(rows.column(f"c_{axis}")[0]) for axis in ("channel", "z", "y", "x"))
        return pa.table({"name": [f"0.{name}"], "content": [zlib.compress(block.tobytes())]})

    cells = voxels.select("channel", "z", "y", "x", F.col("value").cast("double").alias("value"), *place)
    write_files(cells.groupBy("c_channel", "c_z", "c_y", "c_x").applyInArrow(pack, FILES), location, overwrite=True)
    described = {"zarr_format": 2, "shape": [1, *size], "chunks": [1, *chunks], "dtype": dtype, "compressor": {"id": "zlib", "level": 6}, "fill_value": 0, "order": "C", "filters": None, "dimension_separator": "."}
    objects.write(f"{location.rstrip('/')}/.zarray", json.dumps(described).encode())
