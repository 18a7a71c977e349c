"""What the corpus operators share: scratch tables, word rules, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def scratch_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share, from spark.checkpoint.dir.

    Only where that is unset, as in tests on one machine, a temporary folder is made and set.
    """
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = "file://" + tempfile.mkdtemp(prefix="covoxel-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def stored(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write df to a new folder below scratch_root() and read it back: this cuts the lineage, and
    what was computed outlives the executors that computed it."""
    spark = df.sparkSession
    at = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(at)
    out = spark.read.schema(df.schema).parquet(at)
    out._stored_at = at
    return out


def stored_by(df: DataFrame, name: str, column: str, buckets: int, codec: str = "zstd") -> DataFrame:
    """As stored(), in buckets by a column: what groups or joins by it needs no exchange of this table, if its other side
    has as many partitions."""
    spark, label = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    at = f"{scratch_root(spark)}/{label}"
    df.write.format("parquet").option("compression", codec).option("path", at).bucketBy(buckets, column).saveAsTable(label)
    out = spark.table(label)
    out._stored_at, out._stored_as = at, label
    return out


def forget(*tables: DataFrame) -> None:
    """Delete tables that stored() or stored_by() has written and that nothing will read again."""
    for df in tables:
        if hasattr(df, "_stored_as"):
            df.sparkSession.sql(f"DROP TABLE {df._stored_as}")
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df._stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def reclaim(spark: SparkSession) -> None:
    """Have shuffle files that no frame refers to any more removed now: Spark finds them when the driver collects its
    garbage, which a driver with little to do seldom does. The scheduler remembers its last job: so there is one more."""
    spark.range(1).count()
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches in runs of a few rows, so that a task's Python objects stay small; then what they held goes back to
    the system, since a worker outlives its task."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    trim()


def trim() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every system library has it
        ctypes.CDLL(None).malloc_trim(0)


#: Bytes of text whose words are found at a time.
PIECE = 1 << 20
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_P = np.uint64(0x9E3779B97F4A7C15)


def mix(z: np.ndarray) -> np.ndarray:
    """Numbers whose bits all depend on all bits of the given ones, one to one."""
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        return tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, p, np.uint64)])) for p in (_P, inverse))


@cache
def _tables() -> tuple[np.ndarray, ...]:
    codes = np.arange(256)
    return (codes == 32) | ((codes >= 9) & (codes <= 13)), mix(np.arange(1, 257, dtype=np.uint64) * _P), *_powers(PIECE + 4096)


def word_hashes(raw: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The words of a text, runs of bytes other than ASCII white space, piece by piece: where each starts, and a 64-bit
    hash of its bytes. A piece ends between words, so any long text takes little memory."""
    at = 0
    while at < len(raw):
        gap = _SPACE.search(raw, at + PIECE) if at + PIECE < len(raw) else None
        end = gap.start() if gap else len(raw)
        is_space, of_byte, up, down = _tables()
        a = np.frombuffer(raw, dtype=np.uint8, count=end - at, offset=at)
        space = np.ones(len(a) + 2, dtype=bool)
        space[1:-1] = is_space[a]
        edge = np.flatnonzero(space[1:] != space[:-1])
        if len(a) >= len(up):  # a word longer than a piece
            up, down = _powers(len(a))
        with np.errstate(over="ignore"):
            run = np.zeros(len(a) + 1, np.uint64)
            np.cumsum(of_byte[a] * up[: len(a)], out=run[1:])
            first, last = edge[::2], edge[1::2]
            yield first + at, mix((run[last] - run[first]) * down[first] + (last - first).astype(np.uint64))
        at = end


def row_key(*cols: str) -> Column:
    """128 bits (two longs) that tell rows apart by the given columns; nulls count as values."""
    parts = [x for c in cols for x in (F.col(c).isNull(), F.col(c))]
    return F.struct(F.xxhash64(F.lit(1), *parts).alias("k1"), F.xxhash64(F.lit(2), *parts).alias("k2"))


def crc_of_id(c: str = "doc_id") -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(c).cast("string"), F.lit("")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over the links, for every node in a link.

    Alternating large-star and small-star rounds (Kiveris et al., SoCC 2014) with pre-aggregated
    minima; each round is written to the shared folder, so no lineage grows and no list of neighbours
    is gathered in one task. It ends when a round changes nothing. Self-links give components of one.
    """
    links = edges.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")
    now = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    nodes = stored(now.select(F.explode(F.array("u", "v")).alias("node")).distinct(), "cc")
    while True:
        both = now.union(now.select("v", "u")).toDF("u", "v")
        # Minima are written before they are joined: AQE splits the join of a hub only if no aggregate feeds it.
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")), "cc")
        # Large star: every larger neighbour of u hangs on u's smallest neighbour.
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = stored(large.where("u > v").distinct(), "cc")
        # Small star: u and its smaller neighbours hang on the smallest of them.
        floor = stored(down.groupBy("u").agg(F.min("v").alias("m")), "cc")
        small = down.join(floor, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").union(floor.select("u", F.col("m").alias("v"))).distinct()
        new = stored(small, "cc")
        forget(low, down, floor)
        sign = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if sign(new) == sign(now):
            break
        forget(now)
        now = new
    return nodes.join(now.toDF("node", "root"), "node", "left").select("node", F.coalesce("root", "node").alias("component"))
