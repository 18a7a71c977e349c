"""Tile results at rest: Parquet by tile for resuming, gzip JSON documents for exchange."""

from __future__ import annotations

import gzip
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covoxel.config import EngineConfig
from covoxel.operators.mining import Mined
from covoxel.operators.tiling import Shape, tile_grid
from covoxel.sinks.named_files import write_files
from covoxel.sources import files
from covoxel.sources.snapshots import Snapshots

NAME = r"tile_(\d{4,})_(\d{4,})\.json\.gz$"
PAIR = "tile_x int, tile_y int, r_um double, a int, b int, a_vox long, b_vox long, inter_vox long, union_vox long, iou double, overlap_coeff double"
SET = "tile_x int, tile_y int, r_um double, k int, members array<int>, inter_vox long, union_vox long, iou double, overlap_coeff double"
STATS = "tile_x int, tile_y int, channel int, r_um double, voxel_count long, sum_intensity double"
DOCUMENT = f"tile_x int, tile_y int, tile_z int, tile_shape array<int>, total_voxels long, radii_um array<double>, marker_vox map<string,map<string,long>>, n_active_channels int, n_frequent_pairs int, channel_stats array<struct<{STATS}>>, pairs array<struct<{PAIR}>>, sets array<struct<{SET}>>"


def schema() -> T.StructType:
    text = DOCUMENT
    for flat in (STATS, PAIR, SET):
        text = text.replace(f"struct<{flat}>", "struct<" + ", ".join(f"{n}: {t}" for n, t in (f.split(" ", 1) for f in flat.split(", "))) + ">")
    return T._parse_datatype_string(text)


def _with_list(docs: DataFrame, rows: DataFrame, flat: str, name: str) -> DataFrame:
    """docs with a tile's rows as the list `name`, empty if it has none."""
    cols = [f.split(" ", 1)[0] for f in flat.split(", ")]
    lists = rows.groupBy("tile_x", "tile_y").agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in cols]))).alias(name))
    return docs.drop(name).join(lists, ["tile_x", "tile_y"], "left").withColumn(name, F.coalesce(name, F.array()))


def with_combinations(docs: DataFrame, pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Documents with other pairs and sets."""
    return _with_list(_with_list(docs, pairs, PAIR, "pairs"), sets, SET, "sets").select(*docs.columns)


def documents(m: Mined, tiles: DataFrame, cfg: EngineConfig, depth: int) -> DataFrame:
    """One nested document per tile. A tile's rows are bounded by the candidate limits."""
    keys = ["tile_x", "tile_y"]
    radius = m.channel_stats.groupBy(*keys, "r_um").agg(F.map_from_entries(F.collect_list(F.struct(F.col("channel").cast("string"), F.col("voxel_count")))).alias("by"))
    marker = radius.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct(F.col("r_um").cast("string"), F.col("by")))).alias("marker_vox"))
    out = tiles.join(m.summary, keys).join(marker, keys)
    for rows, flat, name in ((m.channel_stats, STATS, "channel_stats"), (m.pairs, PAIR, "pairs"), (m.sets, SET, "sets")):
        out = _with_list(out, rows, flat, name)
    return out.select(*keys, F.lit(0).alias("tile_z"), F.array(F.lit(depth), F.lit(cfg.tile_y), F.lit(cfg.tile_x)).alias("tile_shape"), "total_voxels", F.array(*map(F.lit, cfg.dilate_um)).alias("radii_um"), "marker_vox", F.col("n_active_channels").cast("int").alias("n_active_channels"), F.col("n_frequent_pairs").cast("int").alias("n_frequent_pairs"), "channel_stats", "pairs", "sets")


def write_json(docs: DataFrame, path: str) -> None:
    """Documents as compressed JSON lines in Spark's own files, on any file system; the committer makes each file appear whole."""
    docs.write.mode("overwrite").option("compression", "gzip").json(path)


def write_tiles(docs: DataFrame, path: str, overwrite: bool = False) -> None:
    """Each document as a file of its own, tile_XXXX_YYYY.json.gz: what completed() knows. Files appear when all are written, each
    whole; an earlier document of the same tile is replaced, and with overwrite those of all other tiles go."""
    name = F.format_string("tile_%04d_%04d.json.gz", "tile_x", "tile_y")
    rows = docs.select(name.alias("name"), F.to_json(F.struct(*docs.columns)).cast("binary").alias("content"))
    write_files(rows, path, overwrite, zipped=True)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which files hold no whole documents, and why."""
    for b in batches:
        bad: list[tuple[str, str]] = []
        for path, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
            try:
                lines = gzip.decompress(content.as_py()).decode().splitlines()
                if not all({"tile_x", "tile_y"} <= json.loads(line).keys() for line in lines if line.strip()):
                    bad.append((path, "no tile numbers"))
            except (OSError, EOFError, zlib.error, ValueError, AttributeError) as e:
                bad.append((path, type(e).__name__ + ": " + str(e)[:200]))
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in bad], pa.string()) for i in (0, 1)], names=["path", "reason"])


def broken_files(spark: SparkSession, path: str) -> DataFrame:
    """path, reason: files of a folder that read_json() passes over, wholly or in part: truncated, malformed, or without tile numbers."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], "path string, reason string")
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.json.gz").load(path)
    return found.select("path", "content").mapInArrow(_checked, "path string, reason string")


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """Documents, one to a line. Truncated files and malformed lines are skipped (broken_files() lists them); of a tile that occurs twice the one in the
    last file by name counts. A missing folder has no documents."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema())
    read = spark.read.schema(schema()).option("mode", "PERMISSIVE").option("ignoreCorruptFiles", "true").option("pathGlobFilter", "*.json.gz").json(path)
    named = read.where("tile_x IS NOT NULL AND tile_y IS NOT NULL").withColumn("__file", F.input_file_name())
    cols = [c for c in read.columns if c not in ("tile_x", "tile_y")]
    latest = named.groupBy("tile_x", "tile_y").agg(F.max_by(F.struct(*cols), F.col("__file")).alias("d"))
    return latest.select("tile_x", "tile_y", "d.*")


def flat(docs: DataFrame) -> Mined:
    """channel_stats, pairs, sets and summary of documents. Members' voxel counts come from their document's marker_vox, whose keys
    are strings in the files."""
    rows = lambda c: docs.select(F.explode(c).alias("r")).select("r.*")
    stats = rows("channel_stats")

    def with_members(s: Column) -> Column:
        here = F.get(F.filter(F.map_entries("marker_vox"), lambda e: e["key"].cast("double") == s["r_um"]), F.lit(0))["value"]
        return s.withField("member_vox", F.transform(s["members"], lambda m: F.coalesce(F.try_element_at(here, m.cast("string")), F.lit(0))))

    sets = docs.select(F.explode(F.transform("sets", with_members)).alias("r")).select("r.*")
    return Mined(stats, rows("pairs"), sets, docs.select("tile_x", "tile_y", "n_active_channels", "n_frequent_pairs"))


def completed(spark: SparkSession, path: str) -> DataFrame:
    """tile_x, tile_y of files named tile_XXXX_YYYY.json.gz; other names are ignored, and a missing folder has none."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], "tile_x int, tile_y int")
    named = spark.read.format("binaryFile").option("pathGlobFilter", "tile_*.json.gz").load(path).select("path")
    found = named.select(F.regexp_extract("path", NAME, 1).alias("x"), F.regexp_extract("path", NAME, 2).alias("y")).where("x <> ''")
    return found.select(F.col("x").cast("int").alias("tile_x"), F.col("y").cast("int").alias("tile_y")).distinct()


def stats(done: DataFrame) -> DataFrame:
    """One row: n_tiles and the ranges of tile_x and tile_y, null if there are none."""
    return done.agg(F.count("*").alias("n_tiles"), *[f(c).alias(f"{n}_{c}") for c in ("tile_x", "tile_y") for n, f in (("min", F.min), ("max", F.max))])


def remaining(tiles: DataFrame, done: DataFrame) -> DataFrame:
    return tiles.join(done.select("tile_x", "tile_y"), ["tile_x", "tile_y"], "left_anti")


@dataclass(frozen=True)
class Progress:
    """Tiles done of those there are, since a start; rate and time left follow from the tiles done since then."""

    done: int
    of: int
    since: int = 0
    seconds: float = 0.0

    @property
    def per_second(self) -> float:
        return (self.done - self.since) / self.seconds if self.seconds > 0 else 0.0

    @property
    def seconds_left(self) -> float | None:
        return (self.of - self.done) / self.per_second if self.per_second else None

    def __str__(self) -> str:
        left = "unknown" if self.seconds_left is None else f"{self.seconds_left:.0f} s"
        return f"{self.done}/{self.of} tiles, {self.per_second:.2f} tiles/s, left: {left}"


class ResultStore(Snapshots):
    """Mined tiles: a tile's rows are those of the last folder that has it in its summary, so one that is mined again to fewer rows, or none,
    keeps nothing of before."""

    KEYS, INDEX = ("tile_x", "tile_y"), "summary"
    PARTS = {
        "channel_stats": "tile_x int, tile_y int, channel int, r_idx int, r_um double, voxel_count long, sum_intensity double",
        "pairs": "tile_x int, tile_y int, r_idx int, r_um double, a int, b int, a_vox long, b_vox long, inter_vox long, union_vox long, iou double, overlap_coeff double",
        "sets": "tile_x int, tile_y int, r_idx int, r_um double, k int, members array<int>, member_vox array<long>, inter_vox long, union_vox long, iou double, overlap_coeff double",
        "summary": "tile_x int, tile_y int, n_active_channels long, n_frequent_pairs long",
    }

    def write(self, m: Mined) -> int:
        """Add tiles, or replace them; how many there were."""
        return self.add({part: getattr(m, part) for part in self.PARTS})

    def read(self) -> Mined:
        return Mined(**self.frames())

    def done(self) -> DataFrame:
        return self.index()


class DocumentStore:
    """Mined tiles as a folder of documents, one file a tile, which other tools read: what names a tile is done. Voxel counts of sets'
    members are looked up in the documents when they are read back."""

    def __init__(self, spark: SparkSession, path: str, cfg: EngineConfig, shape: Shape):
        self.spark, self.path, self.cfg, self.shape = spark, path.rstrip("/"), cfg, shape

    def write(self, m: Mined) -> int:
        n = Observation()
        docs = documents(m, tile_grid(self.spark, self.shape, self.cfg), self.cfg, self.shape.z)
        write_tiles(docs.observe(n, F.count("*").alias("n")), self.path)
        return n.get["n"]

    def read(self) -> Mined:
        return flat(read_json(self.spark, self.path))

    def done(self) -> DataFrame:
        return completed(self.spark, self.path)
