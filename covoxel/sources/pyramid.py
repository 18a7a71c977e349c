"""Multi-resolution volumes: which levels there are, and which are read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covoxel.operators.tiling import Shape

REMOTE = ("http://", "https://", "s3://", "s3a://", "gs://")  # fixed values
ROOT = "root"


def is_remote(location: str) -> bool:
    return location.startswith(REMOTE)


@dataclass(frozen=True)
class Level:
    """One resolution. key: "root" for a volume without levels, else a number as text. block: the sides (y, x) of what the
    source reads in one piece, if it has such."""

    key: str
    shape: Shape
    channels: int = 1
    block: tuple[int, int] | None = None

    @property
    def size(self) -> int:
        return self.shape.z * self.shape.y * self.shape.x * self.channels


@dataclass(frozen=True)
class Pyramid:
    location: str
    levels: tuple[Level, ...]

    def __post_init__(self) -> None:
        if not self.levels:
            raise ValueError(f"no volume at {self.location}")

    def highest(self) -> Level:
        """Level "0", else the largest."""
        return next((v for v in self.levels if v.key == "0"), None) or max(self.levels, key=lambda v: v.size)

    def lowest(self) -> Level:
        """The greatest number, else the smallest."""
        numbered = [v for v in self.levels if v.key.isdigit()]
        return max(numbered, key=lambda v: int(v.key)) if numbered else min(self.levels, key=lambda v: v.size)

    def is_multiplexed(self) -> bool:
        return self.highest().channels > 1


def choose_levels(local: Pyramid | None, remote: Pyramid | None) -> tuple[tuple[str, Level], tuple[str, Level]]:
    """((location, level) to analyse, (location, level) for global thresholds).

    Analysed is the local volume if there is one. Thresholds come from its lowest level if it has several; else from the
    remote's lowest if that has several; else from the remote's highest; else from what is analysed.
    """
    if local is None and remote is None:
        raise ValueError("a local or a remote volume is needed")
    source = local or remote
    high = (source.location, source.highest())
    if local is not None and len(local.levels) > 1:
        return high, (local.location, local.lowest())
    if remote is not None:
        return high, (remote.location, remote.lowest() if len(remote.levels) > 1 else remote.highest())
    return high, high


def read_level(spark: SparkSession, location: str, key: str = ROOT) -> DataFrame:
    """Voxels (channel, z, y, x, value) of one level, from Parquet at location or location/level=key; with tile_x and tile_y where
    rechunk() stored them, so that filters on these prune folders. They must be those of the analysis."""
    path = location if key == ROOT else f"{location.rstrip('/')}/level={key}"
    stored = spark.read.parquet(path)
    return stored.select("channel", "z", "y", "x", "value", *[c for c in ("tile_x", "tile_y") if c in stored.columns])


def open_parquet(spark: SparkSession, location: str, components: list[str] | None = None) -> Pyramid:
    """The levels stored at a location: itself, or those of level=0..6 (or the given ones) that exist."""

    def exists(path: str) -> bool:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)

    if not exists(location):
        raise FileNotFoundError(location)
    keys = [k for k in components or [str(i) for i in range(7)] if exists(f"{location.rstrip('/')}/level={k}")] or [ROOT]
    levels = []
    for key in keys:
        top = read_level(spark, location, key).agg(*[(F.max(c) + 1).cast("int") for c in ("z", "y", "x")], F.countDistinct("channel")).first()
        if top[0] is not None:
            levels.append(Level(key, Shape(top[0], top[1], top[2]), top[3]))
    return Pyramid(location, tuple(levels))


def tile_voxels(spark: SparkSession, location: str, tile_x: int, tile_y: int, channels: list[int] | None = None) -> DataFrame:
    """One tile of a volume stored by rechunk(): only its folders are read."""
    here = spark.read.parquet(location).where((F.col("tile_x") == tile_x) & (F.col("tile_y") == tile_y))
    return here.where(F.col("channel").isin(channels)) if channels else here


def roi(voxels: DataFrame, y: tuple[int, int] | None = None, x: tuple[int, int] | None = None, z: tuple[int, int] | None = None, channels: list[int] | None = None) -> DataFrame:
    """A region; with Parquet stored by rechunk() these filters prune files and row groups."""
    for axis, span in (("y", y), ("x", x), ("z", z)):
        if span:
            voxels = voxels.where(F.col(axis).between(span[0], span[1] - 1))
    return voxels.where(F.col("channel").isin(channels)) if channels else voxels


def rechunk(voxels: DataFrame, path: str, tile_y: int = 128, tile_x: int = 128) -> None:
    """Rewrite with one folder per channel and tile, so that a tile's read opens its own files only."""
    tiles = voxels.withColumns({"tile_y": F.expr(f"y div {tile_y}").cast("int"), "tile_x": F.expr(f"x div {tile_x}").cast("int")})
    by = ["channel", "tile_x", "tile_y"]
    tiles.repartition(*by).sortWithinPartitions(*by, "z", "y", "x").write.mode("overwrite").partitionBy(*by).parquet(path)
