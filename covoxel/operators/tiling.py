"""Tiles: grid, voxel to tile, regions of the hierarchy."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covoxel.config import EngineConfig

TILE = ["tile_x", "tile_y"]


@dataclass(frozen=True)
class Shape:
    """Extent of a volume in voxels."""

    z: int
    y: int
    x: int


def tile_grid(spark: SparkSession, shape: Shape, cfg: EngineConfig) -> DataFrame:
    """Every tile, row by row, with its first and (unclipped) end voxel, shape and number of voxels."""
    nx, ny = -(-shape.x // cfg.tile_x), -(-shape.y // cfg.tile_y)
    i = F.col("id")
    tiles = spark.range(nx * ny).select((i % nx).cast("int").alias("tile_x"), F.expr(f"id div {nx}").cast("int").alias("tile_y"))
    x0, y0 = F.col("tile_x") * cfg.tile_x, F.col("tile_y") * cfg.tile_y
    return tiles.select("tile_x", "tile_y", x0.alias("x0"), (x0 + cfg.tile_x).alias("x1"), y0.alias("y0"), (y0 + cfg.tile_y).alias("y1"), F.lit(shape.z * cfg.tile_y * cfg.tile_x).cast("long").alias("total_voxels"))


def with_tiles(voxels: DataFrame, cfg: EngineConfig) -> DataFrame:
    return voxels.withColumns({"tile_x": F.expr(f"x div {cfg.tile_x}").cast("int"), "tile_y": F.expr(f"y div {cfg.tile_y}").cast("int")})


def columns_grid(spark: SparkSession, shape: Shape, cfg: EngineConfig) -> DataFrame:
    """Every (y, x) column of the volume with its tile."""
    ids = spark.range(shape.y * shape.x)
    return with_tiles(ids.select(F.expr(f"id div {shape.x}").cast("int").alias("y"), (F.col("id") % shape.x).cast("int").alias("x")), cfg)


def radii(spark: SparkSession, cfg: EngineConfig) -> DataFrame:
    """r_idx ascending, r_um, and the thresholds at each radius."""
    rows = [(i, r, cfg.at(cfg.min_marker_vox, r), cfg.at(cfg.min_support_pair, r), cfg.at(cfg.min_support_set, r)) for i, r in enumerate(cfg.dilate_um)]
    return spark.createDataFrame(rows, "r_idx int, r_um double, min_marker long, min_pair long, min_set long")


def region(level: Column, tile: str) -> Column:
    return F.call_function("shiftright", F.col(tile), level)

