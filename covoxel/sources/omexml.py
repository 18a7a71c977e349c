"""Channel names and voxel sizes from OME-XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covoxel.config import VoxelSize

SCHEMA = "_PhysicalSizeX double, _PhysicalSizeY double, _PhysicalSizeZ double, _SizeC int, Channel array<struct<_ID: string, _Name: string>>"


def _pixels(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("xml").schema(SCHEMA).option("rowTag", "Pixels").load(path)


def channels(spark: SparkSession, path: str) -> DataFrame:
    """channel, name; the stray character of a doubly encoded sign is removed."""
    return _pixels(spark, path).select(F.posexplode("Channel").alias("channel", "c")).select("channel", F.trim(F.replace(F.col("c._Name"), F.lit("Â"), F.lit(""))).alias("name"))


def voxel_size(spark: SparkSession, path: str) -> VoxelSize:
    row = _pixels(spark, path).select("_PhysicalSizeX", "_PhysicalSizeY", "_PhysicalSizeZ").first()
    return VoxelSize(*row)
