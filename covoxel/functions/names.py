"""Channel names and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def default_names(channels: DataFrame) -> DataFrame:
    return channels.select("channel", F.concat(F.lit("ch"), F.col("channel")).alias("name"))


def channel_dimension(names: DataFrame) -> DataFrame:
    """From (channel, name): without names that contain "do not use", and the first channel of each name."""
    fair = names.where(~F.lower("name").contains("do not use"))
    first = Window.partitionBy("name").orderBy("channel")
    return fair.withColumn("n", F.row_number().over(first)).where("n = 1").drop("n")


def with_name(rows: DataFrame, names: DataFrame) -> DataFrame:
    """rows with `name`, ch<channel> where the dimension has none."""
    out = rows.join(names.select("channel", "name"), "channel", "left")
    return out.withColumn("name", F.coalesce("name", F.concat(F.lit("ch"), F.col("channel"))))


def channels_key(rows: DataFrame, names: DataFrame) -> DataFrame:
    """rows with `channels`: the members' names in order of channel number, joined by pipes.

    The dimension has one row per channel; as one map it is a single row, joined to all.
    """
    known = names.agg(F.map_from_entries(F.collect_list(F.struct("channel", "name"))).alias("__names"))
    named = F.transform(F.array_sort("members"), lambda m: F.coalesce(F.try_element_at("__names", m), F.concat(F.lit("ch"), m)))
    return rows.crossJoin(F.broadcast(known)).withColumn("channels", F.array_join(named, "|")).drop("__names")


def without_self_pairs(combinations: DataFrame) -> DataFrame:
    """Combinations whose names are all different."""
    parts = F.split("channels", r"\|")
    return combinations.where(F.size(parts) == F.size(F.array_distinct(parts)))


def tile_to_voxel(tiles: DataFrame, tile_y: int, tile_x: int) -> DataFrame:
    """Voxel coordinates of regions: bounds count base tiles at every level."""
    return tiles.withColumns({"x0": F.col("tile_x0") * tile_x, "x1": F.col("tile_x1") * tile_x, "y0": F.col("tile_y0") * tile_y, "y1": F.col("tile_y1") * tile_y})
