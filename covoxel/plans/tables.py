"""The published result tables: metadata, combinations, tiles, channel_stats."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covoxel.config import EngineConfig
from covoxel.functions.names import channels_key, with_name
from covoxel.operators import rollup
from covoxel.operators.mining import Mined
from covoxel.operators.tiling import Shape

Hold = Callable[[DataFrame], DataFrame]
TABLES = ("metadata", "combinations", "tiles", "channel_stats")


def roll_up(m: Mined, cfg: EngineConfig) -> tuple[DataFrame, DataFrame, DataFrame]:
    return rollup.rollup_channels(m.channel_stats, cfg), rollup.rollup_pairs(m.pairs, cfg), rollup.rollup_sets(m.sets, cfg)


def result_tables(m: Mined, names: DataFrame, shape: Shape, cfg: EngineConfig, hold: Hold, only: tuple[str, ...] = TABLES) -> dict[str, DataFrame]:
    """The published tables of mined tiles, or some of them, for which nothing else is rolled up. No voxel is needed: names (channel, name) are those of the
    channels, shape that of the volume, or of its tiles."""
    channels, pairs, sets = roll_up(m, cfg)
    made = {}
    if {"metadata", "channel_stats"} & set(only):
        channels = hold(channels)
        made["channel_stats"] = channel_stats_table(channels, names)
    if {"metadata", "combinations", "tiles"} & set(only):
        pairs, sets = hold(pairs), hold(sets)
    if {"combinations", "tiles"} & set(only):
        rows = combination_rows(pairs, sets, names, hold)
        made |= {"combinations": combinations_table(rows), "tiles": tiles_table(rows)}
    if "metadata" in only:
        made["metadata"] = metadata_table(pairs.sparkSession, names, rollup.hierarchy(channels, pairs, sets, cfg), list(cfg.dilate_um), shape)
    return {name: made[name] for name in only}


def combination_rows(pairs: DataFrame, sets: DataFrame, names: DataFrame, hold: Hold) -> DataFrame:
    """Pairs and sets of all levels as one frame with `id`. The number has no meaning beyond linking tables; it follows
    level, size, region, radius and members. Ids are dealt in one ordering pass over the rolled-up rows: ranges are
    sorted in parallel, counted, and numbered from their offsets, so no task holds all rows. The ranges are held before they are counted:
    planned a second time they would have other bounds, which come from a sample, and AQE would join others of them."""
    two = pairs.withColumns({"members": F.array("a", "b"), "k": F.lit(2)})
    cols = ["hierarchy_level", "region_x", "region_y", "members", "k", "r_um", "inter_vox", "union_vox", "iou", "overlap_coeff", "tile_x0", "tile_x1", "tile_y0", "tile_y1"]
    every = channels_key(two.select(*cols).unionByName(sets.select(*cols)), names)
    order = ["hierarchy_level", "k", "region_x", "region_y", "r_um", "members"]
    ranged = every.repartitionByRange(*order).sortWithinPartitions(*order).withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()})
    in_part = hold(ranged.withColumn("in_part", F.col("at").bitwiseAND((1 << 33) - 1) + 1).drop("at"))
    before, offsets = 0, []
    for r in in_part.groupBy("part").agg(F.max("in_part").alias("n")).orderBy("part").collect():  # one row per range
        offsets.append((r.part, before))
        before += r.n
    starts = in_part.sparkSession.createDataFrame(offsets, "part int, before long")
    return in_part.join(F.broadcast(starts), "part").withColumn("id", F.col("before") + F.col("in_part")).drop("part", "in_part", "before")


def combinations_table(rows: DataFrame) -> DataFrame:
    return rows.select("id", "channels", F.col("k").alias("channel_count"), F.col("r_um").alias("dilation"), "hierarchy_level", F.col("inter_vox").alias("total_count"), F.col("union_vox").alias("total_union"), "iou", "overlap_coeff")


def tiles_table(rows: DataFrame) -> DataFrame:
    """Exactly one row for each combination."""
    return rows.select(F.col("id").alias("combination_id"), "tile_x0", "tile_x1", "tile_y0", "tile_y1", F.col("inter_vox").alias("inter_count"), F.col("union_vox").alias("union_count"))


def channel_stats_table(channels: DataFrame, names: DataFrame) -> DataFrame:
    named = with_name(channels, names)
    return named.select(F.col("name").alias("channel"), F.col("channel").alias("channel_idx"), F.col("r_um").alias("dilation"), "hierarchy_level", "tile_x0", "tile_x1", "tile_y0", "tile_y1", "voxel_count", "sum_intensity", "mean_intensity")


def metadata_table(spark: SparkSession, names: DataFrame, hierarchy: DataFrame, radii: list[float], shape: Shape) -> DataFrame:
    """Four JSON values: channels, hierarchy_levels, dilation_amounts, volume_bounds."""
    one = lambda key, frame: frame.select(F.lit(key).alias("key"), F.to_json("v").alias("value"))
    chans = names.agg(F.transform(F.array_sort(F.collect_list(F.struct("channel", "name"))), lambda s: s["name"]).alias("v"))
    levels = hierarchy.agg(F.array_sort(F.collect_list(F.struct("level", "tile_size_x", "tile_size_y", "n_channels", "n_pairs", "n_sets"))).alias("v"))
    dil = spark.range(1).select(F.array(*map(F.lit, radii)).alias("v"))
    span = lambda n: F.array(F.lit(0), F.lit(n))
    box = spark.range(1).select(F.struct(span(shape.z).alias("z"), span(shape.y).alias("y"), span(shape.x).alias("x")).alias("v"))
    return one("channels", chans).unionByName(one("hierarchy_levels", levels)).unionByName(one("dilation_amounts", dil)).unionByName(one("volume_bounds", box))


def register_views(tables: dict[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
