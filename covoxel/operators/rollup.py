"""Power-of-two roll-up of tile results. All measures are sums over base tiles; ratios are computed from the sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covoxel.config import EngineConfig
from covoxel.operators.mining import ratio

REGION = ["hierarchy_level", "region_x", "region_y"]


def regions(rows: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Each row once per level, with its region. Levels are few; the sums are made before the shuffle."""
    level = F.explode(F.sequence(F.lit(0), F.lit(cfg.hierarchy_levels - 1)))
    out = rows.withColumn("hierarchy_level", level)
    shift = lambda c: F.call_function("shiftright", F.col(c), F.col("hierarchy_level"))
    return out.withColumns({"region_x": shift("tile_x"), "region_y": shift("tile_y")})


def bounds(rows: DataFrame) -> DataFrame:
    """Region bounds in base tiles, the end exclusive and not clipped."""
    scale = F.call_function("shiftleft", F.lit(1), F.col("hierarchy_level"))
    x0, y0 = F.col("region_x") * scale, F.col("region_y") * scale
    return rows.withColumns({"tile_x0": x0, "tile_x1": x0 + scale, "tile_y0": y0, "tile_y1": y0 + scale})


def rollup_channels(stats: DataFrame, cfg: EngineConfig) -> DataFrame:
    out = regions(stats, cfg).groupBy(*REGION, "channel", "r_um").agg(F.sum("voxel_count").alias("voxel_count"), F.sum("sum_intensity").alias("sum_intensity"))
    return channel_measures(out)


def channel_measures(sums: DataFrame) -> DataFrame:
    return bounds(sums).withColumn("mean_intensity", ratio(F.col("sum_intensity"), F.col("voxel_count")))


def pair_measures(sums: DataFrame) -> DataFrame:
    return bounds(sums).withColumns({"iou": ratio(F.col("inter_vox"), F.col("union_vox")), "overlap_coeff": ratio(F.col("inter_vox"), F.least("a_vox", "b_vox"))})


def set_measures(sums: DataFrame) -> DataFrame:
    return bounds(sums).withColumns({"iou": ratio(F.col("inter_vox"), F.col("union_vox")), "overlap_coeff": ratio(F.col("inter_vox"), F.array_min("member_vox"))})


def rollup_pairs(pairs: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Sums cover only tiles in which the pair has a row."""
    out = regions(pairs, cfg).groupBy(*REGION, "a", "b", "r_um").agg(*[F.sum(c).alias(c) for c in ("a_vox", "b_vox", "inter_vox", "union_vox")])
    return pair_measures(out)


def rollup_sets(sets: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Member voxels are summed place by place: the least of the sums divides the intersection."""
    most = max(cfg.max_set_size, 3)
    rows = regions(sets, cfg)
    places = [F.sum(F.coalesce(F.get("member_vox", F.lit(i)), F.lit(0))).alias(f"v{i}") for i in range(most)]
    out = rows.groupBy(*REGION, "members", "k", "r_um").agg(F.sum("inter_vox").alias("inter_vox"), F.sum("union_vox").alias("union_vox"), *places)
    out = out.withColumn("member_vox", F.slice(F.array(*[f"v{i}" for i in range(most)]), F.lit(1), F.col("k"))).drop(*[f"v{i}" for i in range(most)])
    return set_measures(out)


def hierarchy(channels: DataFrame, pairs: DataFrame, sets: DataFrame, cfg: EngineConfig) -> DataFrame:
    """level, tile_size_x, tile_size_y, n_channels, n_pairs, n_sets (rows of each)."""
    levels = channels.sparkSession.range(cfg.hierarchy_levels).select(F.col("id").cast("int").alias("level"))
    out = levels.withColumns({"tile_size_x": F.call_function("shiftleft", F.lit(cfg.tile_x), F.col("level")), "tile_size_y": F.call_function("shiftleft", F.lit(cfg.tile_y), F.col("level"))})
    for name, rows in (("n_channels", channels), ("n_pairs", pairs), ("n_sets", sets)):
        out = out.join(rows.groupBy(F.col("hierarchy_level").alias("level")).agg(F.count("*").alias(name)), "level", "left")
    return out.fillna(0, ["n_channels", "n_pairs", "n_sets"])
