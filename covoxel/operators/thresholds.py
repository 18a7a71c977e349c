"""Adaptive thresholds per channel and tile.

Voxels are sparse: an absent voxel is 0, and never materialized. The columns in which no voxel is stored enter the quantiles as
one row (0, how many there are) for each channel and tile, so nothing here is as large as the grid.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covoxel.config import EngineConfig
from covoxel.operators.selection import order_key, quantile
from covoxel.operators.tiling import Shape, columns_grid, tile_grid, with_tiles

MAD_TO_SIGMA, MAD_FLOOR = 1.4826, 1e-6  # fixed values


def channel_dim(voxels: DataFrame, cfg: EngineConfig) -> DataFrame:
    spark = voxels.sparkSession
    if cfg.channels:
        return spark.createDataFrame([(c,) for c in cfg.channels], "channel int")
    return voxels.select("channel").distinct()


def _top(shape: Shape) -> list[Column]:
    """Greatest value of a column; an absent voxel of it is 0."""
    value = F.col("value").cast("double")
    return [F.when(F.count("*") < shape.z, F.greatest(F.max(value), F.lit(0.0))).otherwise(F.max(value)).alias("m")]


def mip(voxels: DataFrame, shape: Shape, cfg: EngineConfig) -> DataFrame:
    """Greatest value over z for every channel and (y, x), 0 where no voxel is stored: the dense image, for export."""
    top = voxels.groupBy("channel", "y", "x").agg(*_top(shape))
    spine = columns_grid(voxels.sparkSession, shape, cfg).crossJoin(F.broadcast(channel_dim(voxels, cfg)))  # one row per channel
    return spine.join(top, ["channel", "y", "x"], "left").withColumn("m", F.coalesce(F.col("m").cast("double"), F.lit(0.0)))


def projections(voxels: DataFrame, shape: Shape) -> DataFrame:
    """channel, y, x, m: the projections of columns in which a voxel is stored."""
    return voxels.groupBy("channel", "y", "x").agg(*_top(shape))


def with_gaps(stored: DataFrame, groups: DataFrame, keys: list[str], hold: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """keys, m, n, gap, key (order_key of m): each projection once for each group, with the number n of columns that have it (gap = 0), and for each group one
    row of 0 that stands for its n = gap columns without a voxel. groups: keys, n_columns. What is counted is read more than once: hold() may keep it."""
    found = hold(stored.groupBy(*keys, "m").agg(F.count("*").alias("n")))
    held = found.groupBy(*keys).agg(F.sum("n").alias("held"))
    gap = F.col("n_columns") - F.coalesce("held", F.lit(0))
    long = lambda n: F.lit(n).cast("long")
    empty = groups.join(held, keys, "left").select(*keys, F.lit(0.0).alias("m"), gap.cast("long").alias("n"), gap.cast("long").alias("gap"), long(0).alias("key"))
    one = found.select(*keys, "m", "n", long(0).alias("gap"), order_key("m").alias("key"))
    return one.unionByName(empty.where("n > 0"))


def global_thresholds(lowres: DataFrame, shape: Shape, cfg: EngineConfig, hold: Callable[[DataFrame], DataFrame] = lambda df: df, stored: DataFrame | None = None) -> DataFrame:
    """channel, mu, mad, t_global: median + z * 1.4826 * MAD of the trimmed projection, from exact quantiles. stored: projections() of lowres, if they are there.

    A channel's projection is as large as the volume's face, so its quantiles come from selection(), which gathers no channel anywhere. Columns of the same
    projection are counted first, and hold() keeps the counts, so that the rounds read these alone.
    """
    by = ["channel"]
    stored = projections(lowres, shape) if stored is None else stored
    groups = channel_dim(stored, cfg).withColumn("n_columns", F.lit(shape.y * shape.x))
    m = with_gaps(stored, groups, by, hold)
    cut = quantile(m, by, cfg.trim_q, "cut")
    bg = m.join(F.broadcast(cut), by).where("m <= cut")  # one row per channel, as below
    mu = quantile(bg, by, 0.5, "mu")
    apart = bg.join(F.broadcast(mu), by).withColumn("m", F.abs(F.col("m") - F.col("mu")))
    mad = quantile(apart.withColumn("key", order_key("m")), by, 0.5, "mad")
    out = mu.join(F.broadcast(mad), by).withColumn("mad", F.col("mad") + MAD_FLOOR)
    return out.withColumn("t_global", F.col("mu") + F.lit(cfg.z_alpha * MAD_TO_SIGMA) * F.col("mad"))


def _at(i: Column) -> Column:
    """The i-th of a tile's projections: sorted stored ones in v, `gap` zeros behind its `below` negative ones."""
    return F.when(i < F.col("below"), F.get("v", i)).when(i < F.col("below") + F.col("gap"), F.lit(0.0)).otherwise(F.get("v", i - F.col("gap").cast("int")))


def tile_thresholds(voxels: DataFrame, t_global: DataFrame, shape: Shape, cfg: EngineConfig, tiles: DataFrame | None = None, stored: DataFrame | None = None) -> DataFrame:
    """channel, tile_x, tile_y, t_global, q_tile, t_final, alpha_eff, for all tiles or the given ones. stored: projections() of voxels, if they are there.

    alpha_eff is at least one projection's share, so tiles of fewer than 1 / alpha columns have a level of their own. A
    tile's stored projections are gathered in a sorted array, tile_y * tile_x numbers at most, from which the trim quantile and the level are taken.
    """
    keys = ["channel", "tile_x", "tile_y"]
    stored = projections(voxels, shape) if stored is None else stored
    grid = tile_grid(voxels.sparkSession, shape, cfg)
    if tiles is not None:
        grid = grid.join(tiles.select("tile_x", "tile_y"), ["tile_x", "tile_y"], "left_semi")
    columns = (F.least("x1", F.lit(shape.x)) - F.col("x0")) * (F.least("y1", F.lit(shape.y)) - F.col("y0"))
    groups = grid.select("tile_x", "tile_y", columns.alias("n_columns")).crossJoin(F.broadcast(t_global.select("channel", "t_global")))  # one row per channel
    by_tile = with_tiles(stored, cfg).groupBy(*keys).agg(F.array_sort(F.collect_list("m")).alias("v"))
    by_tile = groups.join(by_tile, keys, "left").withColumn("v", F.coalesce("v", F.array().cast("array<double>")))
    by_tile = by_tile.withColumns({"gap": (F.col("n_columns") - F.size("v")).cast("long"), "below": F.size(F.filter("v", lambda m: m < 0))})
    cut_at = (F.col("n_columns") - 1) * F.lit(cfg.trim_q)
    by_tile = by_tile.withColumns({"at": cut_at, "a": _at(F.floor(cut_at).cast("int")), "b": _at(F.ceil(cut_at).cast("int"))})
    low, high = F.floor("at"), F.ceil("at")
    by_tile = by_tile.withColumn("cut", F.when((low == high) | (F.col("a") == F.col("b")), F.col("a")).otherwise((high - F.col("at")) * F.col("a") + (F.col("at") - low) * F.col("b")))
    by_tile = by_tile.withColumn("n", F.size(F.filter("v", lambda m: m <= F.col("cut"))) + F.when(F.col("cut") >= 0, F.col("gap")).otherwise(F.lit(0)))
    by_tile = by_tile.withColumn("alpha_eff", F.greatest(F.lit(cfg.alpha), F.lit(1.0) / F.greatest(F.lit(1), F.col("n"))))
    at = (F.col("n") - 1) * (1 - F.col("alpha_eff"))
    low = F.floor(at).cast("int")
    a, b = _at(low), _at(F.least(low + 1, F.col("n").cast("int") - 1))
    out = by_tile.withColumn("q_tile", a + (b - a) * (at - low))
    return out.select(*keys, "t_global", "q_tile", F.greatest("t_global", "q_tile").alias("t_final"), "alpha_eff")


def foreground(voxels: DataFrame, thresholds: DataFrame, t_global: DataFrame | None = None) -> DataFrame:
    """Voxels strictly above their tile's threshold (voxels carry tile_x and tile_y). t_global: global_thresholds(), if they are there. No tile's threshold is
    below its channel's, so what isn't above that goes where it is read, and isn't shuffled."""
    keys = ["channel", "tile_x", "tile_y"]
    if t_global is not None:
        least = F.broadcast(t_global.select("channel", F.col("t_global").alias("__least")))  # one row per channel
        voxels = voxels.join(least, "channel").where("value > __least").drop("__least")
    return voxels.join(thresholds.select(*keys, "t_final"), keys).where("value > t_final").drop("t_final")
