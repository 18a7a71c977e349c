"""Two-pass filter over tile results: which combinations are valid, then which of their rows stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covoxel.config import FilterConfig


def _passes(cfg: FilterConfig) -> Column:
    return (F.col("overlap_coeff") >= cfg.min_overlap_coeff) & (F.col("inter_vox") >= cfg.min_inter_vox)


def _in_size(rows: DataFrame, cfg: FilterConfig) -> Column:
    """Pairs have no size column: they pass unless sets of three or more are asked for."""
    return F.col("k").between(cfg.min_set_size, cfg.max_set_size) if "k" in rows.columns else F.lit(cfg.min_set_size <= 2)


def passing(rows: DataFrame, r_max: float, cfg: FilterConfig) -> DataFrame:
    return rows.where((F.col("r_um") == r_max) & _passes(cfg) & _in_size(rows, cfg))


def valid_keys(rows: DataFrame, key: list[str], r_max: float, cfg: FilterConfig) -> DataFrame:
    """key, n_tiles: combinations with enough passing tiles at the largest radius."""
    return passing(rows, r_max, cfg).groupBy(*key).agg(F.count("*").alias("n_tiles")).where(F.col("n_tiles") >= max(1, cfg.min_tiles_present))


def top_tiles(rows: DataFrame, key: list[str], r_max: float, cfg: FilterConfig) -> DataFrame:
    """key, tile_x, tile_y: each valid key's best share of tiles by overlap coefficient, one at least.

    Only tiles with a positive coefficient are ranked; equal ones by tile_x, then tile_y.
    """
    ranked = passing(rows, r_max, cfg).where("overlap_coeff > 0").join(valid_keys(rows, key, r_max, cfg).select(*key), key, "left_semi")
    best = Window.partitionBy(*key).orderBy(F.desc("overlap_coeff"), "tile_x", "tile_y")
    n = F.count("*").over(Window.partitionBy(*key))
    keep = F.greatest(F.lit(1), F.floor(n * cfg.top_k_percent))
    return ranked.withColumn("keep", F.row_number().over(best) <= keep).where("keep").select(*key, "tile_x", "tile_y")


def apply(rows: DataFrame, key: list[str], r_max: float, cfg: FilterConfig) -> DataFrame:
    """Rows of valid keys. With filter_by_max_dilation, rows at the largest radius must also pass and lie in the key's kept
    tiles, if it has any; rows at other radii stay whatever happens there, unless cfg.strict."""
    out = rows.join(valid_keys(rows, key, r_max, cfg).select(*key), key, "left_semi")
    if "k" in rows.columns:
        out = out.where(_in_size(rows, cfg))
    elif cfg.min_set_size > 2:
        out = out.limit(0)
    if not cfg.filter_by_max_dilation:
        return out
    fine = _passes(cfg)
    if cfg.top_k_percent is not None:
        top = top_tiles(rows, key, r_max, cfg)
        listed = top.select(*key).distinct().withColumn("listed", F.lit(True))
        out = out.join(listed, key, "left").join(top.withColumn("kept", F.lit(True)), [*key, "tile_x", "tile_y"], "left")
        fine = fine & (F.col("listed").isNull() | F.coalesce("kept", F.lit(False)))
    out = out.withColumn("fine", fine)
    if cfg.strict:
        good = out.where((F.col("r_um") == r_max) & F.col("fine")).select(*key, "tile_x", "tile_y")
        out = out.join(good, [*key, "tile_x", "tile_y"], "left_semi")
    else:
        out = out.where((F.col("r_um") != r_max) | F.col("fine"))
    return out.select(*rows.columns)


def stats(tiles: DataFrame, before: tuple[DataFrame, DataFrame], after: tuple[DataFrame, DataFrame]) -> DataFrame:
    """One row: tiles_processed, pairs_before, pairs_after, sets_before, sets_after, removed_percent."""
    one = lambda rows, name: rows.agg(F.count("*").alias(name))
    out = one(tiles, "tiles_processed")
    for rows, name in zip((before[0], after[0], before[1], after[1]), ("pairs_before", "pairs_after", "sets_before", "sets_after"), strict=True):
        out = out.crossJoin(one(rows, name))  # one row each
    all_, kept = F.col("pairs_before") + F.col("sets_before"), F.col("pairs_after") + F.col("sets_after")
    return out.withColumn("removed_percent", F.when(all_ > 0, 100.0 * (all_ - kept) / all_).otherwise(0.0))
