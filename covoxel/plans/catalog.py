"""The registered queries over the driver's tables and their SQL twins.

The main volume is made from lineitem: six channels on a grid of 7 x 40 x 56, and 56 more columns for every 60,000 lines, absent
voxels 0. It is dense and noisy, so
every stage has work to do, and integer voxel sizes make distances exact.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from covoxel.config import EngineConfig, FilterConfig, VoxelSize
from covoxel.functions import names as fn
from covoxel.operators import components, filtering, mining, rollup, thresholds, tiling
from covoxel.operators.tiling import Shape
from covoxel.plans import sql, tables
from covoxel.plans.engine import Engine, hold

LINES, WIDTH = 60_000, 56
CFG = EngineConfig(tile_xy=(16, 16), voxel_size=VoxelSize(1, 1, 2), min_obj_vol_um3=8, dilate_um=(0, 1, 2), min_marker_vox=20, min_support_pair=20, min_support_set=10)
#: Thresholds by radius, with a radius missing (0) and one that no marker reaches.
STOP = EngineConfig(tile_xy=(16, 16), voxel_size=VoxelSize(1, 1, 2), min_obj_vol_um3=8, dilate_um=(0, 1, 2), min_marker_vox={1: 100_000, 2: 20}, min_support_pair={0: 2, 1: 10, 2: 20}, min_support_set={2: 10})
#: Faces connect, not corners.
FACES = EngineConfig(tile_xy=(16, 16), voxel_size=VoxelSize(1, 1, 2), min_obj_vol_um3=8, connectivity=6, dilate_um=(0, 1, 2), min_marker_vox=20, min_support_pair=20, min_support_set=10)
FILTER = FilterConfig(min_overlap_coeff=0.2, min_inter_vox=25, min_tiles_present=3, top_k_percent=0.5)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shape(spark: SparkSession, sf_dir: str) -> Shape:
    if sf_dir not in _SHAPES:
        _SHAPES[sf_dir] = Shape(7, 40, WIDTH * max(1, table(spark, sf_dir, "lineitem").count() // LINES))
    return _SHAPES[sf_dir]


_SHAPES: dict[str, Shape] = {}


def volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    place = [(F.col("l_suppkey") % 6).cast("int").alias("channel"), (F.col("l_linenumber") - 1).cast("int").alias("z"), (F.col("l_partkey") % 40).cast("int").alias("y"), (F.col("l_orderkey") % shape(spark, sf_dir).x).cast("int").alias("x")]
    return li.groupBy(*place).agg(F.sum(F.col("l_quantity").cast("long")).alias("value"))


def engine(spark: SparkSession, sf_dir: str, cfg: EngineConfig = CFG) -> Engine:
    e = Engine(volume(spark, sf_dir), shape(spark, sf_dir), cfg)
    e.voxels = e.hold(e.voxels)
    return e


def nine(x: Column) -> Column:
    """x to nine digits as SQL engines round doubles, by whole numbers of 1e-9. F.round() takes the shortest decimal that stands for x: 661 / 5120, just
    below 0.1291015625, is a tie for it and goes up."""
    return F.round(x * 1e9) / 1e9


def r9(*cols: str) -> dict:
    return {c: nine(F.col(c)) for c in cols}


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = oracle
        return f

    return add


# The stages in SQL; each query's twin is this prefix and its own last step.
Z = CFG.z_alpha * thresholds.MAD_TO_SIGMA


def chain(cfg: EngineConfig = CFG) -> str:
    def by_r(spec) -> str:
        return "CASE r_um " + " ".join(f"WHEN {r} THEN {cfg.at(spec, r)}" for r in cfg.dilate_um) + " END"

    stop = f"""
alive_pairs AS (SELECT tile_x, tile_y, r_idx FROM (
  SELECT s.tile_x, s.tile_y, s.r_idx, min(CASE WHEN e.r_idx IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY s.tile_x, s.tile_y ORDER BY s.r_idx DESC) AS ok
  FROM (SELECT * FROM tiles0, radii) s LEFT JOIN (SELECT DISTINCT tile_x, tile_y, r_idx FROM eligible_pairs) e USING (tile_x, tile_y, r_idx)) WHERE ok = 1),
""" if cfg.aggressive_stop_on_fail else "alive_pairs AS (SELECT DISTINCT tile_x, tile_y, r_idx FROM eligible_pairs),"
    faces = " AND abs(a.z - b.z) + abs(a.y - b.y) + abs(a.x - b.x) = 1" if cfg.connectivity == 6 else ""
    return f"""
WITH RECURSIVE dims AS (SELECT {WIDTH} * greatest(1, count(*) // {LINES}) AS w FROM lineitem), vox AS (
  SELECT CAST(l_suppkey % 6 AS INTEGER) AS channel, l_linenumber - 1 AS z, CAST(l_partkey % 40 AS INTEGER) AS y, CAST(l_orderkey % w AS INTEGER) AS x,
         CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS value, CAST(l_orderkey % w // 16 AS INTEGER) AS tile_x, CAST(l_partkey % 40 // 16 AS INTEGER) AS tile_y
  FROM lineitem, dims GROUP BY ALL),
radii AS (SELECT *, {by_r(cfg.min_marker_vox)} AS min_marker, {by_r(cfg.min_support_pair)} AS min_pair, {by_r(cfg.min_support_set)} AS min_set
  FROM (VALUES {", ".join(f"({i}, CAST({r} AS DOUBLE))" for i, r in enumerate(cfg.dilate_um))}) t(r_idx, r_um)),
chans AS (SELECT DISTINCT channel FROM vox),
tiles0 AS (SELECT CAST(a.range AS INTEGER) AS tile_x, CAST(b.range AS INTEGER) AS tile_y FROM (SELECT unnest(range((w + 15) // 16)) AS range FROM dims) a, range(3) b),
mip AS (
  SELECT channel, CAST(yy.range AS INTEGER) AS y, CAST(xx.range AS INTEGER) AS x, CAST(yy.range // 16 AS INTEGER) AS tile_y, CAST(xx.range // 16 AS INTEGER) AS tile_x, CAST(coalesce(m, 0) AS DOUBLE) AS m
  FROM chans, range(40) yy, (SELECT unnest(range(w)) AS range FROM dims) xx LEFT JOIN (SELECT channel AS c, y, x, max(value) AS m FROM vox GROUP BY ALL) v ON c = channel AND v.y = yy.range AND v.x = xx.range),
gcut AS (SELECT channel, quantile_cont(m, {cfg.trim_q}) AS cut FROM mip GROUP BY ALL),
gbg AS (SELECT channel, m FROM mip JOIN gcut USING (channel) WHERE m <= cut),
gmu AS (SELECT channel, quantile_cont(m, 0.5) AS mu FROM gbg GROUP BY ALL),
tglobal AS (SELECT channel, mu, mad, mu + {Z!r} * mad AS t_global FROM (SELECT channel, mu, quantile_cont(abs(m - mu), 0.5) + 1e-6 AS mad FROM gbg JOIN gmu USING (channel) GROUP BY ALL)),
tcut AS (SELECT channel, tile_x, tile_y, quantile_cont(m, {cfg.trim_q}) AS cut FROM mip GROUP BY ALL),
tq AS (SELECT channel, tile_x, tile_y, quantile_cont(m, {1 - cfg.alpha!r}) AS q_tile, CAST({cfg.alpha} AS DOUBLE) AS alpha_eff FROM mip JOIN tcut USING (channel, tile_x, tile_y) WHERE m <= cut GROUP BY ALL),
thr AS (SELECT channel, tile_x, tile_y, t_global, q_tile, greatest(t_global, q_tile) AS t_final, alpha_eff FROM tq JOIN tglobal USING (channel)),
fg AS (SELECT v.* FROM vox v JOIN thr USING (channel, tile_x, tile_y) WHERE value > t_final),
edge AS (
  SELECT a.channel, a.z AS az, a.y AS ay, a.x AS ax, b.z AS bz, b.y AS bY, b.x AS bx FROM fg a JOIN fg b
  ON a.channel = b.channel AND a.tile_x = b.tile_x AND a.tile_y = b.tile_y AND abs(a.z - b.z) <= 1 AND abs(a.y - b.y) <= 1 AND abs(a.x - b.x) <= 1 AND (a.z, a.y, a.x) <> (b.z, b.y, b.x){faces}),
reach AS (
  SELECT channel, tile_x, tile_y, z, y, x, (z * 40 + y) * 1000000 + x AS root FROM fg
  UNION SELECT f.channel, f.tile_x, f.tile_y, e.bz, e.bY, e.bx, f.root FROM reach f JOIN edge e ON f.channel = e.channel AND f.z = e.az AND f.y = e.ay AND f.x = e.ax),
lab AS (SELECT channel, tile_x, tile_y, z, y, x, min(root) AS label FROM reach GROUP BY ALL),
sized AS (SELECT *, count(*) OVER (PARTITION BY channel, tile_x, tile_y, label) AS size FROM lab),
obj AS (SELECT * FROM sized WHERE size >= {cfg.min_voxels}),
grid AS (SELECT CAST(a.range AS INTEGER) AS z, CAST(b.range AS INTEGER) AS y, CAST(c.range AS INTEGER) AS x, CAST(c.range // 16 AS INTEGER) AS tile_x, CAST(b.range // 16 AS INTEGER) AS tile_y FROM range(7) a, range(40) b, (SELECT unnest(range(w)) AS range FROM dims) c),
prox AS (
  SELECT o.channel, g.tile_x, g.tile_y, g.z, g.y, g.x, CAST(min((g.x - o.x) ** 2 + (g.y - o.y) ** 2 + 4 * (g.z - o.z) ** 2) AS DOUBLE) AS min_d2
  FROM obj o JOIN grid g ON o.tile_x = g.tile_x AND o.tile_y = g.tile_y AND abs(g.x - o.x) <= 2 AND abs(g.y - o.y) <= 2 AND abs(g.z - o.z) <= 1
  GROUP BY ALL HAVING min((g.x - o.x) ** 2 + (g.y - o.y) ** 2 + 4 * (g.z - o.z) ** 2) <= 4),
masked AS (SELECT p.*, r_idx, r_um FROM prox p JOIN radii ON min_d2 <= r_um * r_um),
stats AS (
  SELECT t.tile_x, t.tile_y, c.channel, r.r_idx, r.r_um, coalesce(n, 0) AS voxel_count, coalesce(s, 0.0) AS sum_intensity
  FROM tiles0 t, chans c, radii r
  LEFT JOIN (SELECT tile_x, tile_y, channel, r_idx, count(*) AS n FROM masked GROUP BY ALL) m ON m.tile_x = t.tile_x AND m.tile_y = t.tile_y AND m.channel = c.channel AND m.r_idx = r.r_idx
  LEFT JOIN (SELECT m.tile_x, m.tile_y, m.channel, CAST(sum(value) AS DOUBLE) AS s FROM masked m JOIN vox v USING (channel, z, y, x) WHERE r_idx = 0 GROUP BY ALL) i ON i.tile_x = t.tile_x AND i.tile_y = t.tile_y AND i.channel = c.channel),
active AS (SELECT s.* FROM stats s JOIN radii r USING (r_idx) WHERE voxel_count >= min_marker),
apairs AS (SELECT a.tile_x, a.tile_y, a.r_idx, a.r_um, a.channel AS a, b.channel AS b, a.voxel_count AS a_vox, b.voxel_count AS b_vox FROM active a JOIN active b ON a.tile_x = b.tile_x AND a.tile_y = b.tile_y AND a.r_idx = b.r_idx AND a.channel < b.channel),
met AS (SELECT p.tile_x, p.tile_y, p.r_idx, p.channel AS a, q.channel AS b, count(*) AS inter FROM masked p JOIN masked q ON p.tile_x = q.tile_x AND p.tile_y = q.tile_y AND p.r_idx = q.r_idx AND p.z = q.z AND p.y = q.y AND p.x = q.x AND p.channel < q.channel GROUP BY ALL),
pairs_at AS (SELECT p.*, coalesce(inter, 0) AS inter_vox, a_vox + b_vox - coalesce(inter, 0) AS union_vox FROM apairs p LEFT JOIN met USING (tile_x, tile_y, r_idx, a, b)),
frequent AS (SELECT tile_x, tile_y, a, b FROM pairs_at JOIN radii USING (r_idx) WHERE r_idx = {len(cfg.dilate_um) - 1} AND inter_vox >= min_pair),
eligible_pairs AS (SELECT p.* FROM pairs_at p SEMI JOIN frequent USING (tile_x, tile_y, a, b)),
{stop}
pairs AS (
  SELECT e.tile_x, e.tile_y, e.r_idx, e.r_um, a, b, a_vox, b_vox, inter_vox, union_vox,
         CASE WHEN union_vox > 0 THEN inter_vox / union_vox ELSE 0.0 END AS iou, CASE WHEN least(a_vox, b_vox) > 0 THEN inter_vox / least(a_vox, b_vox) ELSE 0.0 END AS overlap_coeff
  FROM eligible_pairs e SEMI JOIN alive_pairs USING (tile_x, tile_y, r_idx) JOIN radii r USING (r_idx) WHERE inter_vox >= min_pair),
cand3 AS (SELECT p.tile_x, p.tile_y, [p.a, p.b, q.b] AS members FROM frequent p JOIN frequent q ON p.tile_x = q.tile_x AND p.tile_y = q.tile_y AND p.b = q.a SEMI JOIN frequent r ON r.tile_x = p.tile_x AND r.tile_y = p.tile_y AND r.a = p.a AND r.b = q.b),
cand4 AS (
  SELECT c.tile_x, c.tile_y, list_append(c.members, q.b) AS members FROM cand3 c JOIN frequent q ON c.tile_x = q.tile_x AND c.tile_y = q.tile_y AND c.members[3] = q.a
  SEMI JOIN frequent r ON r.tile_x = c.tile_x AND r.tile_y = c.tile_y AND r.a = c.members[1] AND r.b = q.b SEMI JOIN frequent u ON u.tile_x = c.tile_x AND u.tile_y = c.tile_y AND u.a = c.members[2] AND u.b = q.b),
cands AS (SELECT tile_x, tile_y, 3 AS k, members FROM cand3 UNION ALL SELECT tile_x, tile_y, 4, members FROM cand4),
eligible_sets AS (
  SELECT c.tile_x, c.tile_y, c.k, c.members, r_idx, r_um, list(voxel_count ORDER BY channel) AS member_vox
  FROM cands c JOIN active a ON a.tile_x = c.tile_x AND a.tile_y = c.tile_y AND list_contains(c.members, a.channel) GROUP BY ALL HAVING count(*) = c.k),
{stop.replace("alive_pairs", "alive_sets").replace("eligible_pairs", "eligible_sets")}
voxel_sets AS (SELECT tile_x, tile_y, r_idx, z, y, x, list(channel) AS present FROM masked GROUP BY ALL),
set_counts AS (
  SELECT e.tile_x, e.tile_y, e.r_idx, e.members, count(*) FILTER (WHERE list_has_all(present, members)) AS inter_vox, count(*) AS union_vox
  FROM eligible_sets e JOIN voxel_sets v ON v.tile_x = e.tile_x AND v.tile_y = e.tile_y AND v.r_idx = e.r_idx AND list_has_any(present, members) GROUP BY ALL),
sets AS (
  SELECT e.tile_x, e.tile_y, e.r_idx, e.r_um, e.k, e.members, e.member_vox, coalesce(inter_vox, 0) AS inter_vox, coalesce(union_vox, 0) AS union_vox,
         CASE WHEN coalesce(union_vox, 0) > 0 THEN inter_vox / union_vox ELSE 0.0 END AS iou, CASE WHEN list_min(member_vox) > 0 THEN coalesce(inter_vox, 0) / list_min(member_vox) ELSE 0.0 END AS overlap_coeff
  FROM eligible_sets e SEMI JOIN alive_sets s ON s.tile_x = e.tile_x AND s.tile_y = e.tile_y AND s.r_idx = e.r_idx LEFT JOIN set_counts c ON c.tile_x = e.tile_x AND c.tile_y = e.tile_y AND c.r_idx = e.r_idx AND c.members = e.members
  JOIN radii r ON r.r_idx = e.r_idx WHERE coalesce(inter_vox, 0) >= min_set),
summary AS (
  SELECT tile_x, tile_y, coalesce(n_active, 0) AS n_active_channels, coalesce(n_freq, 0) AS n_frequent_pairs FROM tiles0
  LEFT JOIN (SELECT tile_x, tile_y, count(*) AS n_active FROM active WHERE r_idx = {len(cfg.dilate_um) - 1} GROUP BY ALL) USING (tile_x, tile_y) LEFT JOIN (SELECT tile_x, tile_y, count(*) AS n_freq FROM frequent GROUP BY ALL) USING (tile_x, tile_y)),
levels AS (SELECT CAST(range AS INTEGER) AS lv FROM range({cfg.hierarchy_levels})),
up_channels AS (
  SELECT *, CASE WHEN voxel_count > 0 THEN sum_intensity / voxel_count ELSE 0.0 END AS mean_intensity FROM (
  SELECT lv AS hierarchy_level, tile_x >> lv AS region_x, tile_y >> lv AS region_y, channel, r_um, CAST(sum(voxel_count) AS BIGINT) AS voxel_count, sum(sum_intensity) AS sum_intensity FROM stats, levels GROUP BY ALL)),
up_pairs AS (
  SELECT *, CASE WHEN union_vox > 0 THEN inter_vox / union_vox ELSE 0.0 END AS iou, CASE WHEN least(a_vox, b_vox) > 0 THEN inter_vox / least(a_vox, b_vox) ELSE 0.0 END AS overlap_coeff FROM (
  SELECT lv AS hierarchy_level, tile_x >> lv AS region_x, tile_y >> lv AS region_y, a, b, r_um, CAST(sum(a_vox) AS BIGINT) AS a_vox, CAST(sum(b_vox) AS BIGINT) AS b_vox, CAST(sum(inter_vox) AS BIGINT) AS inter_vox, CAST(sum(union_vox) AS BIGINT) AS union_vox FROM pairs, levels GROUP BY ALL)),
up_sets AS (
  SELECT *, CASE WHEN union_vox > 0 THEN inter_vox / union_vox ELSE 0.0 END AS iou, CASE WHEN least_vox > 0 THEN inter_vox / least_vox ELSE 0.0 END AS overlap_coeff FROM (
  SELECT *, list_min(list_filter([v1, v2, v3, v4], lambda v: v IS NOT NULL)) AS least_vox FROM (
  SELECT lv AS hierarchy_level, tile_x >> lv AS region_x, tile_y >> lv AS region_y, members, k, r_um, CAST(sum(inter_vox) AS BIGINT) AS inter_vox, CAST(sum(union_vox) AS BIGINT) AS union_vox,
         CAST(sum(member_vox[1]) AS BIGINT) AS v1, CAST(sum(member_vox[2]) AS BIGINT) AS v2, CAST(sum(member_vox[3]) AS BIGINT) AS v3, CAST(sum(member_vox[4]) AS BIGINT) AS v4 FROM sets, levels GROUP BY ALL))),
combos AS (
  SELECT 'ch' || a || '|ch' || b AS channels, 2 AS channel_count, r_um AS dilation, hierarchy_level, region_x, region_y, inter_vox AS total_count, union_vox AS total_union, iou, overlap_coeff FROM up_pairs
  UNION ALL SELECT array_to_string(list_transform(members, lambda m: 'ch' || m), '|'), k, r_um, hierarchy_level, region_x, region_y, inter_vox, union_vox, iou, overlap_coeff FROM up_sets)
"""


CHAIN = chain()


def last(step: str, cfg_chain: str | None = None) -> str:
    return (cfg_chain or CHAIN) + step


@query(last("SELECT channel, z, y, x, value, tile_x, tile_y FROM vox"))
def voxel_volume(spark, sf_dir):
    return tiling.with_tiles(volume(spark, sf_dir), CFG)


@query(f"SELECT CAST(a.range AS INTEGER) AS tile_x, CAST(b.range AS INTEGER) AS tile_y, CAST(a.range * 16 AS INTEGER) AS x0, CAST(a.range * 16 + 16 AS INTEGER) AS x1, CAST(b.range * 16 AS INTEGER) AS y0, CAST(b.range * 16 + 16 AS INTEGER) AS y1, CAST(1792 AS BIGINT) AS total_voxels FROM (SELECT unnest(range(({WIDTH} * greatest(1, count(*) // {LINES}) + 15) // 16)) AS range FROM lineitem) a, range(3) b")
def tile_grid(spark, sf_dir):
    return tiling.tile_grid(spark, shape(spark, sf_dir), CFG)


@query(last("SELECT channel, y, x, tile_x, tile_y, m FROM mip"))
def mip(spark, sf_dir):
    return thresholds.mip(volume(spark, sf_dir), shape(spark, sf_dir), CFG)


@query(last("SELECT channel, round(mu, 9) AS mu, round(mad, 9) AS mad, round(t_global, 9) AS t_global FROM tglobal"))
def global_threshold(spark, sf_dir):
    return engine(spark, sf_dir).global_thresholds().withColumns(r9("mu", "mad", "t_global"))


@query(last("SELECT channel, tile_x, tile_y, round(t_global, 9) AS t_global, round(q_tile, 9) AS q_tile, round(t_final, 9) AS t_final, alpha_eff FROM thr"))
def tile_threshold(spark, sf_dir):
    return engine(spark, sf_dir).tile_thresholds().withColumns(r9("t_global", "q_tile", "t_final"))


@query(last("SELECT channel, tile_x, tile_y, count(*) AS n FROM fg GROUP BY ALL"))
def mask_counts(spark, sf_dir):
    return engine(spark, sf_dir).foreground().groupBy("channel", "tile_x", "tile_y").agg(F.count("*").alias("n"))


@query(last("SELECT channel, tile_x, tile_y, size, count(DISTINCT label) AS n FROM sized GROUP BY ALL"))
def component_sizes(spark, sf_dir):
    return engine(spark, sf_dir).labelled().groupBy("channel", "tile_x", "tile_y", "size").agg(F.countDistinct("label").alias("n"))


@query(last("SELECT channel, tile_x, tile_y, z, y, x FROM obj"))
def component_filtered_mask(spark, sf_dir):
    return engine(spark, sf_dir).objects().select("channel", "tile_x", "tile_y", "z", "y", "x")


@query(last("SELECT channel, tile_x, tile_y, round(t_final, 9) AS t_final, coalesce(n, 0) AS n_components, 4 AS min_voxels FROM thr LEFT JOIN (SELECT channel, tile_x, tile_y, count(DISTINCT label) AS n FROM lab GROUP BY ALL) USING (channel, tile_x, tile_y)"))
def tile_outputs(spark, sf_dir):
    return engine(spark, sf_dir).tile_outputs().select("channel", "tile_x", "tile_y", nine(F.col("t_final")).alias("t_final"), "n_components", "min_voxels")


@query(last("SELECT channel, tile_x, tile_y, z, y, x, min_d2 FROM prox"))
def proximity_distances(spark, sf_dir):
    return engine(spark, sf_dir).proximity()


@query(last("SELECT channel, tile_x, tile_y, r_um, count(*) AS n FROM masked GROUP BY ALL"))
def proximity_counts(spark, sf_dir):
    return engine(spark, sf_dir).masks().groupBy("channel", "tile_x", "tile_y", "r_um").agg(F.count("*").alias("n"))


@query(last("SELECT tile_x, tile_y, channel, r_idx, r_um, voxel_count, sum_intensity FROM stats"))
def channel_tile_stats(spark, sf_dir):
    return engine(spark, sf_dir).mine().channel_stats


@query(last("SELECT tile_x, tile_y, channel, r_um, voxel_count FROM active"))
def active_markers(spark, sf_dir):
    e = engine(spark, sf_dir)
    return mining.active_markers(e.mine().channel_stats, e.radii()).select("tile_x", "tile_y", "channel", "r_um", "voxel_count")


PAIRS = "tile_x, tile_y, r_um, a, b, a_vox, b_vox, inter_vox, union_vox, round(iou, 9) AS iou, round(overlap_coeff, 9) AS overlap_coeff"
SETS = "tile_x, tile_y, r_um, k, array_to_string(members, ',') AS members, inter_vox, union_vox, round(iou, 9) AS iou, round(overlap_coeff, 9) AS overlap_coeff"


def pairs_out(df: DataFrame) -> DataFrame:
    return df.select("tile_x", "tile_y", "r_um", "a", "b", "a_vox", "b_vox", "inter_vox", "union_vox", nine(F.col("iou")).alias("iou"), nine(F.col("overlap_coeff")).alias("overlap_coeff"))


def sets_out(df: DataFrame) -> DataFrame:
    return df.select("tile_x", "tile_y", "r_um", "k", F.array_join("members", ",").alias("members"), "inter_vox", "union_vox", nine(F.col("iou")).alias("iou"), nine(F.col("overlap_coeff")).alias("overlap_coeff"))


@query(last("SELECT tile_x, tile_y, a, b FROM frequent"))
def frequent_pairs(spark, sf_dir):
    e = engine(spark, sf_dir)
    near = e.proximity().join(F.broadcast(e.channels()), "channel")
    stats = e.hold(mining.channel_stats(e.proximity(), e.innermost(), e.tiles(), e.channels(), e.radii(), CFG))
    active = mining.active_markers(stats, e.radii()).join(F.broadcast(e.channels()), "channel")
    return mining.frequent_pairs(active, mining.signatures_by_distance(near, 6, CFG), e.radii(), 2).select("tile_x", "tile_y", "a", "b")


@query(last(f"SELECT {PAIRS} FROM pairs"))
def pair_overlaps(spark, sf_dir):
    return pairs_out(engine(spark, sf_dir).mine().pairs)


@query(last("SELECT tile_x, tile_y, k, array_to_string(members, ',') AS members FROM cands"))
def set_candidates(spark, sf_dir):
    top = hold(frequent_pairs(spark, sf_dir).withColumn("members", F.array("a", "b")))  # each of the joins reads them
    return mining.set_candidates(top, CFG.max_set_size).select("tile_x", "tile_y", "k", F.array_join("members", ",").alias("members"))


@query(last(f"SELECT {SETS} FROM sets"))
def set_overlaps(spark, sf_dir):
    return sets_out(engine(spark, sf_dir).mine().sets)


@query(last("SELECT tile_x, tile_y, n_active_channels, n_frequent_pairs FROM summary"))
def tile_summary(spark, sf_dir):
    return engine(spark, sf_dir).mine().summary


@query(last(f"SELECT {PAIRS} FROM pairs", chain(STOP)))
def aggressive_stop_pairs(spark, sf_dir):
    return pairs_out(engine(spark, sf_dir, STOP).mine().pairs)


@query(last(f"SELECT {SETS} FROM sets", chain(STOP)))
def aggressive_stop_sets(spark, sf_dir):
    return sets_out(engine(spark, sf_dir, STOP).mine().sets)


REGION = "hierarchy_level, region_x * (1 << hierarchy_level) AS tile_x0, (region_x + 1) * (1 << hierarchy_level) AS tile_x1, region_y * (1 << hierarchy_level) AS tile_y0, (region_y + 1) * (1 << hierarchy_level) AS tile_y1"


@query(last(f"SELECT {REGION}, channel, r_um, voxel_count, sum_intensity, round(mean_intensity, 9) AS mean_intensity FROM up_channels"))
def rollup_channels(spark, sf_dir):
    e = engine(spark, sf_dir)
    return e.rollup()[0].drop("region_x", "region_y").withColumns(r9("mean_intensity"))


@query(last(f"SELECT {REGION}, a, b, r_um, a_vox, b_vox, inter_vox, union_vox, round(iou, 9) AS iou, round(overlap_coeff, 9) AS overlap_coeff FROM up_pairs"))
def rollup_pairs(spark, sf_dir):
    return engine(spark, sf_dir).rollup()[1].drop("region_x", "region_y").withColumns(r9("iou", "overlap_coeff"))


@query(last(f"SELECT {REGION}, array_to_string(members, ',') AS members, k, r_um, inter_vox, union_vox, least_vox, round(iou, 9) AS iou, round(overlap_coeff, 9) AS overlap_coeff FROM up_sets"))
def rollup_sets(spark, sf_dir):
    out = engine(spark, sf_dir).rollup()[2].drop("region_x", "region_y").withColumns(r9("iou", "overlap_coeff"))
    return out.withColumns({"members": F.array_join("members", ","), "least_vox": F.array_min("member_vox")}).drop("member_vox")


@query(last("SELECT lv AS level, 16 << lv AS tile_size_x, 16 << lv AS tile_size_y, (SELECT count(*) FROM up_channels WHERE hierarchy_level = lv) AS n_channels, (SELECT count(*) FROM up_pairs WHERE hierarchy_level = lv) AS n_pairs, (SELECT count(*) FROM up_sets WHERE hierarchy_level = lv) AS n_sets FROM levels"))
def hierarchy_meta(spark, sf_dir):
    e = engine(spark, sf_dir)
    return rollup.hierarchy(*e.rollup(), CFG)


@query(last("""SELECT 'channels' AS key, to_json(list('ch' || channel ORDER BY channel)) AS value FROM chans UNION ALL SELECT 'dilation_amounts', '[0.0,1.0,2.0]' UNION ALL SELECT 'volume_bounds', '{"z":[0,7],"y":[0,40],"x":[0,' || w || ']}' FROM dims"""))
def metadata_json(spark, sf_dir):
    """Without the levels, which hierarchy_meta compares as columns."""
    e = engine(spark, sf_dir)
    levels = spark.createDataFrame([(0, 16, 16, 0, 0, 0)], "level int, tile_size_x int, tile_size_y int, n_channels long, n_pairs long, n_sets long")
    return tables.metadata_table(spark, e.channel_names(), levels, [0.0, 1.0, 2.0], e.shape).where("key <> 'hierarchy_levels'")


@query(last("SELECT channels, channel_count, dilation, hierarchy_level, total_count, total_union, round(iou, 9) AS iou, round(overlap_coeff, 9) AS overlap_coeff FROM combos"))
def combinations_table(spark, sf_dir):
    return engine(spark, sf_dir).result_tables(only=("combinations",))["combinations"].drop("id").withColumns(r9("iou", "overlap_coeff"))


@query(last(f"SELECT channels, dilation, {REGION}, total_count AS inter_count, total_union AS union_count FROM combos"))
def tiles_table(spark, sf_dir):
    made = engine(spark, sf_dir).result_tables(only=("combinations", "tiles"))
    both = made["combinations"].join(made["tiles"], F.col("id") == F.col("combination_id"))
    return both.select("channels", "dilation", "hierarchy_level", "tile_x0", "tile_x1", "tile_y0", "tile_y1", "inter_count", "union_count")


@query(last(f"SELECT 'ch' || channel AS channel, channel AS channel_idx, r_um AS dilation, {REGION}, voxel_count, sum_intensity, round(mean_intensity, 9) AS mean_intensity FROM up_channels"))
def channel_stats_table(spark, sf_dir):
    return engine(spark, sf_dir).result_tables(only=("channel_stats",))["channel_stats"].withColumns(r9("mean_intensity"))


def over_tables(spark: SparkSession, sf_dir: str, text: str, **values) -> DataFrame:
    """Of the result tables those that the text names are made."""
    only = tuple(name for name in tables.TABLES if re.search(rf"\b(?:FROM|JOIN) {name}\b", text))
    tables.register_views(engine(spark, sf_dir).result_tables(only=only))
    return spark.sql(text.format(**values))


COMBO0 = CHAIN + ", combinations AS (SELECT * FROM combos), channel_stats AS (SELECT 'ch' || channel AS channel, r_um AS dilation, hierarchy_level, region_x * (1 << hierarchy_level) AS tile_x0, region_y * (1 << hierarchy_level) AS tile_y0, voxel_count, sum_intensity, mean_intensity FROM up_channels)\n"


@query(COMBO0 + f"SELECT * REPLACE (round(global_iou, 9) AS global_iou) FROM ({sql.TOP_IOU.format(dilation=2.0, limit=20)})")
def top_iou(spark, sf_dir):
    return over_tables(spark, sf_dir, sql.TOP_IOU, dilation="2.0D", limit=20).withColumns(r9("global_iou"))


@query(COMBO0 + sql.CHANNEL_TOTALS.format(dilation=0.0))
def channel_totals(spark, sf_dir):
    return over_tables(spark, sf_dir, sql.CHANNEL_TOTALS, dilation="0.0D")


@query(COMBO0 + f"SELECT * REPLACE (round(mean_intensity, 9) AS mean_intensity) FROM ({sql.HEATMAP_CHANNEL.format(channel='ch3', level=0, dilation=1.0)})")
def heatmap_channel(spark, sf_dir):
    return over_tables(spark, sf_dir, sql.HEATMAP_CHANNEL, channel="ch3", level=0, dilation="1.0D").withColumns(r9("mean_intensity"))


@query(COMBO0 + "SELECT region_x AS tile_x0, region_y AS tile_y0, total_count AS inter_count, total_union AS union_count, round(iou, 9) AS iou FROM combos WHERE channels = 'ch0|ch1' AND hierarchy_level = 0 AND dilation = 2.0")
def heatmap_pair(spark, sf_dir):
    return over_tables(spark, sf_dir, sql.HEATMAP_PAIR, channels="ch0|ch1", level=0, dilation="2.0D").withColumns(r9("iou"))


@query(COMBO0 + f"SELECT * REPLACE (round(global_iou, 9) AS global_iou) FROM ({sql.DILATION_CURVE.format(channels='ch0|ch1')})")
def dilation_curve(spark, sf_dir):
    return over_tables(spark, sf_dir, sql.DILATION_CURVE, channels="ch0|ch1").withColumns(r9("global_iou"))


@query(last("SELECT DISTINCT hierarchy_level, tile_x0, tile_y0, tile_x0 * 16 AS x0, tile_x1 * 16 AS x1, tile_y0 * 16 AS y0, tile_y1 * 16 AS y1 FROM (SELECT *, " + REGION.replace("hierarchy_level, ", "", 1) + " FROM up_channels)"))
def tile_to_voxel(spark, sf_dir):
    rows = engine(spark, sf_dir).rollup()[0].select("hierarchy_level", "tile_x0", "tile_x1", "tile_y0", "tile_y1").distinct()
    return fn.tile_to_voxel(rows, 16, 16).drop("tile_x1", "tile_y1")


# Brands of parts as channels, orders as voxels, years as tiles: no image stages.
BASKET = """
WITH b AS (SELECT DISTINCT CAST(regexp_extract(p_brand, '(\\d+)$', 1) AS INTEGER) AS channel, l_orderkey AS voxel, CAST(year(o_orderdate) AS INTEGER) AS tile
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey),
n AS (SELECT tile, channel, count(*) AS vox FROM b GROUP BY ALL),
i AS (SELECT p.tile, p.channel AS a, q.channel AS b, count(*) AS inter_vox FROM b p JOIN b q ON p.tile = q.tile AND p.voxel = q.voxel AND p.channel < q.channel GROUP BY ALL)
SELECT i.tile, a, b, x.vox AS a_vox, y.vox AS b_vox, inter_vox, x.vox + y.vox - inter_vox AS union_vox, round(inter_vox / (x.vox + y.vox - inter_vox), 9) AS iou
FROM i JOIN n x ON x.tile = i.tile AND x.channel = a JOIN n y ON y.tile = i.tile AND y.channel = b
"""


def brands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.regexp_extract("p_brand", r"(\d+)$", 1).cast("int").alias("channel"))


def basket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each line of an order; brands repeat within an order."""
    li, parts = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), brands(spark, sf_dir)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.year("o_orderdate").alias("tile_x"))
    both = li.join(parts, F.col("l_partkey") == F.col("p_partkey")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return both.select("tile_x", F.lit(0).alias("tile_y"), F.lit(0).alias("r_idx"), "channel", F.lit(0).alias("z"), F.lit(0).alias("y"), F.col("l_orderkey").alias("x"))


@query(BASKET)
def basket_pairs(spark, sf_dir):
    """Co-occurring brands from the histogram of brand combinations per year, instead of a self-join of lines. An order's lines become its combination where
    they meet the order, and all else is read from the histogram, so no task holds lines by their brand."""
    rows = basket(spark, sf_dir)
    found = sorted(r[0] for r in brands(spark, sf_dir).select("channel").distinct().collect())  # a handful; those never sold count nothing
    channels = spark.createDataFrame([(c, i) for i, c in enumerate(found)], "channel int, pos int")
    histogram = Engine.hold(Engine(spark.createDataFrame([], "channel int, z int, y int, x int, value double"), Shape(1, 1, 1), CFG), mining.signatures(rows.join(F.broadcast(channels), "channel"), len(found)))
    out = mining.count_overlaps(mining.active_pairs(mining.counts_of(histogram, channels)), histogram).where("inter_vox > 0")
    return out.select(F.col("tile_x").alias("tile"), "a", "b", "a_vox", "b_vox", "inter_vox", "union_vox", nine(F.col("inter_vox") / F.col("union_vox")).alias("iou"))


NAMES = "SELECT p_partkey AS channel, CASE WHEN p_partkey % 7 = 0 THEN p_brand || ' Do Not Use' ELSE p_brand END AS name FROM part"


@query(f"SELECT min(channel) AS channel, name FROM ({NAMES}) WHERE NOT contains(lower(name), 'do not use') GROUP BY name")
def channel_dim(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    names = part.select(F.col("p_partkey").alias("channel"), F.when(F.col("p_partkey") % 7 == 0, F.concat("p_brand", F.lit(" Do Not Use"))).otherwise(F.col("p_brand")).alias("name"))
    return fn.channel_dimension(names).select("channel", "name")


@query(COMBO0.replace("'ch' || a || '|ch' || b AS channels", "'ch' || a % 3 || '|ch' || b % 3 AS channels") + "SELECT channels, dilation, count(*) AS n FROM combos WHERE channel_count = 2 AND hierarchy_level = 0 AND split_part(channels, '|', 1) <> split_part(channels, '|', 2) GROUP BY ALL")
def no_self_pairs(spark, sf_dir):
    """Names are given twice, so some combinations hold a name twice."""
    e = engine(spark, sf_dir)
    e.names = e.channels().select("channel", F.concat(F.lit("ch"), F.col("channel") % 3).alias("name"))
    rows = e.result_tables()["combinations"].where("channel_count = 2 AND hierarchy_level = 0")
    return fn.without_self_pairs(rows).groupBy("channels", "dilation").agg(F.count("*").alias("n"))


VALID_P = f"""
, pass_p AS (SELECT * FROM pairs WHERE r_um = 2.0 AND overlap_coeff >= {FILTER.min_overlap_coeff} AND inter_vox >= {FILTER.min_inter_vox}),
valid_p AS (SELECT a, b, count(*) AS n_tiles FROM pass_p GROUP BY ALL HAVING count(*) >= {FILTER.min_tiles_present}),
pass_s AS (SELECT * FROM sets WHERE r_um = 2.0 AND overlap_coeff >= {FILTER.min_overlap_coeff} AND inter_vox >= {FILTER.min_inter_vox} AND k BETWEEN 2 AND 10),
valid_s AS (SELECT members, count(*) AS n_tiles FROM pass_s GROUP BY ALL HAVING count(*) >= {FILTER.min_tiles_present}),
rank_p AS (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY overlap_coeff DESC, tile_x, tile_y) AS rn, count(*) OVER (PARTITION BY a, b) AS n FROM pass_p SEMI JOIN valid_p USING (a, b) WHERE overlap_coeff > 0),
top_p AS (SELECT a, b, tile_x, tile_y FROM rank_p WHERE rn <= greatest(1, floor(n * {FILTER.top_k_percent}))),
rank_s AS (SELECT *, row_number() OVER (PARTITION BY members ORDER BY overlap_coeff DESC, tile_x, tile_y) AS rn, count(*) OVER (PARTITION BY members) AS n FROM pass_s SEMI JOIN valid_s USING (members) WHERE overlap_coeff > 0),
top_s AS (SELECT members, tile_x, tile_y FROM rank_s WHERE rn <= greatest(1, floor(n * {FILTER.top_k_percent}))),
kept_p AS (SELECT p.* FROM pairs p SEMI JOIN valid_p USING (a, b) LEFT JOIN (SELECT *, 1 AS t FROM top_p) USING (a, b, tile_x, tile_y)
  WHERE r_um <> 2.0 OR (overlap_coeff >= {FILTER.min_overlap_coeff} AND inter_vox >= {FILTER.min_inter_vox} AND (t = 1 OR (a, b) NOT IN (SELECT (a, b) FROM top_p)))),
kept_s AS (SELECT s.* FROM sets s SEMI JOIN valid_s USING (members) LEFT JOIN (SELECT *, 1 AS t FROM top_s) USING (members, tile_x, tile_y)
  WHERE k BETWEEN 2 AND 10 AND (r_um <> 2.0 OR (overlap_coeff >= {FILTER.min_overlap_coeff} AND inter_vox >= {FILTER.min_inter_vox} AND (t = 1 OR members NOT IN (SELECT members FROM top_s)))))
"""


@query(CHAIN + VALID_P + "SELECT a || ',' || b AS members, n_tiles FROM valid_p UNION ALL SELECT array_to_string(members, ','), n_tiles FROM valid_s")
def filter_valid(spark, sf_dir):
    m = engine(spark, sf_dir).mine()
    p = filtering.valid_keys(m.pairs, ["a", "b"], 2.0, FILTER).select(F.concat_ws(",", "a", "b").alias("members"), "n_tiles")
    return p.unionByName(filtering.valid_keys(m.sets, ["members"], 2.0, FILTER).select(F.array_join("members", ",").alias("members"), "n_tiles"))


@query(CHAIN + VALID_P + "SELECT a || ',' || b AS members, tile_x, tile_y FROM top_p UNION ALL SELECT array_to_string(members, ','), tile_x, tile_y FROM top_s")
def filter_topk(spark, sf_dir):
    m = engine(spark, sf_dir).mine()
    p = filtering.top_tiles(m.pairs, ["a", "b"], 2.0, FILTER).select(F.concat_ws(",", "a", "b").alias("members"), "tile_x", "tile_y")
    return p.unionByName(filtering.top_tiles(m.sets, ["members"], 2.0, FILTER).select(F.array_join("members", ",").alias("members"), "tile_x", "tile_y"))


@query(CHAIN + VALID_P + f"SELECT {PAIRS} FROM kept_p")
def filter_apply_pairs(spark, sf_dir):
    e = engine(spark, sf_dir)
    return pairs_out(filtering.apply(e.hold(e.mine().pairs), ["a", "b"], 2.0, FILTER))  # read for validity, for ranks and for the rows


@query(CHAIN + VALID_P + f"SELECT {SETS} FROM kept_s")
def filter_apply_sets(spark, sf_dir):
    e = engine(spark, sf_dir)
    return sets_out(filtering.apply(e.hold(e.mine().sets), ["members"], 2.0, FILTER))


@query(CHAIN + VALID_P + "SELECT *, round(CAST(100 AS DOUBLE) * (pairs_before + sets_before - pairs_after - sets_after) / (pairs_before + sets_before), 9) AS removed_percent FROM (SELECT (SELECT count(*) FROM tiles0) AS tiles_processed, (SELECT count(*) FROM pairs) AS pairs_before, (SELECT count(*) FROM kept_p) AS pairs_after, (SELECT count(*) FROM sets) AS sets_before, (SELECT count(*) FROM kept_s) AS sets_after)")
def filter_stats(spark, sf_dir):
    e = engine(spark, sf_dir)
    m = e.mine()
    after = filtering.apply(m.pairs, ["a", "b"], 2.0, FILTER), filtering.apply(m.sets, ["members"], 2.0, FILTER)
    return filtering.stats(e.tiles(), (m.pairs, m.sets), after).withColumns(r9("removed_percent"))


def stopped_run(spark: SparkSession, sf_dir: str) -> tuple[Engine, str]:
    """A folder of documents as a run leaves it that was stopped after the tiles of every other column."""
    from covoxel.sources.checkpoints import DocumentStore

    e, at = engine(spark, sf_dir), folder(spark, "stopped")
    DocumentStore(spark, at, CFG, e.shape).write(e.mine(e.tiles().where("tile_x % 2 = 1")))
    return e, at


@query(last("SELECT tile_x, tile_y FROM tiles0 WHERE tile_x % 2 = 0"))
def resume_remaining_tiles(spark, sf_dir):
    """Tiles that a stopped run's folder of documents lacks."""
    from covoxel.sources.checkpoints import completed, remaining

    e, at = stopped_run(spark, sf_dir)
    return remaining(e.tiles(), completed(spark, at)).select("tile_x", "tile_y")


@query(last("SELECT count(*) AS n_tiles, min(tile_x) AS min_tile_x, max(tile_x) AS max_tile_x, min(tile_y) AS min_tile_y, max(tile_y) AS max_tile_y FROM tiles0 WHERE tile_x % 2 = 1"))
def checkpoint_stats(spark, sf_dir):
    """Count and ranges of the tiles in a stopped run's folder of documents."""
    from covoxel.sources.checkpoints import completed, stats

    return stats(completed(spark, stopped_run(spark, sf_dir)[1]))


@query(last("SELECT s.tile_x, s.tile_y, s.r_um, array_to_string(s.members, ',') AS members, array_to_string(s.member_vox, ',') AS member_vox, inter_vox FROM sets s"))
def checkpoint_documents(spark, sf_dir):
    """Sets read back from nested tile documents, members' voxels looked up among the documents' string keys."""
    from covoxel.sources.checkpoints import documents, flat

    e = engine(spark, sf_dir)
    rows = flat(documents(e.mine(), e.tiles(), CFG, e.shape.z)).sets
    return rows.select("tile_x", "tile_y", "r_um", F.array_join("members", ",").alias("members"), F.array_join(F.transform("member_vox", lambda v: v.cast("string")), ",").alias("member_vox"), "inter_vox")


@query(COMBO0 + "SELECT hierarchy_level, 16 << hierarchy_level AS tile_size_x, count(*) AS n_channels FROM up_channels GROUP BY ALL")
def metadata_read(spark, sf_dir):
    """The JSON metadata parsed back into rows."""
    levels = engine(spark, sf_dir).result_tables(only=("metadata",))["metadata"].where("key = 'hierarchy_levels'")
    rows = levels.select(F.explode(F.from_json("value", "array<struct<level: int, tile_size_x: int, n_channels: long>>")).alias("v"))
    return rows.select(F.col("v.level").alias("hierarchy_level"), "v.tile_size_x", "v.n_channels")


@query(last("SELECT channel, tile_x, tile_y, size, count(DISTINCT label) AS n FROM sized GROUP BY ALL", chain(FACES)))
def component_sizes_by_faces(spark, sf_dir):
    return engine(spark, sf_dir, FACES).labelled().groupBy("channel", "tile_x", "tile_y", "size").agg(F.countDistinct("label").alias("n"))


LOWRES = """
, low AS (SELECT channel, CAST(y // 2 AS INTEGER) AS y, CAST(x // 2 AS INTEGER) AS x, max(value) AS m FROM vox WHERE y % 2 = 0 AND x % 2 = 0 GROUP BY ALL),
lmip AS (SELECT c.channel, CAST(coalesce(m, 0) AS DOUBLE) AS m FROM chans c CROSS JOIN range(20) yy CROSS JOIN (SELECT unnest(range(w // 2)) AS range FROM dims) xx LEFT JOIN low ON low.channel = c.channel AND low.y = yy.range AND low.x = xx.range),
lcut AS (SELECT channel, quantile_cont(m, 0.98) AS cut FROM lmip GROUP BY ALL),
lbg AS (SELECT channel, m FROM lmip JOIN lcut USING (channel) WHERE m <= cut),
lmu AS (SELECT channel, quantile_cont(m, 0.5) AS mu FROM lbg GROUP BY ALL)
SELECT channel, round(mu, 9) AS mu, round(mad, 9) AS mad FROM (SELECT channel, mu, quantile_cont(abs(m - mu), 0.5) + 1e-6 AS mad FROM lbg JOIN lmu USING (channel) GROUP BY ALL)
"""


@query(CHAIN + LOWRES)
def lowres_thresholds(spark, sf_dir):
    """Global thresholds from a second, coarser volume: every other row and column."""
    e, s = engine(spark, sf_dir), shape(spark, sf_dir)
    low = volume(spark, sf_dir).where("y % 2 = 0 AND x % 2 = 0").withColumns({"y": F.expr("y div 2").cast("int"), "x": F.expr("x div 2").cast("int")})
    from_low = Engine(e.voxels, s, CFG, lowres=low, lowres_shape=Shape(s.z, s.y // 2, s.x // 2))
    return from_low.global_thresholds().select("channel", nine(F.col("mu")).alias("mu"), nine(F.col("mad")).alias("mad"))


def folder(spark: SparkSession, name: str) -> str:
    """A new folder where executors share one, else on this machine."""
    import tempfile
    import uuid

    at = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.gettempdir()
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(last(f"SELECT {PAIRS} FROM pairs"))
def pairs_by_batches(spark, sf_dir):
    """Tiles mined and written in batches, one batch before the rest as by a run that ended early, then read back."""
    from covoxel.plans.runs import run_tiles
    from covoxel.sources.checkpoints import ResultStore

    e = engine(spark, sf_dir)
    store = ResultStore(spark, folder(spark, "store"), CFG)
    store.write(e.mine(e.tiles().where("tile_x = 1")))
    return pairs_out(run_tiles(e, store, batch=max(5, e.tiles().count() // 2)).pairs)


@query(last("SELECT channel, z, y, x, CAST(value AS DOUBLE) AS value FROM vox WHERE channel IN (1, 4) AND y BETWEEN 10 AND 29 AND x >= 20 AND z <> 3"))
def array_region(spark, sf_dir):
    """A region of the volume stored as a chunked array: filters choose the chunks, and what they can't say is left to Spark."""
    from covoxel.sources import zarr

    at, s = folder(spark, "array"), shape(spark, sf_dir)
    zarr.write_array(volume(spark, sf_dir), at, s, 6, (1, 4, 16, 16), "<u4")
    return zarr.read_array(spark, at, channels=(1, 4), y=(10, 30)).where("x >= 20 and z <> 3")


@query(last(f"SELECT {SETS} FROM sets"))
def resume_documents(spark, sf_dir):
    """A run that keeps tile documents, stopped after one batch and resumed by the names of its files."""
    from covoxel.plans.runs import run_tiles
    from covoxel.sources.checkpoints import DocumentStore

    e = engine(spark, sf_dir)
    store = DocumentStore(spark, folder(spark, "resumed"), CFG, e.shape)
    store.write(e.mine(e.tiles().where("tile_x = 1")))
    return sets_out(run_tiles(e, store).sets)


@query(last("SELECT tile_x, tile_y, n_active_channels, n_frequent_pairs FROM summary"))
def snapshot_summary(spark, sf_dir):
    """Every tile written twice by several writes, which the store merges; the last write of a tile counts."""
    from covoxel.operators.mining import Mined
    from covoxel.sources.checkpoints import ResultStore

    e = engine(spark, sf_dir)
    m, store = e.mine(), ResultStore(spark, folder(spark, "snapshots"), CFG, merge_at=2)
    for step in (0, 1, 0):
        part = Mined(*[getattr(m, name).where(f"tile_x % 2 = {step}") for name in ResultStore.PARTS])
        store.write(part)
    return store.read().summary


@query(last(f"SELECT {REGION}, a, b, r_um, a_vox, b_vox, inter_vox, union_vox, round(iou, 9) AS iou, round(overlap_coeff, 9) AS overlap_coeff FROM up_pairs"))
def incremental_rollup(spark, sf_dir):
    """A roll-up kept on disk: of all tiles with wrong counts first, then brought up to date tile column by tile column."""
    from dataclasses import replace

    from covoxel.plans.incremental import RollupStore

    e = engine(spark, sf_dir)
    m, store = e.mine(), RollupStore(spark, folder(spark, "rollup"), CFG)
    m = replace(m, pairs=e.hold(m.pairs), sets=e.hold(m.sets))
    store.update(replace(m, pairs=m.pairs.withColumn("inter_vox", F.col("inter_vox") + 7)))
    for step in (0, 1):
        store.update(mining.Mined(*[getattr(m, name).where(f"tile_x % 2 = {step}") for name in ("channel_stats", "pairs", "sets", "summary")]))
    return store.read()[1].drop("region_x", "region_y").withColumns(r9("iou", "overlap_coeff"))


def written_documents(spark: SparkSession, sf_dir: str) -> str:
    from covoxel.sources.checkpoints import documents, write_tiles

    e, at = engine(spark, sf_dir), folder(spark, "documents")
    write_tiles(documents(e.mine(), e.tiles(), CFG, e.shape.z), at)
    return at


@query(last("SELECT channels, channel_count, dilation, hierarchy_level, total_count, total_union, round(iou, 9) AS iou, round(overlap_coeff, 9) AS overlap_coeff FROM combos"))
def tables_from_documents(spark, sf_dir):
    """The second stage alone: from a folder of tile documents, without the volume."""
    from covoxel.plans.runs import aggregate_folder

    return aggregate_folder(spark, written_documents(spark, sf_dir), CFG)["combinations"].drop("id").withColumns(r9("iou", "overlap_coeff"))


@query(CHAIN + VALID_P + f"SELECT {SETS} FROM kept_s")
def filtered_documents(spark, sf_dir):
    """Documents rewritten with what passes, and read back."""
    from covoxel.plans.runs import filter_folder
    from covoxel.sources.checkpoints import flat, read_json

    target = folder(spark, "filtered")
    filter_folder(spark, written_documents(spark, sf_dir), target, FILTER)
    return sets_out(flat(read_json(spark, target)).sets)


@query(CHAIN + VALID_P + f"SELECT {PAIRS} FROM pairs SEMI JOIN valid_p USING (a, b)")
def filter_all_dilations(spark, sf_dir):
    """Rows of valid pairs at every radius, whatever they are there."""
    every = FilterConfig(**{**FILTER.__dict__, "filter_by_max_dilation": False})
    return pairs_out(filtering.apply(engine(spark, sf_dir).mine().pairs, ["a", "b"], 2.0, every))


@query(last("SELECT 'combinations' AS name, count(*) AS n FROM combos UNION ALL SELECT 'tiles', count(*) FROM combos UNION ALL SELECT 'channel_stats', count(*) FROM up_channels UNION ALL SELECT 'metadata', 4"))
def exchanged_file(spark, sf_dir):
    """Rows of the tables written to one file and read back from it."""
    import os
    import tempfile

    from covoxel.sinks.store import export_sqlite, import_sqlite

    with tempfile.TemporaryDirectory() as at:  # one file on the driver, by its nature
        export_sqlite(engine(spark, sf_dir).result_tables(), os.path.join(at, "t.db.gz"))
        back = import_sqlite(spark, os.path.join(at, "t.db.gz"))
    return spark.createDataFrame([(name, df.count()) for name, df in back.items()], "name string, n long")


@query(last(f"SELECT {PAIRS} FROM pairs"))
def streamed_pairs(spark, sf_dir):
    """Pairs from a stream: tiles are mined when their planes are closed, every fourth column of them, whose ends never come, when it is
    late, and all again after a fifth of the voxels, which comes last."""
    from dataclasses import replace

    from covoxel.sources.checkpoints import ResultStore
    from covoxel.streaming.completion import ARRIVALS, mine_completed, stream_rows

    e, at = engine(spark, sf_dir, replace(CFG, channels=tuple(range(6)))), folder(spark, "stream")
    stamped = lambda df, minute: df.selectExpr("channel", "z", "y", "x", "value", f"timestamp_seconds({60 * minute}) AS ts")
    put = lambda df: df.write.mode("append").parquet(f"{at}/in")
    known = lambda: spark.read.schema(ARRIVALS).parquet(f"{at}/in")
    store, voxels = ResultStore(spark, f"{at}/store", e.cfg), e.voxels.withColumn("value", F.col("value").cast("double"))
    ends = e.tiles().where("tile_x % 4 < 3").selectExpr("explode(sequence(0, 5)) AS channel", "y0 AS y", "x0 AS x").selectExpr("channel", f"explode(sequence(0, {e.shape.z - 1})) AS z", "y", "x", "CAST(NULL AS DOUBLE) AS value")
    clock = spark.range(1).selectExpr(*(f"CAST(NULL AS {c.split()[1]}) AS {c.split()[0]}" for c in ARRIVALS.split(", ")[:5]))
    late = (F.col("x") + F.col("y") + F.col("z")) % 5 == 0
    for frames in ((stamped(voxels.where(~late), 1), stamped(ends, 1)), (stamped(voxels.where(late), 2), stamped(clock, 60))):
        for df in frames:
            put(df)
        mine_completed(stream_rows(spark, f"{at}/in"), e.shape, e.cfg, e.voxels, store, f"{at}/state", known, t_global=e.global_thresholds()).awaitTermination()
    return pairs_out(store.read().pairs)


def stored_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    from covoxel.sinks.store import open_tables, write_parquet

    at = folder(spark, "tables")
    write_parquet(engine(spark, sf_dir).result_tables(), at, bucket_rows=256)
    return open_tables(spark, at)


@query(last("SELECT channels, dilation, hierarchy_level, tile_x0, tile_y0, total_count AS inter_count, total_union AS union_count, round(iou, 9) AS iou FROM (SELECT channels, dilation, total_count, total_union, iou, " + REGION + " FROM combos) WHERE tile_x0 < 3 AND tile_x1 > 1 AND tile_y0 < 2 AND tile_y1 > 0"))
def stored_region(spark, sf_dir):
    """All combinations in a rectangle of tiles, at every level and radius, from the stored tables."""
    from covoxel.sinks.store import in_region

    kept = stored_tables(spark, sf_dir)
    there = in_region(kept["tiles"], (1, 3), (0, 2)).join(kept["combinations"], F.col("combination_id") == F.col("id"))
    return there.select("channels", "dilation", "hierarchy_level", "tile_x0", "tile_y0", "inter_count", "union_count", nine(F.col("iou")).alias("iou"))


@query(COMBO0 + "SELECT channels, region_x AS tile_x0, region_y AS tile_y0, total_count AS inter_count, total_union AS union_count, round(iou, 9) AS iou FROM combos WHERE hierarchy_level = 0 AND dilation = 1.0 AND channels LIKE 'ch2|%'")
def stored_heatmaps(spark, sf_dir):
    """The heat maps of all combinations that begin with a channel, from the stored tables."""
    kept = stored_tables(spark, sf_dir)
    some = kept["combinations"].where("hierarchy_level = 0 AND dilation = 1.0D AND startswith(channels, 'ch2|')")
    return some.join(kept["tiles"], F.col("combination_id") == F.col("id")).select("channels", "tile_x0", "tile_y0", "inter_count", "union_count", nine(F.col("iou")).alias("iou"))


@query("SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, round(sum(value), 6) AS total FROM events GROUP BY ALL")
def event_activity(spark, sf_dir):
    """The windows of streaming.tiles.event_activity over the whole table as a batch."""
    from covoxel.streaming.tiles import event_activity as windows

    out = windows(table(spark, sf_dir, "events"))
    return out.select("event_type", F.to_date("window.start").alias("day"), "n", F.round("total", 6).alias("total"))
