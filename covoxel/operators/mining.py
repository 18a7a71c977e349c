"""Which channels overlap: pairs and larger sets per tile and radius."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covoxel.config import MAX_ITEMS_FOR_K4, MAX_PAIRS_FOR_SETS, MAX_SETS, WORD_BITS, EngineConfig
from covoxel.operators.proximity import within

TILE = ["tile_x", "tile_y"]
#: Signatures that are a matrix of bits at a time; signatures of a tile that one task counts, about.
STEP, SHARE = 1 << 13, 1 << 17
#: A tile of at most SMALL signatures at a radius is counted together with its neighbours in a square of 2 ** SIDE, at all radii.
SMALL, SIDE = 1 << 11, 2


@dataclass(frozen=True)
class Mined:
    """What one run of the miner returns, all flat: see the functions below for columns."""

    channel_stats: DataFrame
    pairs: DataFrame
    sets: DataFrame
    summary: DataFrame


def ratio(n: Column, d: Column) -> Column:
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def channel_stats(prox: DataFrame, inside: DataFrame, tiles: DataFrame, channels: DataFrame, radii: DataFrame, cfg: EngineConfig) -> DataFrame:
    """tile_x, tile_y, channel, r_idx, r_um, voxel_count, sum_intensity for every tile, channel and radius.

    prox: distances; inside: the voxels, with value, of the smallest radius's mask, whose sum of intensities stands at every
    radius. Counts for all radii come from one aggregation.
    """
    counts = prox.groupBy(*TILE, "channel").agg(*[F.count(F.when(within(r), 1)).alias(f"n{i}") for i, r in enumerate(cfg.dilate_um)])
    by_r = F.array(*[F.col(f"n{i}") for i in range(len(cfg.dilate_um))])
    counts = counts.select(*TILE, "channel", by_r.alias("counts"))
    sums = inside.groupBy(*TILE, "channel").agg(F.sum(F.col("value").cast("double")).alias("sum_intensity"))
    spine = tiles.select(*TILE).crossJoin(F.broadcast(channels.select("channel")))  # one row per channel
    out = spine.join(counts, [*TILE, "channel"], "left").join(sums, [*TILE, "channel"], "left").crossJoin(F.broadcast(radii.select("r_idx", "r_um")))  # one row per radius
    return out.select(*TILE, "channel", "r_idx", "r_um", F.coalesce(F.get("counts", F.col("r_idx")), F.lit(0).cast("long")).alias("voxel_count"), F.coalesce("sum_intensity", F.lit(0.0)).alias("sum_intensity"))


def active_markers(stats: DataFrame, radii: DataFrame) -> DataFrame:
    return stats.join(F.broadcast(radii.select("r_idx", "min_marker")), "r_idx").where("voxel_count >= min_marker").drop("min_marker")


def signatures(masked: DataFrame, n_channels: int) -> DataFrame:
    """tile_x, tile_y, r_idx, w0.. (a bit for each channel position), n: voxels with that combination of channels.

    masked carries `pos`, the channel's position. Voxels with the same combination collapse before anything is joined.
    """
    words = [f"w{i}" for i in range(-(-n_channels // WORD_BITS) or 1)]
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % WORD_BITS).cast("int"))
    parts = [F.bit_or(F.when(F.floor(F.col("pos") / WORD_BITS) == i, bit).otherwise(F.lit(0).cast("long"))).alias(w) for i, w in enumerate(words)]
    voxel = masked.groupBy(*TILE, "r_idx", "z", "y", "x").agg(*parts)
    return voxel.groupBy(*TILE, "r_idx", *words).agg(F.count("*").alias("n"))


def counts_of(histogram: DataFrame, channels: DataFrame) -> DataFrame:
    """tile_x, tile_y, r_idx, channel, pos, voxel_count, from the histogram of signatures() instead of the voxels. channels: channel, pos."""
    words = [c for c in histogram.columns if c.startswith("w")]
    word = F.get(F.array(*words), F.floor(F.col("pos") / WORD_BITS).cast("int"))
    bit = F.call_function("shiftright", word, (F.col("pos") % WORD_BITS).cast("int")).bitwiseAND(1)
    every = histogram.crossJoin(F.broadcast(channels.select("channel", "pos"))).where(bit == 1)  # one row per channel
    return every.groupBy(*TILE, "r_idx", "channel", "pos").agg(F.sum("n").alias("voxel_count"))


def signatures_by_distance(prox: DataFrame, n_channels: int, cfg: EngineConfig) -> DataFrame:
    """The histogram of signatures() for every radius, from distances that carry `pos`.

    A voxel is shuffled once per channel, not once per channel and radius: all radii's words are aggregated side by
    side, and only then, when a voxel is one row, dealt out by radius.
    """
    n_words = -(-n_channels // WORD_BITS) or 1
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("pos") % WORD_BITS).cast("int"))
    mine = lambda i, r: (F.floor(F.col("pos") / WORD_BITS) == i) & within(r)
    parts = [F.bit_or(F.when(mine(i, r), bit).otherwise(F.lit(0).cast("long"))).alias(f"w{i}_{j}") for i in range(n_words) for j, r in enumerate(cfg.dilate_um)]
    voxel = prox.groupBy(*TILE, "z", "y", "x").agg(*parts)
    per_r = [F.struct(F.lit(j).alias("r_idx"), *[F.col(f"w{i}_{j}").alias(f"w{i}") for i in range(n_words)]) for j in range(len(cfg.dilate_um))]
    words = [f"w{i}" for i in range(n_words)]
    dealt = voxel.select(*TILE, F.explode(F.array(*per_r)).alias("s")).select(*TILE, "s.*")
    some = reduce(lambda a, b: a | b, [F.col(w) != 0 for w in words])
    return dealt.where(some).groupBy(*TILE, "r_idx", *words).agg(F.count("*").alias("n"))


def count_overlaps(candidates: DataFrame, histogram: DataFrame) -> DataFrame:
    """candidates (tile_x, tile_y, r_idx, members, positions and any others) with inter_vox and union_vox, from the histogram.

    Signatures become a matrix of bits; candidates that differ in their last member alone are one product of a vector with it:
    the voxels that have all members, and, of the complements, those that have none. Doubles hold these counts exactly.

    A tile's signatures are dealt into shares of about SHARE, each counted against all its candidates by a task of its own, and the shares' counts
    are added up: so a tile of any size spreads over the cluster. Small tiles come many at a time, and are counted one after the other. Both sides of a task are
    bounded, by SHARE, or SMALL for each tile and radius of a square, and the candidate limits.
    """
    words = [c for c in histogram.columns if c.startswith("w")]
    kept = [(c, t) for c, t in candidates.dtypes if c != "positions"]
    keys = [*TILE, "r_idx"]

    def sorted_parts(rows: pa.Table, names: list[str]) -> tuple[pa.Table, dict[tuple, tuple[int, int]]]:
        """rows by tile and radius, and where those of each stand."""
        of = [rows.column(c).to_numpy() for c in names]
        order = np.lexsort(of[::-1])
        of = [k[order] for k in of]
        starts = np.flatnonzero(np.concatenate([np.ones(min(1, len(order)), bool), np.any([k[1:] != k[:-1] for k in of], axis=0)]))
        ends = np.append(starts, len(order))[1:]
        return rows.take(pa.array(order)), {tuple(int(k[s]) for k in of): (int(s), int(e)) for s, e in zip(starts, ends, strict=True)}

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        left, wanted = sorted_parts(left, keys)
        right, found = sorted_parts(right, [f"of_{k}" for k in keys])
        counts = [count(left.slice(s, e - s), right.slice(at[0], at[1] - at[0])) for key, (s, e) in wanted.items() for at in [found.get(key, (0, 0))]]
        out = left.select([c for c, _ in kept])
        for i, name in enumerate(("inter_vox", "union_vox")):
            out = out.append_column(name, pa.array(np.concatenate([np.zeros(0), *[c[i] for c in counts]]).astype(np.int64)))
        return out

    def count(left: pa.Table, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        by_prefix: dict[tuple[int, ...], list[tuple[int, int]]] = {}
        for row, at in enumerate(left.column("positions").to_pylist()):
            by_prefix.setdefault(tuple(at[:-1]), []).append((row, at[-1]))
        inter, union = np.zeros(left.num_rows), np.zeros(left.num_rows)
        for s in range(0, right.num_rows, STEP):
            part = right.slice(s, STEP)
            bits = np.concatenate([(part.column(w).to_numpy()[:, None] >> np.arange(WORD_BITS)) & 1 for w in words], axis=1).astype(np.float64)
            n = part.column("n").to_numpy().astype(np.float64)
            for prefix, ends in by_prefix.items():
                rows, last = (list(x) for x in zip(*ends, strict=True))
                every, none = n.copy(), n.copy()
                for p in prefix:
                    every *= bits[:, p]
                    none *= 1 - bits[:, p]
                inter[rows] += every @ bits[:, last]
                union[rows] += n.sum() - none @ (1 - bits[:, last])
        return inter, union

    schema = ", ".join(f"{c} {t}" for c, t in kept) + ", inter_vox long, union_vox long"
    named = histogram.withColumnsRenamed({k: f"of_{k}" for k in keys})  # both sides may come from the same rows
    shares = histogram.groupBy(*keys).agg(F.ceil(F.count("*") / SHARE).cast("int").alias("shares"), (F.count("*") <= SMALL).alias("small"))
    dealt = shares.withColumnsRenamed({k: f"in_{k}" for k in keys})
    same = [F.col(f"of_{k}") == F.col(f"in_{k}") for k in keys]

    def unit(tile_x: str, tile_y: str, r_idx: str, share: Column) -> list[Column]:
        """What is counted by one task: a share, or the small tiles of a square."""
        square = [F.call_function("shiftright", F.col(c), F.lit(SIDE)) for c in (tile_x, tile_y)] + [F.lit(-1), F.lit(-1)]
        return [F.when(F.col("small"), a).otherwise(b).alias(f"unit_{i}") for i, (a, b) in enumerate(zip(square, [F.col(tile_x), F.col(tile_y), F.col(r_idx), share], strict=True))]

    units = [f"unit_{i}" for i in range(4)]
    right = named.join(dealt, same).select(*named.columns, *unit(*[f"of_{k}" for k in keys], F.pmod(F.xxhash64(*words), F.col("shares")).cast("int")))
    left = candidates.join(shares, keys, "left").withColumn("small", F.coalesce("small", F.lit(True)))
    left = left.withColumn("share", F.explode(F.sequence(F.lit(0), F.coalesce("shares", F.lit(1)) - 1))).select(*candidates.columns, *unit(*keys, F.col("share")))
    partial = left.groupBy(*units).cogroup(right.groupBy(*units)).applyInArrow(run, schema)
    return partial.groupBy(*[c for c, _ in kept]).agg(F.sum("inter_vox").alias("inter_vox"), F.sum("union_vox").alias("union_vox"))


def active_pairs(active: DataFrame) -> DataFrame:
    """Pairs a < b of channels active in the same tile at the same radius, with their voxel counts."""
    a = active.select(*TILE, "r_idx", F.col("channel").alias("a"), F.col("pos").alias("pa"), F.col("voxel_count").alias("a_vox"))
    b = active.select(*TILE, "r_idx", F.col("channel").alias("b"), F.col("pos").alias("pb"), F.col("voxel_count").alias("b_vox"))
    out = a.join(b, [*TILE, "r_idx"]).where("a < b")
    return out.withColumns({"members": F.array("a", "b"), "positions": F.array("pa", "pb")})


def frequent_pairs(active: DataFrame, histogram: DataFrame, radii: DataFrame, last: int) -> DataFrame:
    """Pairs active at the largest radius whose intersection there reaches min_pair."""
    least = radii.where(F.col("r_idx") == last).select("r_idx", "min_pair")
    top = active_pairs(active.where(F.col("r_idx") == last))
    found = count_overlaps(top, histogram.where(F.col("r_idx") == last)).join(F.broadcast(least), "r_idx").where("inter_vox >= min_pair")
    return found.select(*TILE, "a", "b", "members")


def sweep_alive(spine: DataFrame, eligible: DataFrame, stop: bool) -> DataFrame:
    """Tiles and radii, from the largest down, before the first radius at which nothing is eligible."""
    flags = spine.join(eligible.select(*TILE, "r_idx").distinct().withColumn("any", F.lit(1)), [*TILE, "r_idx"], "left")
    if not stop:
        return flags.where("any = 1").select(*TILE, "r_idx")
    down = Window.partitionBy(*TILE).orderBy(F.desc("r_idx")).rowsBetween(Window.unboundedPreceding, 0)
    return flags.withColumn("alive", F.min(F.coalesce("any", F.lit(0))).over(down)).where("alive = 1").select(*TILE, "r_idx")


def pair_rows(frequent: DataFrame, active: DataFrame, histogram: DataFrame, radii: DataFrame, spine: DataFrame, cfg: EngineConfig) -> DataFrame:
    """tile_x, tile_y, r_idx, r_um, a, b, a_vox, b_vox, inter_vox, union_vox, iou, overlap_coeff."""
    eligible = active_pairs(active).join(frequent.select(*TILE, "a", "b"), [*TILE, "a", "b"], "left_semi")
    alive = sweep_alive(spine, eligible, cfg.aggressive_stop_on_fail)
    eligible = eligible.join(alive, [*TILE, "r_idx"], "left_semi")
    out = count_overlaps(eligible, histogram).join(F.broadcast(radii.select("r_idx", "r_um", "min_pair")), "r_idx").where("inter_vox >= min_pair")
    least = F.least("a_vox", "b_vox")
    return out.select(*TILE, "r_idx", "r_um", "a", "b", "a_vox", "b_vox", "inter_vox", "union_vox", ratio(F.col("inter_vox"), F.col("union_vox")).alias("iou"), ratio(F.col("inter_vox"), least).alias("overlap_coeff"))


def set_candidates(frequent: DataFrame, max_size: int) -> DataFrame:
    """tile_x, tile_y, k, members: sets of three channels and more of which every pair is frequent.

    Gates, in this order: none where a tile has over 5,000 frequent pairs; only k = 3 where these hold over 50 channels; the
    first 10,000 by k and members. Cliques grow by one channel behind the last that is paired with all members: the join is
    on the last member, and each other pair is one more equi-join.
    """
    per_tile = frequent.groupBy(*TILE).agg(F.count("*").alias("n_pairs"), F.size(F.array_distinct(F.flatten(F.collect_set("members")))).alias("n_items"))
    edges = frequent.join(per_tile, TILE).where(F.col("n_pairs") <= MAX_PAIRS_FOR_SETS)
    pairs = edges.select(*TILE, F.col("a").alias("u"), F.col("b").alias("v"), "n_items")
    cliques = edges.select(*TILE, "members", "n_items")
    found = []
    for k in range(3, max_size + 1):
        grown = cliques.where(F.lit(k == 3) | (F.col("n_items") <= MAX_ITEMS_FOR_K4)).withColumn("u", F.element_at("members", -1)).join(pairs.drop("n_items"), [*TILE, "u"]).drop("u").withColumnRenamed("v", "new")
        for i in range(k - 2):
            edge = pairs.select(*TILE, F.col("u").alias("m"), F.col("v").alias("new"))
            grown = grown.withColumn("m", F.get("members", F.lit(i))).join(edge, [*TILE, "m", "new"], "left_semi").drop("m")
        cliques = grown.select(*TILE, F.concat("members", F.array("new")).alias("members"), "n_items")
        found.append(cliques.select(*TILE, F.lit(k).alias("k"), "members"))
    if not found:
        return frequent.select(*TILE, F.lit(0).alias("k"), "members").limit(0)
    every = reduce(DataFrame.unionByName, found)
    first = Window.partitionBy(*TILE).orderBy("k", "members")
    return every.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= MAX_SETS).drop("rank")


def set_rows(candidates: DataFrame, active: DataFrame, histogram: DataFrame, radii: DataFrame, spine: DataFrame, cfg: EngineConfig) -> DataFrame:
    """tile_x, tile_y, r_idx, r_um, k, members, member_vox, inter_vox, union_vox, iou, overlap_coeff."""
    here = active.groupBy(*TILE, "r_idx").agg(F.map_from_entries(F.collect_list(F.struct("channel", F.struct("pos", "voxel_count")))).alias("on"))  # one entry per channel
    eligible = candidates.join(here, TILE).where(F.forall("members", lambda m: F.map_contains_key("on", m)))
    eligible = eligible.withColumns({"positions": F.transform("members", lambda m: F.element_at("on", m)["pos"]), "member_vox": F.transform("members", lambda m: F.element_at("on", m)["voxel_count"])}).drop("on")
    alive = sweep_alive(spine, eligible, cfg.aggressive_stop_on_fail)
    eligible = eligible.join(alive, [*TILE, "r_idx"], "left_semi")
    out = count_overlaps(eligible, histogram).join(F.broadcast(radii.select("r_idx", "r_um", "min_set")), "r_idx").where("inter_vox >= min_set")
    return out.select(*TILE, "r_idx", "r_um", "k", "members", "member_vox", "inter_vox", "union_vox", ratio(F.col("inter_vox"), F.col("union_vox")).alias("iou"), ratio(F.col("inter_vox"), F.array_min("member_vox")).alias("overlap_coeff"))


def summary(tiles: DataFrame, active: DataFrame, frequent: DataFrame, last: int) -> DataFrame:
    """tile_x, tile_y, n_active_channels (at the largest radius), n_frequent_pairs."""
    a = active.where(F.col("r_idx") == last).groupBy(*TILE).agg(F.count("*").alias("n_active_channels"))
    f = frequent.groupBy(*TILE).agg(F.count("*").alias("n_frequent_pairs"))
    out = tiles.select(*TILE).join(a, TILE, "left").join(f, TILE, "left")
    return out.fillna(0, ["n_active_channels", "n_frequent_pairs"])


def mine(prox: DataFrame, inside: DataFrame, tiles: DataFrame, channels: DataFrame, radii: DataFrame, cfg: EngineConfig, hold=lambda df: df) -> Mined:
    """prox: channel, tile_x, tile_y, z, y, x, min_d2; inside: voxels with value in the smallest mask; channels: channel,
    pos. hold() may write and reread what is used more than once: the statistics, the histogram and the frequent pairs."""
    last = len(cfg.dilate_um) - 1
    n_channels = channels.count()
    positions = F.broadcast(channels.select("channel", "pos"))  # one row per channel
    stats = hold(channel_stats(prox, inside, tiles, channels, radii, cfg))
    histogram = hold(signatures_by_distance(prox.join(positions, "channel"), n_channels, cfg))
    active = active_markers(stats, radii).join(positions, "channel")
    frequent = hold(frequent_pairs(active, histogram, radii, last))
    spine = tiles.select(*TILE).crossJoin(F.broadcast(radii.select("r_idx")))
    pairs = pair_rows(frequent, active, histogram, radii, spine, cfg)
    sets = set_rows(set_candidates(frequent, cfg.max_set_size), active, histogram, radii, spine, cfg)
    return Mined(stats, pairs, sets, summary(tiles, active, frequent, last))
