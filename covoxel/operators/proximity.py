"""Distances to the nearest object voxel, up to the largest radius, inside the tile."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covoxel.config import EngineConfig
from covoxel.operators.tiling import Shape

KEYS = ["channel", "tile_x", "tile_y"]
#: Squared distances are compared with this relative slack, so exact multiples of a voxel size count as equal.
SLACK = 1e-6


def nearest(place: list[np.ndarray], low: list[int], high: list[int], cfg: EngineConfig) -> tuple[list[np.ndarray], np.ndarray]:
    """The voxels (z, y, x) of a box within the largest radius of the given ones, and their squared distances. A number before z tells
    boxes apart that lie side by side: nothing is near across them.

    The squared Euclidean distance separates: least over x, then y, then z of what came before plus the offset's square, each
    as shifts of the dense box around the given voxels, which lies within the tile.
    """
    r = max(cfg.dilate_um)
    limit = r * r * (1 + SLACK)
    steps = [float(s) for s in (cfg.voxel_size.z, cfg.voxel_size.y, cfg.voxel_size.x)]
    reach = [0] * (len(place) - 3) + [math.floor(r / s * (1 + SLACK)) for s in steps]
    first = [max(lo, int(p.min()) - k) for p, lo, k in zip(place, low, reach, strict=True)]
    ends = [min(hi, int(p.max()) + k) for p, hi, k in zip(place, high, reach, strict=True)]
    now = np.full([e - f + 1 for f, e in zip(first, ends, strict=True)], np.inf)
    now[tuple(p - f for p, f in zip(place, first, strict=True))] = 0.0
    for axis in (-1, -2, -3):
        before, now = now, now.copy()
        b, n = np.moveaxis(before, axis, 0), np.moveaxis(now, axis, 0)
        for k in range(1, min(reach[axis], len(b) - 1) + 1):
            d = float(k) * steps[axis]
            np.minimum(n[k:], b[:-k] + d * d, out=n[k:])
            np.minimum(n[:-k], b[k:] + d * d, out=n[:-k])
        now[now > limit] = np.inf
    at = np.nonzero(now <= limit)
    return [a + f for a, f in zip(at, first, strict=True)], now[at]


def bounds(tile_x: int, tile_y: int, shape: Shape, cfg: EngineConfig) -> tuple[list[int], list[int]]:
    """First and last (z, y, x) of a tile, clipped to the volume."""
    y, x = tile_y * cfg.tile_y, tile_x * cfg.tile_x
    return [0, y, x], [shape.z - 1, min(y + cfg.tile_y, shape.y) - 1, min(x + cfg.tile_x, shape.x) - 1]


def proximity(fg: DataFrame, depth: int, height: int, width: int, cfg: EngineConfig) -> DataFrame:
    """channel, tile_x, tile_y, z, y, x, min_d2 (square micrometres) of every voxel within the largest radius. One exchange
    by (channel, tile); a group is one channel of one tile."""
    shape = Shape(depth, height, width)

    def run(rows: pa.Table) -> pa.Table:
        channel, tx, ty = (rows.column(c)[0].as_py() for c in KEYS)
        place, d2 = nearest([rows.column(c).to_numpy() for c in "zyx"], *bounds(tx, ty, shape, cfg), cfg)
        return rows_of(channel, tx, ty, place, d2)

    return fg.select(*KEYS, "z", "y", "x").groupBy(*KEYS).applyInArrow(run, "channel int, tile_x int, tile_y int, z int, y int, x int, min_d2 double")


def rows_of(channel: int, tile_x: int, tile_y: int, place: list[np.ndarray], d2: np.ndarray) -> pa.Table:
    keys = [pa.array(np.full(len(d2), k, dtype=np.int32)) for k in (channel, tile_x, tile_y)]
    return pa.table([*keys, *(pa.array(p.astype(np.int32)) for p in place), pa.array(d2)], names=[*KEYS, "z", "y", "x", "min_d2"])


def within(r: float, d2: str = "min_d2") -> Column:
    return F.col(d2) <= r * r * (1 + SLACK)


def masks(prox: DataFrame, cfg: EngineConfig) -> DataFrame:
    """One row per voxel and radius within reach: masks are nested in r. For export and inspection; statistics and
    signatures are taken from the distances without this blow-up."""
    reached = F.array(*[F.when(within(r), F.struct(F.lit(i).alias("r_idx"), F.lit(r).alias("r_um"))) for i, r in enumerate(cfg.dilate_um)])
    out = prox.withColumn("r", F.explode(F.filter(reached, lambda x: x.isNotNull())))
    return out.select(*[c for c in prox.columns if c != "min_d2"], "r.r_idx", "r.r_um")
