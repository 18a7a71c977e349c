"""Connected components inside a tile, and the size filter."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covoxel.config import EngineConfig
from covoxel.operators.proximity import nearest
from covoxel.operators.tiling import Shape

KEYS = ["channel", "tile_x", "tile_y"]
#: Voxels of tiles, stored or not, that are an array at a time; a larger tile is one alone.
CELLS = 1 << 20


def half_offsets(connectivity: int) -> list[tuple[int, int, int]]:
    """One of each pair of opposite neighbour offsets (z, y, x): 3 for faces, 13 for all."""
    every = [o for o in product((-1, 0, 1), repeat=3) if o > (0, 0, 0)]
    return [o for o in every if connectivity == 26 or sum(map(abs, o)) == 1]


def label(z: np.ndarray, y: np.ndarray, x: np.ndarray, connectivity: int) -> np.ndarray:
    """For each voxel the number of the first voxel of its component. Voxels are distinct.

    Edges are found by binary search of shifted positions; roots by repeated hooking to the least neighbour and halving of paths.
    """
    if not len(z):
        return np.zeros(0, np.int64)
    z, y, x = (a.astype(np.int64) - a.min() + 1 for a in (z, y, x))
    ny, nx = y.max() + 2, x.max() + 2
    place = (z * ny + y) * nx + x
    order = np.argsort(place, kind="stable")
    sorted_place = place[order]
    a, b = [], []
    for dz, dy, dx in half_offsets(connectivity):
        want = sorted_place + (dz * ny + dy) * nx + dx
        at = np.minimum(np.searchsorted(sorted_place, want), len(place) - 1)
        hit = np.flatnonzero(sorted_place[at] == want)
        a.append(hit)
        b.append(at[hit])
    a, b = np.concatenate(a), np.concatenate(b)
    root = np.arange(len(place))
    while len(a):
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            up = new[new]
            if (up == new).all():
                break
            new = up
        if (new == root).all():
            break
        root = new
    out = np.empty(len(place), np.int64)
    out[order] = order[root]
    return out


def _labelled(rows: pa.Table, connectivity: int, apart: np.ndarray | int = 0) -> tuple[pa.Table, np.ndarray]:
    """rows with label and size, and the sizes. apart: planes by which groups are moved away from each other, if rows are of several."""
    z, y, x = (rows.column(c).to_numpy().astype(np.int64) for c in "zyx")
    first = label(z + apart, y, x, connectivity)
    _, back, size = np.unique(first, return_inverse=True, return_counts=True)
    packed = (z << 42) | (y << 21) | x
    return rows.append_column("label", pa.array(packed[first])).append_column("size", pa.array(size[back])), size[back]


def _groups(rows: pa.Table | pa.RecordBatch) -> np.ndarray:
    """Where a group begins; rows are sorted by KEYS."""
    keys = [rows.column(c).to_numpy() for c in KEYS]
    return np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in keys], axis=0)]))


def whole_groups(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Sorted batches as tables of one whole group or more: what a batch ends with waits for the next one."""
    held: list[pa.RecordBatch] = []
    for b in chain(parts, [None]):
        if b is not None and not b.num_rows:
            continue
        cut = 0 if b is None else int(_groups(b)[-1])
        same = b is not None and held and all(held[-1].column(c)[-1] == b.column(c)[0] for c in KEYS)
        done = [*held, b.slice(0, cut)] if cut else [] if same else held
        if done:
            yield pa.Table.from_batches(done)
        if b is not None:
            held = [*held, b] if same and not cut else [b.slice(cut)]


def components(fg: DataFrame, cfg: EngineConfig) -> DataFrame:
    """fg with label and size. A label is the position (z, y, x packed) of one voxel of the component.

    A group is one channel of one tile, bounded by the tile's voxels; components end at its border, so no edge
    crosses groups and one exchange by (channel, tile) suffices.
    """
    connectivity = cfg.connectivity

    def run(rows: pa.Table) -> pa.Table:
        return _labelled(rows, connectivity)[0]

    schema = ", ".join(f"{c} {t}" for c, t in fg.dtypes) + ", label long, size long"
    return fg.groupBy(*KEYS).applyInArrow(run, schema)


def regions(fg: DataFrame, shape: Shape, cfg: EngineConfig) -> DataFrame:
    """components() and, of those of min_voxels or more, proximity.proximity(), from one exchange and one pass over each
    channel of a tile: fg's columns, label, size and min_d2. Rows of fg have a null min_d2; rows with a min_d2 are all voxels
    within reach, with nulls elsewhere but for their place. Small groups are computed many at a time, side by side in one array of CELLS at most."""
    connectivity, least = cfg.connectivity, cfg.min_voxels
    many = max(1, CELLS // (shape.z * cfg.tile_y * cfg.tile_x))

    def run(rows: pa.Table, starts: np.ndarray) -> pa.Table:
        of = np.repeat(np.arange(len(starts)), np.diff([*starts, rows.num_rows]))
        out, size = _labelled(rows, connectivity, of * (shape.z + 1))
        out = out.append_column("min_d2", pa.nulls(len(size), pa.float64()))
        kept = size >= least
        if not kept.any():
            return out
        key = dict(zip(KEYS, (rows.column(c).to_numpy()[starts] for c in KEYS), strict=True))
        y0, x0 = key["tile_y"] * cfg.tile_y, key["tile_x"] * cfg.tile_x
        z, y, x = (rows.column(c).to_numpy() for c in "zyx")
        (at, z, y, x), d2 = nearest([a[kept] for a in (of, z, y - y0[of], x - x0[of])], [0, 0, 0, 0], [len(starts) - 1, shape.z - 1, cfg.tile_y - 1, cfg.tile_x - 1], cfg)
        y, x = y + y0[at], x + x0[at]
        inside = (y < shape.y) & (x < shape.x)
        near = {c: a[inside] for c, a in ({c: k[at] for c, k in key.items()} | {"z": z, "y": y, "x": x, "min_d2": d2}).items()}
        n = int(inside.sum())
        cols = [pa.array(near[f.name].astype(f.type.to_pandas_dtype())) if f.name in near else pa.nulls(n, f.type) for f in out.schema]
        return pa.concat_tables([out, pa.table(cols, schema=out.schema)])

    def task(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(parts):
            starts = _groups(rows)
            for i in range(0, len(starts), many):
                here = starts[i : i + many]
                end = starts[i + many] if i + many < len(starts) else rows.num_rows
                yield from run(rows.slice(here[0], end - here[0]), here - here[0]).to_batches(max_chunksize=1 << 16)

    schema = ", ".join(f"{c} {t}" for c, t in fg.dtypes) + ", label long, size long, min_d2 double"
    return fg.repartition(*KEYS).sortWithinPartitions(*KEYS).mapInArrow(task, schema)


def keep_large(labelled: DataFrame, cfg: EngineConfig) -> DataFrame:
    """Voxels of components of min_voxels or more."""
    return labelled.where(F.col("size") >= cfg.min_voxels).drop("label", "size")


def component_stats(labelled: DataFrame, cfg: EngineConfig) -> DataFrame:
    return labelled.groupBy(*KEYS).agg(F.countDistinct("label").alias("n_components"), F.lit(cfg.min_voxels).alias("min_voxels"))

