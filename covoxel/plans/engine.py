"""The analysis from voxels to result tables, as DataFrame stages."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covoxel.config import EngineConfig
from covoxel.functions.names import default_names
from covoxel.operators import components, mining, proximity, thresholds, tiling
from covoxel.operators.tiling import Shape
from covoxel.plans import tables

Stage = Callable[[DataFrame], DataFrame]


def hold(df: DataFrame) -> DataFrame:
    """df written to the folder that executors share (spark.checkpoint.dir), so that it outlives them; cached where the session
    names none, as in tests."""
    spark = df.sparkSession
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        return df.cache()
    path = f"{at.rstrip('/')}/engine-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._held_at = path
    return out


def let_go(df: DataFrame) -> None:
    """Drop what hold() has kept; nothing may read it again."""
    if at := getattr(df, "_held_at", None):
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    else:
        df.unpersist()


@dataclass
class Engine:
    """One analysis of one volume.

    voxels: channel, z, y, x, value (absent = 0). lowres, with its shape, is what global thresholds are taken from; by
    default the volume itself. Every method is lazy; what several steps read is cached by `hold`, or written to the folder that
    executors share (spark.checkpoint.dir) if the session names one. segment: a replacement for thresholds to masks. block: the
    sides (y, x) of what the source of voxels reads in one piece, if a read is costly, as of compressed arrays: then every batch of tiles reads its voxels
    once, holds them, and consists of whole pieces (see batch_unit), so that no piece is read for two batches.
    """

    voxels: DataFrame
    shape: Shape
    cfg: EngineConfig
    lowres: DataFrame | None = None
    lowres_shape: Shape | None = None
    names: DataFrame | None = None
    segment: Stage | None = None
    subset: DataFrame | None = None
    block: tuple[int, int] | None = None
    _made: dict = field(default_factory=dict)
    _held: list = field(default_factory=list)

    def __post_init__(self) -> None:
        if self.cfg.channels:
            self.voxels = self.voxels.where(F.col("channel").isin(list(self.cfg.channels)))
        if not {"tile_x", "tile_y"} <= set(self.voxels.columns):
            self.voxels = tiling.with_tiles(self.voxels, self.cfg)
        self.spark = self.voxels.sparkSession

    def only(self, tiles: DataFrame) -> Engine:
        """The same analysis of some tiles (a bounded batch): their voxels alone are read, and the rest is as in the whole.

        Global thresholds, channels and names are shared, and the tiles' thresholds, if the global ones come from the volume itself. The bounds of the batch are filters on y and x that reach the scan,
        and on tile_x and tile_y, which prune folders where the volume is stored by tile.
        """
        part = tiles.select("tile_x", "tile_y")
        box = part.agg(F.min("tile_x"), F.max("tile_x"), F.min("tile_y"), F.max("tile_y")).first()
        voxels = self.voxels
        if box[0] is not None:
            x, y = (box[0], box[1]), (box[2], box[3])
            voxels = voxels.where(F.col("x").between(x[0] * self.cfg.tile_x, (x[1] + 1) * self.cfg.tile_x - 1) & F.col("y").between(y[0] * self.cfg.tile_y, (y[1] + 1) * self.cfg.tile_y - 1))
            voxels = voxels.where(F.col("tile_x").between(*x) & F.col("tile_y").between(*y))
        made = {"global": self.global_thresholds(), "channels": self.channels()}
        if "projections" in self._made:  # those of the whole are known, and so are its tiles' thresholds
            known = self.tile_thresholds()
            made["tile_t"] = known.join(F.broadcast(part), ["tile_x", "tile_y"], "left_semi").select(*known.columns)  # a batch of tiles
        out = replace(self, voxels=voxels.join(F.broadcast(part), ["tile_x", "tile_y"], "left_semi"), subset=part, _made=made, _held=[])  # a batch of tiles
        if self.block:
            out.voxels = out.hold(out.voxels)
        return out

    def batch_unit(self) -> tuple[int, int] | None:
        """The tiles (down, across) that make up whole pieces of the source, if it has such."""
        if self.block is None:
            return None
        return math.lcm(self.block[0], self.cfg.tile_y) // self.cfg.tile_y, math.lcm(self.block[1], self.cfg.tile_x) // self.cfg.tile_x

    def hold(self, df: DataFrame) -> DataFrame:
        self._held.append(hold(df))
        return self._held[-1]

    def release(self) -> None:
        """Drop what this analysis holds; its frames can't be read any more."""
        for df in self._held:
            let_go(df)
        self._held.clear()
        self._made.clear()

    def _once(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        if name not in self._made:
            self._made[name] = make()
        return self._made[name]

    def channels(self) -> DataFrame:
        """channel, pos: positions from 0 in order of channel; one row each."""

        def make() -> DataFrame:
            if self.cfg.channels:
                return self.spark.createDataFrame([(c, i) for i, c in enumerate(sorted(self.cfg.channels))], "channel int, pos int")
            found = sorted(r[0] for r in thresholds.channel_dim(self.voxels, self.cfg).collect())  # one row per channel
            return self.spark.createDataFrame([(c, i) for i, c in enumerate(found)], "channel int, pos int")

        return self._once("channels", make)

    def channel_names(self) -> DataFrame:
        return self.names if self.names is not None else default_names(self.channels())

    def radii(self) -> DataFrame:
        return tiling.radii(self.spark, self.cfg)

    def tiles(self) -> DataFrame:
        grid = tiling.tile_grid(self.spark, self.shape, self.cfg)
        return grid if self.subset is None else grid.join(self.subset, ["tile_x", "tile_y"], "left_semi")

    def n_tiles(self) -> int:
        if self.subset is not None:
            return self.subset.count()
        return -(-self.shape.y // self.cfg.tile_y) * -(-self.shape.x // self.cfg.tile_x)

    def projections(self) -> DataFrame:
        """Those of the volume; thresholds of the whole and of tiles come from one aggregation of its voxels."""
        return self._once("projections", lambda: self.hold(thresholds.projections(self.voxels, self.shape)))

    def global_thresholds(self) -> DataFrame:
        source, stored = (self.voxels, self.projections) if self.lowres is None else (self.lowres, lambda: None)
        return self._once("global", lambda: thresholds.global_thresholds(source, self.lowres_shape or self.shape, self.cfg, self.hold, stored()))

    def tile_thresholds(self) -> DataFrame:
        def make() -> DataFrame:
            t_global = self.global_thresholds()  # with the projections, if it is taken from the volume itself
            return self.hold(thresholds.tile_thresholds(self.voxels, t_global, self.shape, self.cfg, self.subset, self._made.get("projections")))

        return self._once("tile_t", make)

    def foreground(self) -> DataFrame:
        if self.segment is not None:
            return self.voxels.transform(self.segment)
        return thresholds.foreground(self.voxels, self.tile_thresholds(), self.global_thresholds())

    def _regions(self) -> DataFrame:
        """Labels and distances come from one pass over each channel of a tile."""
        return self._once("regions", lambda: self.hold(components.regions(self.foreground(), self.shape, self.cfg)))

    def labelled(self) -> DataFrame:
        return self._regions().where("label is not null").drop("min_d2")

    def objects(self) -> DataFrame:
        return components.keep_large(self.labelled(), self.cfg)

    def proximity(self) -> DataFrame:
        return self._regions().where("min_d2 is not null").select(*components.KEYS, "z", "y", "x", "min_d2")

    def masks(self) -> DataFrame:
        return proximity.masks(self.proximity(), self.cfg)

    def innermost(self) -> DataFrame:
        """The voxels, with value, of the smallest radius's mask: the objects' own if that radius is 0."""
        if self.cfg.dilate_um[0] == 0 and self.segment is None:
            return self.objects()
        near = self.proximity().where(proximity.within(self.cfg.dilate_um[0]))
        return near.join(self.voxels.select("channel", "z", "y", "x", "value"), ["channel", "z", "y", "x"])

    def tile_outputs(self) -> DataFrame:
        """Per channel and tile: thresholds and component statistics."""
        return self.tile_thresholds().join(components.component_stats(self.labelled(), self.cfg), ["channel", "tile_x", "tile_y"], "left").fillna(0, ["n_components"]).fillna(self.cfg.min_voxels, ["min_voxels"])

    def mine(self, tiles: DataFrame | None = None) -> mining.Mined:
        """Mine all tiles, or a batch of them, of which alone anything is computed."""
        if tiles is not None:
            return self.only(tiles).mine()
        return self._once("mined", lambda: mining.mine(self.proximity(), self.innermost(), self.tiles(), self.channels(), self.radii(), self.cfg, self.hold))

    def rollup(self, mined: mining.Mined | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
        return tables.roll_up(mined or self.mine(), self.cfg)

    def result_tables(self, mined: mining.Mined | None = None, only: tuple[str, ...] = tables.TABLES) -> dict[str, DataFrame]:
        return tables.result_tables(mined or self.mine(), self.channel_names(), self.shape, self.cfg, self.hold, only)
