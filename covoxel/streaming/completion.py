"""Tiles of a stream that are mined once they are complete, or once nothing of them has come for a while of event time.

Rows of a stream are voxels (channel, z, y, x, value, ts). A row without a value closes the plane (channel, z) of the tile at (y, x); a row
without a channel only tells the time. What Spark keeps of a tile is a bit for each of its planes and three numbers, not its voxels: these stay in
the files that the stream reads.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from covoxel.config import EngineConfig
from covoxel.operators.tiling import Shape
from covoxel.plans.engine import Engine
from covoxel.plans.runs import batch_size, batches
from covoxel.sources.checkpoints import ResultStore

ARRIVALS = "channel int, z int, y int, x int, value double, ts timestamp"
SEEN = "tile_x int, tile_y int, ts timestamp, closed array<int>"
TOLD = "tile_x int, tile_y int, complete boolean, time int"
#: Rows that a task puts together at a time.
TOGETHER = 1 << 19
#: The state store that timers and several states of a key need.
PROVIDER, ROCKS = "spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Completion(StatefulProcessor):
    """Tells a tile when its last plane is closed, or `patience` milliseconds of event time after its newest row; and again, once it is
    quiet, if rows came after it was told. Repeated rows change nothing but that."""

    def __init__(self, planes: int, patience: int):
        self.planes, self.patience = planes, patience

    def init(self, handle) -> None:
        self.handle = handle
        self.tile = handle.getValueState("tile", "closed binary, newest long, timer long, time int")

    def _get(self) -> tuple[np.ndarray, int, int, int]:
        found = self.tile.get()  # one call of the worker's state server, as each method here
        if found is None:
            return np.zeros(self.planes, np.uint8), 0, -1, 0
        closed, *rest = found
        return np.unpackbits(np.frombuffer(closed, np.uint8), count=self.planes), *map(int, rest)

    def _put(self, closed: np.ndarray, newest: int, timer: int, time: int) -> None:
        self.tile.update((np.packbits(closed).tobytes(), newest, timer, time))

    def _told(self, key: tuple, closed: np.ndarray, time: int) -> pd.DataFrame:
        return pd.DataFrame({"tile_x": [key[0]], "tile_y": [key[1]], "complete": [bool(closed.all())], "time": [time]})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        if key[0] < 0:
            return
        closed, newest, timer, time = self._get()
        before = closed.all()
        for part in rows:
            newest = max(newest, int(part["ms"].max()))
            for planes in part["closed"]:
                closed[np.asarray(planes, dtype=np.int64)] = 1
        if timer >= 0:
            self.handle.deleteTimer(timer)
        if closed.all() and not before:
            self._put(closed, newest, -1, time + 1)
            yield self._told(key, closed, time + 1)
        else:
            self.handle.registerTimer(newest + self.patience)
            self._put(closed, newest, newest + self.patience, time)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        closed, newest, _, time = self._get()
        self._put(closed, newest, -1, time + 1)
        yield self._told(key, closed, time + 1)


def arrivals(rows: DataFrame, shape: Shape, cfg: EngineConfig) -> DataFrame:
    """What comes of each tile: its newest ts and the numbers of the planes that are closed. A task puts its rows together before the
    shuffle, so that it sends a row for each tile and not one for each voxel; more only if more than TOGETHER / 2 tiles and planes are apart."""
    pos = F.array_position(F.array(*map(F.lit, sorted(cfg.channels))), F.col("channel")).cast("int") - 1
    inside = (pos >= 0) & F.col("z").between(0, shape.z - 1)
    plane = F.when(F.col("value").isNull() & inside, pos * shape.z + F.col("z"))
    tile = lambda axis, n: F.coalesce(F.when(F.col("channel").isNotNull(), F.expr(f"{axis} div {n}")), F.lit(-1)).cast("int")
    placed = rows.select(tile("x", cfg.tile_x).alias("tile_x"), tile("y", cfg.tile_y).alias("tile_y"), "ts", plane.alias("plane"))

    def one_of(rows: list[pa.Table]) -> pa.Table:
        keys = ["tile_x", "tile_y", "plane"]
        return pa.concat_tables(rows).group_by(keys, use_threads=False).aggregate([("ts", "max")]).select([*keys, "ts_max"]).rename_columns([*keys, "ts"])

    def by_tile(rows: pa.Table) -> list[pa.RecordBatch]:
        seen = rows.group_by(["tile_x", "tile_y"], use_threads=False).aggregate([("ts", "max"), ("plane", "distinct", pc.CountOptions(mode="only_valid"))])
        return seen.select(["tile_x", "tile_y", "ts_max", "plane_distinct"]).rename_columns(["tile_x", "tile_y", "ts", "closed"]).to_batches()

    def together(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[pa.Table] = []
        for b in chain(parts, [None]):
            if b is not None:
                rows.append(pa.Table.from_batches([b]).select(["tile_x", "tile_y", "plane", "ts"]))
            if rows and (b is None or sum(r.num_rows for r in rows) >= TOGETHER):
                rows = [one_of(rows)]
                if b is None or rows[0].num_rows > TOGETHER // 2:
                    yield from by_tile(rows.pop())

    return placed.mapInArrow(together, SEEN)


def completed_tiles(rows: DataFrame, shape: Shape, cfg: EngineConfig, patience: str = "10 minutes", late: str = "1 minute") -> DataFrame:
    """tile_x, tile_y, complete (all planes were closed), time (how often it was told): a stream of tiles to be mined.

    late is the watermark's delay. No row is dropped as too late: the time of a row is a number from here on, so that a row behind the
    watermark has its tile told once more.
    """
    if not cfg.channels:
        raise ValueError("a stream's channels must be given, or no tile is ever complete")
    wait = pd.Timedelta(patience) // pd.Timedelta("1ms")
    seen = arrivals(rows, shape, cfg).withWatermark("ts", late).select("tile_x", "tile_y", F.unix_millis("ts").alias("ms"), "closed")
    return seen.groupBy("tile_x", "tile_y").transformWithStateInPandas(Completion(len(cfg.channels) * shape.z, wait), TOLD, "append", "eventTime")


def newest(rows: DataFrame) -> DataFrame:
    """The voxels among rows of a stream: of those at one place the one with the newest ts, then with the largest value."""
    place = ["channel", "z", "y", "x"]
    stored = rows.where("channel is not null and value is not null").repartition("channel", "y", "x")  # one exchange for both aggregations; a column stays together
    largest = stored.groupBy(*place, "ts").agg(F.max("value").alias("value"))
    return largest.groupBy(*place).agg(F.max_by("value", F.coalesce(F.unix_micros("ts"), F.lit(-(1 << 63)))).alias("value"))


def mine_completed(rows: DataFrame, shape: Shape, cfg: EngineConfig, lowres: DataFrame, store: ResultStore, state: str, all_rows: Callable[[], DataFrame], batch: int | None = None, t_global: DataFrame | None = None, **waits: str) -> StreamingQuery:
    """Mine tiles as completed_tiles() tells them, from all rows known of them, and replace their results.

    Of all_rows() only the told tiles are read, in batches of `batch` tiles, by default by their size as in a run, since each batch reads
    the files that may have some of its tiles; a batch's voxels are held, so that they are found once. A batch that runs again after a failure writes its
    tiles again; the newest of a tile counts. Thresholds come from a fixed low-resolution volume, so that a tile's result depends on its own voxels only; they are taken once, unless
    t_global has them (global_thresholds() of that volume).
    """
    fixed = {} if t_global is None else {"global": t_global}  # what all batches share

    def mine(told: DataFrame, _: int) -> None:
        tiles = told.select("tile_x", "tile_y").distinct().coalesce(1)  # they come to the driver, by one job
        engine = Engine(newest(all_rows()), shape, cfg, lowres=lowres, block=(1, 1), _made=fixed)
        for part in batches(tiles, batch or batch_size(engine)):
            now = engine.only(part)
            store.write(now.mine())
            now.release()

    with_state(rows.sparkSession)
    found = completed_tiles(rows, shape, cfg, **waits)
    return found.writeStream.foreachBatch(mine).outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).start()


def stream_rows(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def with_state(spark: SparkSession) -> None:
    """Let a session's streams keep states in RocksDB, which spills to disk and is checkpointed, unless another provider is set."""
    if "HDFSBacked" in spark.conf.get(PROVIDER, "HDFSBacked"):
        spark.conf.set(PROVIDER, ROCKS)
