"""Incremental analysis: tiles are mined as their voxels arrive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from covoxel.config import EngineConfig
from covoxel.operators.tiling import Shape, with_tiles
from covoxel.plans.engine import Engine
from covoxel.plans.runs import batches
from covoxel.sources.checkpoints import ResultStore

VOXELS = "channel int, z int, y int, x int, value double"


def stream_voxels(spark: SparkSession, path: str, files_per_trigger: int = 64) -> DataFrame:
    return spark.readStream.schema(VOXELS).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def mine_stream(voxels: DataFrame, shape: Shape, cfg: EngineConfig, lowres: DataFrame, store: ResultStore, state: str, all_voxels: Callable[[], DataFrame], batch: int = 1024) -> StreamingQuery:
    """Mine every tile that a micro-batch touches, from all voxels known of it, and replace its results.

    Thresholds come from a fixed low-resolution volume, so that a tile's result depends on its own voxels only. A batch that
    runs again after a failure writes its tiles again as a newer version, and only the newest of a tile counts. Voxels that
    arrive late mine their tile again. Of all_voxels() only the touched tiles are read: batches of them become filters of the scan.
    """

    def mine(rows: DataFrame, _: int) -> None:
        touched = with_tiles(rows, cfg).select("tile_x", "tile_y").distinct()
        engine = Engine(all_voxels(), shape, cfg, lowres=lowres)
        for part in batches(touched, batch):
            store.write(engine.only(part).mine())

    return voxels.writeStream.foreachBatch(mine).option("checkpointLocation", state).trigger(availableNow=True).start()


def event_activity(events: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Events per type and window, with a watermark: the arrival rate of a stream of sparse voxels."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
