"""Tiles of a stream are mined when they are complete, or late."""

from dataclasses import replace
from itertools import product

import pytest
from pyspark.sql import functions as F

from covoxel.config import EngineConfig
from covoxel.operators.tiling import Shape
from covoxel.plans.engine import Engine
from covoxel.sources.checkpoints import ResultStore
from covoxel.streaming import completion
from covoxel.streaming.completion import ARRIVALS, arrivals, completed_tiles, mine_completed, newest, stream_rows, with_state
from tests import test_operators
from tests.test_operators import random_volume

SHAPE = Shape(3, 6, 7)
CFG = replace(test_operators.CFG, channels=(0, 1, 2))


def at(minute):
    return F.timestamp_seconds(F.lit(1_700_000_000 + 60 * minute))


def rows_of(spark, cells, minute):
    return spark.createDataFrame([(*c, None) for c in cells], ARRIVALS).withColumn("ts", at(minute))


def closing(spark, tiles, minute, but=()):
    """The ends of all planes of tiles (tile_x, tile_y), but of those (channel, z) named."""
    planes = [p for p in product(CFG.channels, range(SHAPE.z)) if p not in but]
    return rows_of(spark, [(c, z, ty * CFG.tile_y, tx * CFG.tile_x, None) for tx, ty in tiles for c, z in planes], minute)


def clock(spark, minute):
    return rows_of(spark, [(None, None, None, None, None)], minute)


class Told:
    """A stream of tiles told, file by file; every run is a restart from the checkpoint."""

    def __init__(self, spark, tmp_path):
        self.spark, self.path, self.n, self.told = spark, tmp_path, 0, []
        with_state(spark)

    def after(self, *frames):
        for f in frames:
            f.coalesce(1).write.mode("append").parquet(str(self.path / "in"))
        before = len(self.told)
        found = completed_tiles(stream_rows(self.spark, str(self.path / "in"), 1), SHAPE, CFG, "10 minutes", "1 minute")
        run = found.writeStream.foreachBatch(lambda df, _: self.told.extend(map(tuple, df.collect()))).option("checkpointLocation", str(self.path / "state")).trigger(availableNow=True).start()
        run.awaitTermination()
        return sorted(self.told[before:])


def test_tiles_are_told_when_complete_or_late_and_again_after_late_rows(spark, tmp_path):
    s = Told(spark, tmp_path)
    voxel = lambda minute: rows_of(spark, [(0, 0, 0, 0, 5.0)], minute)
    assert s.after(voxel(0), closing(spark, [(0, 0)], 0, but=[(2, 2)]), closing(spark, [(1, 0)], 1)) == [(1, 0, True, 1)]
    assert s.after(closing(spark, [(0, 0)], 2)) == [(0, 0, True, 1)]  # the state outlives the restart, repeated ends do nothing
    assert s.after(closing(spark, [(0, 1)], 3, but=[(0, 0)]), clock(spark, 12)) == []
    assert s.after(clock(spark, 30)) == [(0, 1, False, 1)]  # ten minutes after its last row
    assert s.after(closing(spark, [(0, 1)], 4)) == [(0, 1, True, 2)]  # far behind the watermark
    assert s.after(voxel(5)) == [(0, 0, True, 2)]  # late and quiet


def test_streamed_results_equal_a_batch_with_late_and_repeated_voxels(spark, tmp_path):
    _, v = random_volume(spark)
    store, inlet = ResultStore(spark, str(tmp_path / "store"), CFG), str(tmp_path / "in")
    tiles = [(x, y) for x in range(-(-SHAPE.x // CFG.tile_x)) for y in range(-(-SHAPE.y // CFG.tile_y))]
    put = lambda df: df.coalesce(1).write.mode("append").parquet(inlet)
    placed = v.selectExpr("channel", "z", "y", "x", "cast(value as double) value")

    def run():
        known = lambda: spark.read.schema(ARRIVALS).parquet(inlet)
        mine_completed(stream_rows(spark, inlet, 8), SHAPE, CFG, v, store, str(tmp_path / "state"), known, patience="10 minutes").awaitTermination()

    early = placed.where("(x + y + z) % 5 > 0")
    put(early.withColumn("value", F.col("value") + 1).withColumn("ts", at(0)))  # corrected by a later row
    put(early.withColumn("ts", at(1)).unionAll(closing(spark, tiles[1:], 1)))
    run()
    assert store.done().count() == len(tiles) - 1
    put(placed.where("(x + y + z) % 5 = 0").withColumn("ts", at(2)))
    put(early.withColumn("ts", at(1)))
    put(clock(spark, 60))
    run()
    assert store.done().count() == len(tiles)
    want = Engine(v, SHAPE, CFG, lowres=v).mine()
    for name in ("pairs", "sets", "channel_stats"):
        cols = [c for c in getattr(want, name).columns if c != "r_idx"]
        assert sorted(map(str, getattr(store.read(), name).select(cols).collect())) == sorted(map(str, getattr(want, name).select(cols).collect()))


def test_voxels_are_put_together_before_the_shuffle(spark):
    seen = arrivals(rows_of(spark, [(0, 0, 0, x % 2, 1.0) for x in range(50)] + [(1, 2, 0, 0, None)] * 3 + [(7, 0, 0, 0, None), (None,) * 5], 0).coalesce(1), SHAPE, CFG)
    got = sorted((r.tile_x, r.tile_y, r.closed) for r in seen.collect())
    assert got == [(-1, -1, []), (0, 0, [1 * SHAPE.z + 2])]


def test_a_task_puts_all_its_batches_together(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    seen = arrivals(rows_of(spark, [(0, 0, 0, x % 2, 1.0) for x in range(50)] + [(c, 2, 0, 0, None) for c in (0, 1, 2, 0)], 0).coalesce(1), SHAPE, CFG)
    assert sorted((r.tile_x, r.tile_y, sorted(r.closed)) for r in seen.collect()) == [(0, 0, [2, 5, 8])]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_tiles_told_at_once_are_mined_by_their_size_and_their_voxels_found_once(spark, tmp_path, monkeypatch):
    cells = [(0, 0, i // 40, i % 40, 1.0 + i % 7) for i in range(1100)]
    rows_of(spark, cells, 0).coalesce(1).write.parquet(str(tmp_path / "in"))
    monkeypatch.setattr(completion, "completed_tiles", lambda rows, *_, **__: rows.selectExpr("x AS tile_x", "y AS tile_y"))
    monkeypatch.setattr(Engine, "mine", lambda self: self)
    mined = []

    class Store:
        def write(self, e):
            mined.append((e.subset.count(), e.voxels.count(), len(e._held)))

    known = lambda: spark.read.schema(ARRIVALS).parquet(str(tmp_path / "in"))
    mine_completed(stream_rows(spark, str(tmp_path / "in")), Shape(1, 40, 40), replace(CFG, tile_xy=(1, 1)), newest(known()), Store(), str(tmp_path / "state"), known).awaitTermination()
    assert mined == [(1100, 1100, 1)]


def test_the_newest_of_repeated_voxels_counts_and_filters_reach_the_scan(spark, tmp_path):
    rows = rows_of(spark, [(0, 0, 0, 0, 5.0), (0, 0, 0, 1, 2.0), (0, 0, 0, 1, 3.0)], 0).unionAll(rows_of(spark, [(0, 0, 0, 0, 4.0), (0, 0, 0, 0, None)], 1))
    assert sorted((r.x, r.value) for r in newest(rows).collect()) == [(0, 4.0), (1, 3.0)]
    rows.write.parquet(str(tmp_path / "r"))
    plan = newest(spark.read.parquet(str(tmp_path / "r"))).where("x < 1")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(x,1)" in plan


def test_a_stream_needs_its_channels(spark):
    with pytest.raises(ValueError):
        completed_tiles(spark.createDataFrame([], ARRIVALS), SHAPE, EngineConfig())
