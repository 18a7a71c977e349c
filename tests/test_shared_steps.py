"""Steps that many queries share read and hold no more than they need."""

from dataclasses import replace

from covoxel.config import EngineConfig
from covoxel.operators import thresholds
from covoxel.operators.tiling import Shape
from covoxel.plans import catalog, runs


def test_rounds_of_quantiles_read_counts(spark):
    voxels = spark.range(10_000).selectExpr("0 AS channel", "0 AS z", "CAST(id div 100 AS INT) AS y", "CAST(id % 100 AS INT) AS x", "id % 3 + 1 AS value")
    held = []
    out = thresholds.global_thresholds(voxels, Shape(1, 100, 100), replace(EngineConfig(), trim_q=1.0), lambda df: held.append(df) or df).first()
    assert out.mu == 2.0 and max(df.count() for df in held) == 3


def test_only_the_tables_asked_for_are_held(spark, sf):
    e = catalog.engine(spark, sf)
    e.mine()
    before = len(e._held)
    assert list(e.result_tables(only=("channel_stats",))) == ["channel_stats"] and len(e._held) == before + 1
    e.release()


def test_voxels_below_their_channels_threshold_are_not_shuffled(spark):
    voxels = spark.range(400).selectExpr("CAST(id % 2 AS INT) AS channel", "0 AS z", "CAST(id div 20 AS INT) AS y", "CAST(id % 20 AS INT) AS x", "id % 50 AS value", "CAST(id % 20 div 10 AS INT) AS tile_x", "0 AS tile_y")
    t_global = spark.createDataFrame([(0, 20.0), (1, 35.0)], "channel int, t_global double")
    tiles = spark.createDataFrame([(c, x, 0, float(t)) for c, x, t in ((0, 0, 20), (0, 1, 44), (1, 0, 35), (1, 1, 47))], "channel int, tile_x int, tile_y int, t_final double")
    plain, early = thresholds.foreground(voxels, tiles), thresholds.foreground(voxels, tiles, t_global)
    rows = lambda df: sorted(map(tuple, df.select(voxels.columns).collect()))
    assert rows(early) == rows(plain) and len(rows(plain)) > 0
    assert "__least" in early._jdf.queryExecution().optimizedPlan().toString()


def test_batches_share_the_tiles_thresholds(spark, sf, monkeypatch):
    e = catalog.engine(spark, sf)
    whole = sorted(map(tuple, e.tile_thresholds().where("tile_x = 1").collect()))
    monkeypatch.setattr(thresholds, "tile_thresholds", None)  # may not be called again
    batch = e.only(e.tiles().where("tile_x = 1"))
    assert sorted(map(tuple, batch.tile_thresholds().collect())) == whole and whole
    e.release()


def test_small_tiles_are_mined_by_more(spark, sf):
    e = catalog.engine(spark, sf)
    assert runs.batch_size(e) * 7 * 16 * 16 * 6 <= runs.BATCH_VOXELS < (runs.batch_size(e) + 1) * 7 * 16 * 16 * 6
    assert runs.batch_size(replace(e, shape=Shape(1 << 20, 40, 56))) == runs.BATCH_TILES
    e.release()
