"""Counts of channels are read from the histogram of their combinations."""

from pyspark.sql import functions as F

from covoxel.operators import mining
from covoxel.plans import catalog


def test_counts_from_the_histogram(spark):
    rows = spark.range(700).selectExpr("CAST(id % 3 AS INT) AS tile_x", "0 AS tile_y", "0 AS r_idx", "CAST(id % 70 AS INT) AS channel", "0 AS z", "0 AS y", "id div 7 AS x")
    channels = spark.range(70).selectExpr("CAST(id AS INT) AS channel", "CAST(id AS INT) AS pos")
    histogram = mining.signatures(rows.unionAll(rows).join(channels, "channel"), 70)
    keys = ["tile_x", "tile_y", "r_idx", "channel"]
    want = rows.distinct().groupBy(*keys).agg(F.count("*").alias("n"))
    got = mining.counts_of(histogram, channels).select(*keys, "voxel_count")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_lines_of_an_order_are_held_nowhere(spark, sf, monkeypatch):
    held, real = [], catalog.Engine.hold
    monkeypatch.setattr(catalog.Engine, "hold", lambda e, df: held.append(df.columns) or real(e, df))
    catalog.basket_pairs(spark, sf)
    assert held and all("channel" not in columns for columns in held)
