"""Combinations and tiles stay whole on each way that they are published, also where AQE joins the ranges by which they are numbered."""

import pytest
from pyspark.sql import functions as F

from covoxel.plans import tables
from covoxel.plans.engine import hold
from covoxel.sinks.store import export_sqlite, import_sqlite, in_region, open_tables, write_parquet

N = 20_000
JOINED = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.shuffle.partitions": "50"}


@pytest.fixture
def made(spark):
    old = {k: spark.conf.get(k, None) for k in JOINED}
    for k, v in JOINED.items():
        spark.conf.set(k, v)
    i = F.col("id")
    place = [(i % 97).cast("int").alias("tile_x0"), (i % 97 + 1).cast("int").alias("tile_x1"), (i % 31).cast("int").alias("tile_y0"), (i % 31 + 1).cast("int").alias("tile_y1")]
    measures = [i.alias("inter_vox"), i.alias("union_vox"), (i / 7).alias("iou"), (i / 3).alias("overlap_coeff")]
    pairs = spark.range(N).repartition(2).select(F.lit(0).alias("hierarchy_level"), (i % 97).cast("int").alias("region_x"), (i % 31).cast("int").alias("region_y"), F.lit(1.0).alias("r_um"), i.cast("int").alias("a"), (i + 1).cast("int").alias("b"), *measures, *place)
    sets = pairs.limit(0).select("*", F.array("a", "b").alias("members"), F.lit(3).alias("k")).drop("a", "b")
    rows = tables.combination_rows(pairs, sets, spark.createDataFrame([(0, "ch0")], "channel int, name string"), hold)
    stats = spark.createDataFrame([("ch0", 0, 1.0, 0, 0, 1, 0, 1, 1, 1.0, 1.0)], "channel string, channel_idx int, dilation double, hierarchy_level int, tile_x0 int, tile_x1 int, tile_y0 int, tile_y1 int, voxel_count long, sum_intensity double, mean_intensity double")
    yield {"metadata": spark.createDataFrame([("channels", "[]")], "key string, value string"), "combinations": tables.combinations_table(rows), "tiles": tables.tiles_table(rows), "channel_stats": stats}
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def linked(made):
    return made["combinations"].join(made["tiles"], F.col("id") == F.col("combination_id"))


def test_each_combination_has_its_tile(made):
    both = linked(made)
    assert both.agg(F.count("*"), F.countDistinct("inter_count"), F.count_if(F.col("inter_count") != F.col("total_count"))).first() == (N, N, 0)


def test_a_region_of_the_stored_tables_is_whole(made, spark, tmp_path):
    write_parquet(made, f"{tmp_path}/t")
    kept = open_tables(spark, f"{tmp_path}/t")
    there = in_region(kept["tiles"], (1, 3), (0, 2)).join(kept["combinations"], F.col("combination_id") == F.col("id"))
    want = sum(i % 97 in (1, 2) and i % 31 in (0, 1) for i in range(N))
    assert there.agg(F.count("*"), F.countDistinct("inter_count"), F.count_if(F.col("inter_count") != F.col("total_count"))).first() == (want, want, 0)


def test_heat_maps_of_the_stored_tables_are_whole(made, spark, tmp_path):
    write_parquet(made, f"{tmp_path}/t", bucket_rows=N // 4)
    kept = open_tables(spark, f"{tmp_path}/t")
    maps = kept["combinations"].where("hierarchy_level = 0 AND dilation = 1.0D").join(kept["tiles"], F.col("id") == F.col("combination_id"))
    assert maps.agg(F.count("*"), F.countDistinct("inter_count"), F.count_if(F.col("inter_count") != F.col("total_count"))).first() == (N, N, 0)


def test_the_exchanged_file_has_all_rows(made, spark, tmp_path):
    export_sqlite(made, f"{tmp_path}/t.db.gz")
    back = import_sqlite(spark, f"{tmp_path}/t.db.gz")
    assert {name: df.count() for name, df in back.items()} == {"metadata": 1, "combinations": N, "tiles": N, "channel_stats": 1}
