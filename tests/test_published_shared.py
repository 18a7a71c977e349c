"""The published tables are whole where what is held is written and read back, as by hold() on a cluster with a shared folder."""

import uuid

import pytest
from pyspark.sql import functions as F

from covoxel.config import EngineConfig
from covoxel.operators.mining import Mined
from covoxel.operators.tiling import Shape
from covoxel.plans import tables
from covoxel.sinks.store import export_sqlite, import_sqlite, in_region, open_tables, write_parquet

N = 20_000
SETTINGS = {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.shuffle.partitions": "50"}


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")

    def hold(df):  # a session's spark.checkpoint.dir can't be set once it runs
        df.write.parquet(path := f"{shared}/{uuid.uuid4().hex}")
        return spark.read.schema(df.schema).parquet(path)

    old = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    i = F.col("id")
    tile = [(i % 97).cast("int").alias("tile_x"), (i % 31).cast("int").alias("tile_y"), F.lit(1.0).alias("r_um")]
    counts = [i.alias(c) for c in ("inter_vox", "union_vox")]
    pairs = spark.range(N).repartition(2).select(*tile, i.cast("int").alias("a"), (i + 1).cast("int").alias("b"), i.alias("a_vox"), i.alias("b_vox"), *counts)
    sets = spark.range(0).select(*tile, F.array(i.cast("int")).alias("members"), F.lit(3).alias("k"), F.array(i).alias("member_vox"), *counts)
    stats = spark.range(5).select(*tile, F.lit(0).alias("channel"), i.alias("voxel_count"), i.cast("double").alias("sum_intensity"))
    names = spark.createDataFrame([(0, "ch0")], "channel int, name string")
    yield tables.result_tables(Mined(stats, pairs, sets, None), names, Shape(1, 496, 1552), EngineConfig(tile_xy=(16, 16), hierarchy_levels=1), hold)
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def whole(linked, n):
    return linked.agg(F.count("*"), F.countDistinct("inter_count"), F.count_if(F.col("inter_count") != F.col("total_count"))).first() == (n, n, 0)


def test_tiles(made):
    assert whole(made["combinations"].join(made["tiles"], F.col("id") == F.col("combination_id")), N)


def test_stored_region(made, spark, tmp_path):
    write_parquet(made, f"{tmp_path}/t", bucket_rows=N // 4)
    kept = open_tables(spark, f"{tmp_path}/t")
    there = in_region(kept["tiles"], (90, 92), (0, 2)).join(kept["combinations"], F.col("combination_id") == F.col("id"))
    assert whole(there, sum(i % 97 in (90, 91) and i % 31 in (0, 1) for i in range(N)))


def test_stored_heat_maps(made, spark, tmp_path):
    write_parquet(made, f"{tmp_path}/t", bucket_rows=N // 4)
    kept = open_tables(spark, f"{tmp_path}/t")
    some = kept["combinations"].where("hierarchy_level = 0 AND dilation = 1.0D AND startswith(channels, 'ch1')")
    assert whole(some.join(kept["tiles"], F.col("id") == F.col("combination_id")), sum(str(i).startswith("1") for i in range(N)))


def test_exchanged_file_of_several_reads(made, spark, tmp_path):
    export_sqlite(made, f"{tmp_path}/t.db.gz")
    back = import_sqlite(spark, f"{tmp_path}/t.db.gz", rows=N // 3)
    assert {name: df.count() for name, df in back.items()} == {"metadata": 4, "combinations": N, "tiles": N, "channel_stats": 5}
