"""Numbers of combinations, however Spark plans and samples the ranges they are dealt by."""

import pytest
from pyspark.sql import functions as F

from covoxel.plans import tables
from covoxel.plans.engine import hold

N = 50_000
SETTINGS = {
    "sampled bounds": {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "8"},
    "joined ranges": {"spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.shuffle.partitions": "200"},
}


@pytest.mark.parametrize("name", list(SETTINGS))
def test_every_combination_has_one_number(name, spark):
    old = {k: spark.conf.get(k, None) for k in SETTINGS[name]}
    for k, v in SETTINGS[name].items():
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        measures = [i.alias("inter_vox"), i.alias("union_vox"), (i / 7).alias("iou"), (i / 3).alias("overlap_coeff"), *[F.lit(0).alias(c) for c in ("tile_x0", "tile_x1", "tile_y0", "tile_y1")]]
        rows = spark.range(N).repartition(2).select((i % 4).cast("int").alias("hierarchy_level"), (i % 97).cast("int").alias("region_x"), (i % 31).cast("int").alias("region_y"), F.lit(1.0).alias("r_um"), i.cast("int").alias("a"), (i + 1).cast("int").alias("b"), *measures)
        sets = rows.limit(0).select("*", F.array("a", "b").alias("members"), F.lit(3).alias("k")).drop("a", "b")
        out = tables.combination_rows(rows, sets, spark.createDataFrame([(0, "ch0")], "channel int, name string"), hold).cache()
        assert out.agg(F.count("*"), F.countDistinct("id"), F.min("id"), F.max("id"), F.countDistinct("inter_vox")).first() == (N, N, 1, N, N)
        out.unpersist()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
