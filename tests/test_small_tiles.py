"""Small tiles are counted many at a time, with the results of each alone."""

from pyspark.sql import functions as F

from covoxel.operators import mining


def test_small_tiles_are_counted_together(spark, monkeypatch):
    i = F.col("id")
    tile = [(i % 5).cast("int").alias("tile_x"), (i % 3).cast("int").alias("tile_y"), (i % 2).cast("int").alias("r_idx")]
    histogram = spark.range(900).select(*tile, (i % 7 + 1).alias("w0"), (i % 11).alias("n")).groupBy("tile_x", "tile_y", "r_idx", "w0").agg(F.sum("n").alias("n")).cache()
    near = {(i % 5, i % 3, i % 2) for i in range(30)} | {(9, 9, 0)}  # one without signatures
    sets = [(*t, m, m) for t in near for m in ([0, 1], [0, 2], [1, 2], [0, 1, 2])]
    pairs = spark.createDataFrame(sets, "tile_x int, tile_y int, r_idx int, members array<int>, positions array<int>")

    def counted(small, share):
        monkeypatch.setattr(mining, "SMALL", small)
        monkeypatch.setattr(mining, "SHARE", share)
        out = mining.count_overlaps(pairs, histogram)
        assert "unit_0" in out._jdf.queryExecution().optimizedPlan().toString()
        return sorted((tuple(r.members), r.tile_x, r.tile_y, r.r_idx, r.inter_vox, r.union_vox) for r in out.collect())

    want = []
    rows = [r.asDict() for r in histogram.collect()]
    for p in pairs.collect():
        here = [(r["w0"], r["n"]) for r in rows if (r["tile_x"], r["tile_y"], r["r_idx"]) == (p.tile_x, p.tile_y, p.r_idx)]
        bits = sum(1 << m for m in p.members)
        want.append((tuple(p.members), p.tile_x, p.tile_y, p.r_idx, sum(n for w, n in here if w & bits == bits), sum(n for w, n in here if w & bits)))
    assert counted(1 << 11, 1 << 17) == counted(0, 1 << 17) == counted(0, 2) == counted(6, 2) == sorted(want)
