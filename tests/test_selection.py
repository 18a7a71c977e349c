"""Quantiles by selection against Spark's own, and counts over shares of a tile."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from covoxel.operators import mining, selection


def keyed(spark, rows):
    return spark.createDataFrame(rows, "channel int, m double, n long").withColumn("key", selection.order_key("m"))


def test_keys_keep_the_order(spark):
    values = [float("-inf"), -1e308, -2.5, -2.0, -1e-320, -5e-324, 0.0, 5e-324, 1e-320, 0.1, 1.0, 1.0000000000000002, 1e308, float("inf"), float("nan")]
    keys = [r.key for r in keyed(spark, [(0, v, 1) for v in values]).coalesce(1).collect()]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)
    both = keyed(spark, [(0, 0.0, 1), (0, -0.0, 1), (0, None, 1)]).collect()
    assert both[0].key == both[1].key == 0 and both[2].key is None


@pytest.mark.parametrize("p", [0.0, 0.5, 0.98, 1.0])
def test_quantiles_equal_percentile(spark, p):
    rng = np.random.default_rng(7)
    rows = [(0, float(x), int(n)) for x, n in zip(rng.standard_normal(400), rng.integers(0, 5, 400))]
    rows += [(1, float(x), 1) for x in rng.integers(-3, 3, 200)] + [(2, 1.0 + i * 2**-52, 1 + i % 3) for i in range(100)]
    rows += [(3, 4.25, 1), (4, -1.0, 10**12), (4, 1.0, 10**12 - 1), (4, 2.0, 3), (5, 7.0, 0), (6, float(np.float64(2) ** -1070), 1), (6, 1e300, 1), (7, 5.0, 1), (7, 6.0, 1)]
    df = keyed(spark, rows).repartition(5)
    want = {r.channel: r.q for r in df.where("n > 0").groupBy("channel").agg(F.percentile("m", F.lit(p), F.col("n")).alias("q")).collect()}
    got = {r.channel: r.q for r in selection.quantile(df, ["channel"], p, "q").collect()}
    assert got == want and 5 not in got
    assert selection.quantile(df.limit(0), ["channel"], p, "q").count() == 0


def test_a_hot_tile_is_counted_in_shares(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(t, 0, 0, int(w), int(n)) for t in (0, 1) for w, n in zip(rng.choice(1 << 12, 900 if t else 12, replace=False), rng.integers(1, 9, 900))]
    histogram = spark.createDataFrame(rows, "tile_x int, tile_y int, r_idx int, w0 long, n long")
    members = [[0, 1], [0, 2], [3, 7, 11], [0, 1, 2, 3]]
    candidates = spark.createDataFrame([(t, 0, 0, m, m, 5) for t in (0, 1, 2) for m in members], "tile_x int, tile_y int, r_idx int, members array<int>, positions array<int>, other int")
    want = {}
    for t in (0, 1, 2):
        for m in members:
            of = [(w, n) for x, _, _, w, n in rows if x == t]
            mask = sum(1 << i for i in m)
            want[t, tuple(m)] = sum(n for w, n in of if w & mask == mask), sum(n for w, n in of if w & mask)
    for share in (1 << 17, 50):
        monkeypatch.setattr(mining, "SHARE", share)
        out = mining.count_overlaps(candidates, histogram)
        assert {(r.tile_x, tuple(r.members)): (r.inter_vox, r.union_vox) for r in out.collect()} == want and out.columns == ["tile_x", "tile_y", "r_idx", "members", "other", "inter_vox", "union_vox"]
    tasks = {r.tile_x: r.n for r in histogram.groupBy("tile_x").agg(F.ceil(F.count("*") / 50).alias("n")).collect()}
    assert tasks == {0: 1, 1: 18}
