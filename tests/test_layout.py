"""Result tables at rest are laid out for lookups by name and by region."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from covoxel.plans import sql, tables
from covoxel.sinks.store import DDL, in_region, open_tables, place, read_parquet, write_parquet

N = 64  # tiles a side


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Tables of a grid of tiles with three pairs each, in four buckets of small row groups."""
    at = str(tmp_path_factory.mktemp("tables"))
    grid = spark.range(N * N * 3).selectExpr("id + 1 AS id", "CAST(id % 3 AS INT) AS pair", "CAST(id div 3 % 64 AS INT) AS x", f"CAST(id div {3 * N} AS INT) AS y")
    bounds = ["x AS tile_x0", "x + 1 AS tile_x1", "y AS tile_y0", "y + 1 AS tile_y1"]
    made = {
        "metadata": spark.sql("SELECT 'channels' AS key, '[]' AS value"),
        "combinations": grid.selectExpr("id", "concat('a|b', pair) AS channels", "2 AS channel_count", "CAST(pair % 2 AS DOUBLE) AS dilation", "0 AS hierarchy_level", "x + y AS total_count", "x + y + 1 AS total_union", "0.5D AS iou", "1D AS overlap_coeff"),
        "tiles": grid.selectExpr("id AS combination_id", *bounds, "x + y AS inter_count", "x + y + 1 AS union_count"),
        "channel_stats": grid.selectExpr("concat('c', pair) AS channel", "pair AS channel_idx", "CAST(pair % 2 AS DOUBLE) AS dilation", "0 AS hierarchy_level", *bounds, "x AS voxel_count", "1D AS sum_intensity", "1D AS mean_intensity"),
    }
    write_parquet(made, at, bucket_rows=N * N, options={"parquet.block.size": "1024", "parquet.block.size.row.check.min": "10", "parquet.page.size.row.check.min": "10", "parquet.page.size": "512"})
    return at, made


def bounds(at, table, column):
    """Least and greatest value of a column in every row group of a table."""
    out = []
    for f in sorted(glob.glob(f"{at}/{table}/**/*.parquet", recursive=True)):
        meta = pq.ParquetFile(f).metadata
        k = [meta.schema.column(i).name for i in range(meta.num_columns)].index(column)
        out += [(s.min, s.max) for s in (meta.row_group(g).column(k).statistics for g in range(meta.num_row_groups))]
    return out


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_places_are_interleaved_bits(spark):
    rows = spark.range(2000).selectExpr("CAST(id * 2654435761 % 32768 AS INT) AS x", "CAST(id * 40503 % 65536 AS INT) AS y").withColumn("p", place("x", "y")).collect()
    assert all(r.p == sum((r.x >> i & 1) << 2 * i | (r.y >> i & 1) << 2 * i + 1 for i in range(17)) for r in rows)


def test_tables_read_back_whole(spark, stored):
    at, made = stored
    for kept in (read_parquet(spark, at), open_tables(spark, at), open_tables(spark, at)):
        for name, df in made.items():
            cols = [c.split()[0] for c in DDL[name].split(", ")]
            assert kept[name].columns == cols
            assert kept[name].exceptAll(df.select(cols)).isEmpty() and kept[name].count() == df.count()
    write_parquet({**made, "combinations": made["combinations"].limit(5), "tiles": made["tiles"].limit(5)}, f"{at}/less")
    write_parquet({**made, "combinations": made["combinations"].limit(7), "tiles": made["tiles"].limit(7)}, f"{at}/less")
    assert open_tables(spark, f"{at}/less")["tiles"].count() == 7


def test_combinations_and_tiles_join_without_a_shuffle(spark, stored):
    at, made = stored
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = open_tables(spark, at)
        tables.register_views(kept)
        text = sql.HEATMAP_PAIR.format(channels="a|b1", level=0, dilation="1.0D")
        plan = plan_of(spark.sql(text))
        assert "Exchange" not in plan and "SortMergeJoin" in plan
        got = sorted(map(tuple, spark.sql(text).collect()))
        tables.register_views(made)
        assert got == sorted(map(tuple, spark.sql(text).collect())) and len(got) == N * N
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_lookups_skip_row_groups(spark, stored):
    at, made = stored
    of_names = bounds(at, "combinations", "channels")
    assert sum(lo <= "a|b1" <= hi for lo, hi in of_names) < len(of_names) / 2
    x, y = bounds(at, "tiles", "tile_x0"), bounds(at, "tiles", "tile_y0")
    met = [a[0] < 16 and a[1] >= 8 and b[0] < 16 and b[1] >= 8 for a, b in zip(x, y, strict=True)]
    assert len(met) > 16 and sum(met) < len(met) / 6
    kept = open_tables(spark, at)
    there = in_region(kept["tiles"], (8, 16), (8, 16))
    assert "PushedFilters" in plan_of(there) and there.count() == 8 * 8 * 3
    assert in_region(read_parquet(spark, at)["channel_stats"], (0, 1), (5, 7)).where("channel = 'c2' AND hierarchy_level = 0 AND dilation = 0.0D").count() == 2
    assert in_region(made["tiles"], (8, 8), (8, 16)).count() == 0  # an empty region
