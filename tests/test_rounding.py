"""Digits of published ratios, ties among them, as the twins round them."""

import duckdb
from pyspark.sql import functions as F

from covoxel.plans import catalog


def test_ratios_are_rounded_as_in_sql(spark):
    rows = spark.range(1, 5120).crossJoin(spark.sql("SELECT explode(array(2560, 5120, 1600, 5119)) AS d"))
    got = {(r.id, r.d): r.x for r in rows.select("id", "d", catalog.nine(F.col("id") / F.col("d")).alias("x")).collect()}
    want = duckdb.sql("SELECT k, d, round(k / d, 9) FROM (SELECT unnest(range(1, 5120)) AS k), (SELECT unnest([2560, 5120, 1600, 5119]) AS d)").fetchall()
    assert got[661, 5120] == 0.129101562
    assert got == {(k, d): x for k, d, x in want}
