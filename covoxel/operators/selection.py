"""Exact quantiles of groups of any size, by refining histograms."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import LongType

#: Bits that a round tells apart: a histogram has 2 ** BITS buckets at most, whatever the data.
BITS = 16


@arrow_udf(LongType())
def order_key(v: pa.Array) -> pa.Array:
    """A whole number for every double, in the same order: the bits, the lower 63 of them flipped for negative numbers. Both zeros are
    one; null stays null."""
    bits = (v.fill_null(0.0).to_numpy(zero_copy_only=False) + 0.0).view("int64")
    return pa.array(bits ^ ((bits >> 63) & 0x7FFFFFFFFFFFFFFF), mask=v.is_null().to_numpy(zero_copy_only=False))


def quantile(rows: DataFrame, by: list[str], p: float, name: str) -> DataFrame:
    """by and `name`: the p-quantile of `m` in each group, where a row counts n times; as percentile(m, p, n), interpolated between the two
    neighbouring ranks. rows: by, m, key (order_key of m), n. Groups without a row of n > 0 have none.

    Groups may be of any size, but there must be few of them, as channels: each has two ranks, and these are what comes to
    the driver. A round counts the candidates by the next BITS bits of their keys and keeps, for each rank, the bucket that holds it; one
    whose keys are all equal is the answer. So no buffer grows with a group, and at most 64 / BITS rounds read the rows, all groups and ranks at once.
    """
    spark, found, kinds = rows.sparkSession, {}, dict(rows.dtypes)
    rows = rows.where("n > 0")
    wanted: DataFrame | None = None
    for shift in range(64 - BITS, -1, -BITS):
        near, here = rows, by
        if wanted is not None:
            prefixes = F.broadcast(wanted.select(*by, "prefix").distinct())  # two rows a group
            near, here = rows.withColumn("prefix", F.shiftright("key", shift + BITS)).join(prefixes, [*by, "prefix"]), [*by, "prefix"]
        counts = near.groupBy(*here, F.shiftright("key", shift).alias("bucket")).agg(F.sum("n").alias("n"), F.min("m").alias("m"), F.min("key").alias("low"), F.max("key").alias("high"))
        of = Window.partitionBy(*here)
        counts = counts.withColumn("upto", F.sum("n").over(of.orderBy("bucket")))
        if wanted is None:
            counts = counts.withColumn("at", (F.sum("n").over(of) - 1) * F.lit(p))
            counts = counts.select("*", F.posexplode(F.array(F.floor("at"), F.ceil("at"))).alias("which", "rank"))
        else:
            counts = counts.join(F.broadcast(wanted), [*by, "prefix"]).drop("prefix")
        chosen = counts.where((F.col("rank") >= F.col("upto") - F.col("n")) & (F.col("rank") < F.col("upto")))
        left = []
        for r in chosen.select(*by, "bucket", "m", "at", "which", (F.col("low") == F.col("high")).alias("one"), (F.col("rank") - F.col("upto") + F.col("n")).alias("rank")).collect():
            group = tuple(r[c] for c in by)
            if r.one:
                found.setdefault(group, {"at": r["at"]})[r.which] = r.m
            else:
                left.append((*group, r.bucket, r.which, r.rank, r["at"]))
        if not left:
            break
        wanted = spark.createDataFrame(left, ", ".join(f"{c} {kinds[c]}" for c in by) + ", prefix long, which int, rank long, at double")
    out = []
    for group, f in found.items():
        low, high, at = f[0], f[1], f["at"]
        value = low if low == high or at == int(at) else (int(at) + 1 - at) * low + (at - int(at)) * high
        out.append((*group, float(value)))
    return spark.createDataFrame(out, ", ".join(f"{c} {kinds[c]}" for c in by) + f", {name} double")
