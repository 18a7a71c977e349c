"""Mixing sources to target weights, by hash-threshold histograms. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored

#: A document's place in its source is the first LEVELS * DIGITS hex digits of md5(doc_id as text):
#: each level of the histogram has 16 ** DIGITS buckets.
DIGITS, LEVELS = 3, 5


def source_targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3) -> DataFrame:
    """(source, source_size) -> also target. Sources by code point, null last, take the weights in
    turn and share the total of all sizes; no target exceeds `most` times its source's size, and what
    that frees is shared again by weight until none is above.

    That fixed point has a closed form: order sources by cap / weight; with the caps before a source
    spent, the rest per remaining weight is the level; sources whose cap lies below the level of their
    place are capped. One row per source goes through its windows. No source: no row. All sizes 0:
    all targets 0.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    w = sizes.withColumn("i", F.row_number().over(order) - 1)
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("i") % len(weights) + 1).cast("long"))
    w = w.withColumn("cap", F.col("source_size") * most)
    by_need = Window.orderBy(F.col("cap") / F.col("weight"), "i")
    before, rest = by_need.rowsBetween(Window.unboundedPreceding, -1), by_need.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    w = w.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0))).cast("double") / F.sum("weight").over(rest))
    w = w.withColumn("need", F.row_number().over(by_need))
    w = w.withColumn("free", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("need", "level"))).over(every))
    target = F.when(F.col("need") < F.col("free.need"), F.col("cap").cast("double")).otherwise(F.least(F.col("free.level") * F.col("weight"), F.col("cap").cast("double")))
    return w.select("source", "source_size", "weight", F.coalesce(target, F.lit(0.0)).alias("target"))


def _size(text: str):
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size")


def _place(doc_id: str):
    return F.substring(F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 1, DIGITS * LEVELS).alias("h")


def thresholds(sized: DataFrame, weights: Sequence[int] = (1, 2, 3), most: int = 3, salts: int = 64) -> DataFrame:
    """From (source, size, h): one row per source with target, passes, and the threshold of h (prefix, last)."""
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = source_targets(totals, weights, most).withColumn("passes", passes)
    state = state.withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size"))
    state = stored(state.withColumns({"prefix": F.lit(""), "spent": F.lit(0).cast("long"), "words": F.lit(0).cast("long")}), "mix")
    for level in range(1, LEVELS + 1):
        n = level * DIGITS
        inside = sized
        if level > 1:  # only the bucket on the boundary
            inside = _by_source(sized, state.select("source", "prefix"), salts).where(F.substring("h", 1, n - DIGITS) == F.col("prefix"))
        hist = inside.groupBy("source", F.substring("h", 1, n).alias("bucket")).agg(F.sum("size").alias("words"))
        up_to = Window.partitionBy("source").orderBy("bucket")  # at most 16 ** DIGITS rows of a source
        run = hist.withColumn("upto", F.sum("words").over(up_to))
        s = state.select(F.col("source").alias("of"), "budget", "spent")
        meets = run.join(s, F.col("source").eqNullSafe(F.col("of"))).where(F.col("spent") + F.col("upto") > F.col("budget"))
        meets = meets.groupBy(F.col("source").alias("of")).agg(F.min(F.struct("bucket", (F.col("spent") + F.col("upto") - F.col("words")).alias("below"), F.col("words").alias("in_it"))).alias("x"))
        # Where no bucket meets the budget, the prefix lies past all hex digits.
        now = state.join(meets, F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
        now = now.withColumns({"prefix": F.coalesce("x.bucket", F.lit("g")), "spent": F.coalesce("x.below", "spent"), "words": F.coalesce("x.in_it", F.lit(0).cast("long"))})
        state = stored(now.drop("x"), "mix")
    last = F.col("words") + 2 * F.col("spent") < 2 * F.col("budget")
    return state.select("source", "source_size", "target", "passes", "prefix", last.alias("last"))


def _by_source(rows: DataFrame, per_source: DataFrame, salts: int) -> DataFrame:
    """rows (with source and h) joined with a table by source, each source's rows dealt over salts."""
    right = per_source.withColumnRenamed("source", "of_source").withColumn("of_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    salt = F.pmod(F.xxhash64("h"), F.lit(salts)).cast("int")
    left = rows.withColumn("row_salt", salt)
    return left.join(right, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("row_salt") == F.col("of_salt"))).drop("of_source", "of_salt", "row_salt")


def _taken(rows: DataFrame, ends: DataFrame, salts: int) -> DataFrame:
    more = (F.col("h") < F.col("prefix")) | (F.col("last") & (F.col("h") == F.col("prefix")))
    out = _by_source(rows, ends, salts).withColumn("copies", F.col("passes") + more.cast("long"))
    return out.withColumn("taken", F.col("size") * F.col("copies")).drop("h", "passes", "prefix", "last")


def mix_sizes(docs: DataFrame, *, weights: Sequence[int] = (1, 2, 3), most: int = 3, salts: int = 64) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken of every row of docs, as in mix()
    but without its other columns: the texts are read once and never shuffled."""
    sized = stored(docs.select("doc_id", "source", _size("text"), _place("doc_id")), "mix")
    return _taken(sized, thresholds(sized, weights, most, salts), salts)


def mix(docs: DataFrame, *, weights: Sequence[int] = (1, 2, 3), most: int = 3, salts: int = 64) -> DataFrame:
    """docs (doc_id, text, source and any others) with size, source_size, target, copies and taken added.

    Every document is taken floor(target / source_size) times, and once more if its hash lies below its
    source's threshold. Thresholds come from nested histograms: words are summed by source and bucket
    of the hash; the bucket in which the running sum meets the budget is split by the hash's next
    digits, and only that one, until single hash values remain. At last the value that meets the budget
    is taken if that comes nearer to it. No document is sorted, and thresholds of larger budgets contain
    those of smaller ones.

    A hot source is no hot task: histograms are summed before the shuffle, and tables by source,
    repeated once per salt, are joined by source and salt. Size: words of the text, 0 if it is null.
    Null sources are one source. Rows with the same id fare alike; a null id hashes as the empty text.
    No rows give no rows. Ties: documents whose hashes are equal fare alike. Very long texts are counted in place. Columns of docs
    that have the name of an added one are replaced; all others stay.
    """
    made = ["size", "source_size", "target", "copies", "taken"]
    base = docs.drop(*[c for c in docs.columns if c in made])
    sized = stored(base.select("doc_id", "source", _size("text"), _place("doc_id")), "mix")
    ends = thresholds(sized, weights, most, salts)
    out = _taken(base.select(F.struct("*").alias("row"), "source", _size("text"), _place("doc_id")), ends, salts)
    return out.select("row.*", *made)
