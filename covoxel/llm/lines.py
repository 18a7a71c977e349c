"""Line dedup by content-defined line chunks. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import forget, row_key, stored

#: Columns that are added here begin with this.
_OWN = "__line_dedup"
#: A chunk begins at a window of two lines whose rolling hash has a first hexadecimal digit of MARK or more, and ends with the first one,
#: from there on, whose second digit is; windows of such a chunk at most; lines before and behind equal chunks that are compared, too.
MARK, MOST, BEFORE, BEHIND = "4", 8, 8, 16


def _with_lines(docs: DataFrame) -> DataFrame:
    """docs with the lines of text (null for a null text) and the places, from 0, of those that aren't blank."""
    lines = docs.withColumn(f"{_OWN}_lines", F.split("text", "\n"))
    held = F.col(f"{_OWN}_lines")
    blank = lambda x: F.trim(F.translate(x, "\t\x0b\x0c\r", "    ")) == ""
    return lines.withColumn(f"{_OWN}_at", F.filter(F.sequence(F.lit(0), F.size(held) - 1), lambda i: ~blank(F.get(held, i))))


def _chunks(docs: DataFrame) -> DataFrame:
    """k1, k2, s, e, hash: the chunks of all documents, from line s to line e of those that aren't blank."""
    lines, at = F.col(f"{_OWN}_lines"), F.col(f"{_OWN}_at")
    # Each step is a projection of its own, so that no array is computed for every line that reads it.
    step = _with_lines(docs).withColumn("m", F.transform(at, lambda i: F.md5(F.encode(F.get(lines, i), "UTF-8"))))
    step = step.select("k1", "k2", F.transform(at, lambda i: F.xxhash64(F.get(lines, i))).alias("h"), "m")
    tail = F.greatest(F.size("m") - 1, F.lit(0))
    step = step.withColumn("r", F.zip_with(F.slice("m", F.lit(1), tail), F.slice("m", F.lit(2), tail), lambda a, b: F.md5(F.encode(F.concat(a, b), "UTF-8"))))
    last = F.size("r") - 1
    starts = F.filter(F.sequence(F.lit(0), last), lambda i: (i == 0) | (F.substr(F.get("r", i), F.lit(1), F.lit(1)) >= MARK))
    step = step.select("k1", "k2", "h", last.alias("last"), F.transform("r", lambda x: F.substr(x, F.lit(2), F.lit(1)) >= MARK).alias("ends"), F.when(last >= 0, starts).alias("starts"))
    # Windows that aren't a chunk of their own by the marks.
    plain = F.array_except(F.sequence(F.lit(0), F.col("last")), F.filter("starts", lambda i: F.get("ends", i) | (i == F.col("last"))))
    step = step.withColumn("plain", F.when(F.col("last") >= 0, plain))
    ahead = lambda i: F.array_position(F.slice("ends", i + 1, F.lit(MOST)), True)
    end = lambda i: F.least(F.when(ahead(i) > 0, i + ahead(i).cast("int") - 1).otherwise(i + MOST - 1), F.col("last")) + 1
    chunk = lambda name, e: F.transform(name, lambda i: F.struct(i.alias("s"), e(i).alias("e")))
    step = step.withColumn("c", F.concat(chunk("starts", end), chunk("plain", lambda i: i + 1)))
    step = step.withColumn("c", F.transform("c", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), F.xxhash64(F.slice("h", c["s"] + 1, c["e"] - c["s"] + 1)).alias("hash"))))
    # An outer explode: a plain one implies a filter, which would be pushed below and repeat all this.
    return step.select("k1", "k2", F.explode_outer("c").alias("c")).where("c is not null").select("k1", "k2", "c.s", "c.e", "c.hash")


def _alike(a: Column, b: Column) -> Column:
    """How many of the first elements of two arrays are equal."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False))), False)
    return F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("int")


def _islands(rows: DataFrame, by: list[str]) -> DataFrame:
    """by, s, e: rows of lines that overlap or touch, as one."""
    order = Window.partitionBy(*by).orderBy("s", "e")
    fresh = F.col("s") > F.max("e").over(order.rowsBetween(Window.unboundedPreceding, -1)) + 1
    told = rows.withColumn("fresh", F.coalesce(fresh, F.lit(True)).cast("int"))
    nth = told.withColumn("island", F.sum("fresh").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return nth.groupBy(*by, "island").agg(F.min("s").alias("s"), F.max("e").alias("e")).drop("island")


def line_dedup(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, any others) with repeated passages of lines removed from text, and with the columns
    n_lines, n_lines_removed, n_chunks_removed (runs of removed lines) and all_removed (it had lines that aren't blank, and all are removed) added. To drop
    documents, filter on all_removed: Spark pushes a filter on the others below the split into lines, which is then done twice.

    Chunks: a rolling hash over the hashes of every two lines in a row that aren't blank chooses where chunks begin (three windows in four, and a text's first one) and where
    they end (the first of three in four, from the beginning on; after MOST windows; or the last one). So a chunk has two lines or more, and its boundaries
    follow from the lines in it alone, wherever they stand. Every other window of two lines is a chunk, too: so no passage of two lines or more is
    missed, whatever its hashes.

    Equal chunks, anywhere, are compared line by line with their first occurrence (least doc_id, nulls last, then row, then place), and so are the lines before
    (BEFORE) and behind (BEHIND), as far as they are equal, which reach the next marks; what adjoins along the same two
    documents is one region. Lines are equal if their 64-bit hashes are and, of all lines with such a hash, the bytes.

    Removed is what lies in a region that repeats an earlier one, but for lines of protected regions: those that others repeat and that don't themselves lie in one
    region that repeats an earlier one. So whatever is removed stands elsewhere, whole, and stays there: a region's original is protected,
    or part of a region whose original is earlier still. Blank lines between removed lines go with them. What remains is joined by line ends, unchanged. Single lines never go by themselves.

    Shuffled: 28 bytes for each chunk to find repeated hashes; the texts once by row for those that hold any, the repeated chunks with
    their neighbours' hashes, distinct repeated lines for the comparison, and the texts for the rebuild. A hot chunk or line is reduced before the shuffle, and the joins
    on it are plain equi-joins that AQE splits. Windows are by document. A document's work is linear in its lines.

    Null texts stay null, with counts 0; an empty text is one empty line and stays. Very long texts are lines of one row,
    never gathered with others. Rows that repeat doc_id and text are one document and fare alike; ties fall to the least place.
    No rows give no rows. Columns of docs that have the name of an added one are replaced.
    """
    made = ["n_lines", "n_lines_removed", "n_chunks_removed", "all_removed"]
    base = docs.drop(*[c for c in docs.columns if c in made or c.startswith(_OWN)])
    keyed = base.withColumn(f"{_OWN}_key", row_key("doc_id", "text"))
    k1, k2 = F.col(f"{_OWN}_key.k1"), F.col(f"{_OWN}_key.k2")
    small = keyed.select(F.col("doc_id").alias("id"), "text", k1.alias("k1"), k2.alias("k2"))

    meta = stored(_chunks(small), "lines")
    # A repeated row isn't a repeat of its chunks: the place (row, s) must differ.
    # Aggregates are written before they are joined: AQE splits the join of a hot chunk only if none feeds it. They grow with the corpus, so
    # their joins are merge joins at every size.
    again = stored(meta.groupBy("hash").agg(F.min(F.struct("k1", "k2", "s")).alias("x"), F.max(F.struct("k1", "k2", "s")).alias("y")).where("x <> y").select("hash"), "lines")
    touched = meta.join(again.hint("merge"), "hash").groupBy(F.col("k1").alias("t1"), F.col("k2").alias("t2")).agg(F.collect_set(F.struct("s", "e", "hash")).alias("c"))

    lines, at = F.col(f"{_OWN}_lines"), F.col(f"{_OWN}_at")
    suspects = _with_lines(small.dropDuplicates(["k1", "k2"]).join(touched, (F.col("k1") == F.col("t1")) & (F.col("k2") == F.col("t2"))))
    suspects = suspects.select("id", "k1", "k2", "c", F.size(at).alias("of"), F.transform(at, lambda i: F.xxhash64(F.get(lines, i))).alias("h"), F.transform(at, lambda i: F.get(lines, i)).alias("body"))
    suspects = stored(suspects, "lines")
    chunks = suspects.select("id", "k1", "k2", "of", "h", F.explode("c").alias("c")).select(
        "c.hash", F.struct(F.col("id").isNull().alias("last"), "id", "k1", "k2", F.col("c.s").alias("s")).alias("at"), "of",
        F.slice("h", F.col("c.s") + 1, F.col("c.e") - F.col("c.s") + 1).alias("own"),
        F.reverse(F.slice("h", F.greatest(F.col("c.s") - BEFORE, F.lit(0)) + 1, F.least(F.col("c.s"), F.lit(BEFORE)))).alias("before"),
        F.slice("h", F.col("c.e") + 2, F.lit(BEHIND)).alias("behind"),
    )
    chunks = stored(chunks, "lines")
    first = stored(chunks.groupBy("hash").agg(F.min(F.struct("at", "own", "before", "behind")).alias("first")), "lines")
    left, right = _alike(F.col("before"), F.col("first.before")), _alike(F.col("behind"), F.col("first.behind"))
    copies = chunks.join(first.hint("merge"), "hash").where((F.col("at") != F.col("first.at")) & (F.col("own") == F.col("first.own")))
    copies = copies.select("at.k1", "at.k2", (F.col("at.s") - left).alias("s"), (F.col("at.s") + F.size("own") - 1 + right).alias("e"), F.col("first.at.k1").alias("f1"), F.col("first.at.k2").alias("f2"), (F.col("at.s") - F.col("first.at.s")).alias("shift"))
    regions = stored(_islands(copies, ["k1", "k2", "f1", "f2", "shift"]), "lines")

    # Bytes: hashes that unlike lines share, of those in chunks and as far around as regions reach. There are none, but for an accident. This
    # reads the suspects alone, so their texts aren't shuffled once more; of like lines, a task sends one.
    around = F.transform("c", lambda c: F.sequence(F.greatest(c["s"] - BEFORE, F.lit(0)), F.least(c["e"] + BEHIND, F.col("of") - 1)))
    near = suspects.select("h", "body", F.array_distinct(F.flatten(around)).alias("p"))
    each = near.select(F.explode_outer(F.transform("p", lambda p: F.struct(F.get("h", p).alias("h"), F.get("body", p).alias("line")))).alias("x"))
    liars = stored(each.groupBy("x.h").agg(F.min("x.line").alias("a"), F.max("x.line").alias("b")).where("a <> b").select(F.col("h").alias("liar")), "lines")
    if not liars.isEmpty():
        told = suspects.select(F.col("k1").alias("t1"), F.col("k2").alias("t2"), F.posexplode("h").alias("p", "liar")).join(liars, "liar").drop("liar")
        regions = regions.join(told, (F.col("k1") == F.col("t1")) & (F.col("k2") == F.col("t2")) & F.col("p").between(F.col("s"), F.col("e")), "left_anti")

    # Originals that lie in one region that repeats an earlier one aren't protected.
    origin = regions.select(F.col("f1").alias("k1"), F.col("f2").alias("k2"), (F.col("s") - F.col("shift")).alias("s"), (F.col("e") - F.col("shift")).alias("e")).distinct()
    both = regions.select("k1", "k2", "s", "e", F.lit(0).alias("kind")).distinct().union(origin.select("*", F.lit(1).alias("kind")))
    so_far = Window.partitionBy("k1", "k2").orderBy("s", F.desc("e"), "kind").rowsBetween(Window.unboundedPreceding, 0)
    kept = both.withColumn("reach", F.max(F.when(F.col("kind") == 0, F.col("e"))).over(so_far)).where("kind = 0 or reach is null or reach < e")
    spread = lambda kind: F.flatten(F.collect_list(F.when(F.col("kind") == kind, F.sequence("s", "e"))))
    gone = kept.groupBy(F.col("k1").alias(f"{_OWN}_g1"), F.col("k2").alias(f"{_OWN}_g2")).agg(F.array_except(spread(0), spread(1)).alias(f"{_OWN}_gone"))
    of = suspects.select(F.col("k1").alias(f"{_OWN}_g1"), F.col("k2").alias(f"{_OWN}_g2"), F.col("of").alias(f"{_OWN}_of"))
    # Whether all of a document is gone follows from this table alone, so a filter on it is as cheap as the join.
    gone = stored(gone.where(F.size(f"{_OWN}_gone") > 0).join(of, [f"{_OWN}_g1", f"{_OWN}_g2"]).withColumn("all_removed", F.size(f"{_OWN}_gone") == F.col(f"{_OWN}_of")), "lines")
    forget(meta, again, chunks, first, suspects, regions if hasattr(regions, "_stored_at") else liars)

    every = F.col(f"{_OWN}_gone")
    out = _with_lines(keyed.join(gone.hint("merge"), (k1 == F.col(f"{_OWN}_g1")) & (k2 == F.col(f"{_OWN}_g2")), "left"))
    inner = F.array_intersect(every, F.transform(every, lambda p: p - 1))  # the next line goes, too: and the blank ones between
    lost = F.array_distinct(F.concat(F.transform(every, lambda p: F.get(at, p)), F.flatten(F.transform(inner, lambda p: F.sequence(F.get(at, p), F.get(at, p + 1))))))
    kept_lines: Column = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), lost)
    text = F.when(every.isNull(), F.col("text")).otherwise(F.array_join(F.transform(kept_lines, lambda i: F.get(lines, i)), "\n"))
    count = lambda x: F.coalesce(F.when(x.isNotNull(), F.size(x)), F.lit(0)).cast("long")
    added = {"n_lines": count(lines), "n_lines_removed": count(lost), "n_chunks_removed": count(F.array_except(every, inner)), "all_removed": F.coalesce("all_removed", F.lit(False))}
    return out.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in base.columns], *[v.alias(k) for k, v in added.items()])
