"""Near-duplicate embeddings by collision-counting projections."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, row_key, stored

#: Members of a cell that one task holds of either side, and pairs that are counted at a time.
SHARE, AT_ONCE = 512, 1 << 20


def normal_probability(x: float) -> float:
    return math.erf(x / math.sqrt(2))


def bucket_probability(distance: float, width: float) -> float:
    """That two points at a distance fall into the same cell of a random projection cut at this width."""
    r = width / distance
    return normal_probability(r) - 2 / (math.sqrt(2 * math.pi) * r) * (1 - math.exp(-r * r / 2))


class Projections:
    """The random lines and the counts that meet a recall at the threshold.

    Unit vectors with cosine c are sqrt(2 - 2c) apart, so on a line with normal entries their places differ
    by a normal variable of that spread. `lines` lines are kept for counting: places within `window` collide,
    and a pair passes with `least` collisions, the most that keep the recall. To find pairs worth counting,
    `tables` groups of `depth` further lines are cut into cells: depth grows with the logarithm of the number
    of vectors, so chance partners stay few, and tables are as many as keep the recall at the threshold
    itself; above it, recall is higher. Everything follows from the parameters and the number of vectors.
    """

    def __init__(self, dims: int, vectors: int, cosine: float, recall: float, lines: int = 32, width: float = 1.0):
        near, far = math.sqrt(2 - 2 * cosine), math.sqrt(2)
        self.cosine, self.width, self.window = cosine, width, 2.5 * near
        p = normal_probability(2.5)
        tail, self.least = 0.0, lines
        while self.least > 0:
            tail += math.comb(lines, self.least) * p**self.least * (1 - p) ** (lines - self.least)
            if tail >= 1 - (1 - recall) / 10:
                break
            self.least -= 1
        self.depth = max(1, math.ceil(math.log(max(2, vectors)) / -math.log(bucket_probability(far, width))))
        self.tables = max(1, math.ceil(math.log((1 - recall) * 0.9) / math.log(1 - bucket_probability(near, width) ** self.depth)))
        rng = np.random.default_rng(20240229 + dims)
        self.count = rng.standard_normal((dims, lines))
        self.cells = rng.standard_normal((dims, self.tables * self.depth))
        self.shift = rng.uniform(0, width, self.tables * self.depth)
        self.odd = rng.integers(1, 1 << 62, self.depth, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)

    def keys(self, unit: np.ndarray) -> np.ndarray:
        """A 64-bit key of the cell of each vector in each table."""
        cell = np.floor((unit @ self.cells + self.shift) / self.width).astype(np.int64).astype(np.uint64).reshape(len(unit), self.tables, self.depth)
        with np.errstate(over="ignore"):
            z = (cell * self.odd).sum(axis=2, dtype=np.uint64)
            z = (z ^ (z >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            return (z ^ (z >> np.uint64(29))).view(np.int64)


def unit_vectors(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def collisions(cell: np.ndarray, place: np.ndarray, window: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """The pairs a < b of points of the same cell that lie within a window of each other on `least` lines or more.

    Each line is sorted, cell by cell, once; the window centred on a point holds its partners behind it; the
    pairs met on all lines are counted.
    """
    n = len(cell)
    apart = 2 * float(np.abs(place).max(initial=0.0)) + 2 * window + 1
    codes = []
    for j in range(place.shape[1]):
        key = cell * apart + place[:, j]
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        ends = np.searchsorted(ordered, ordered + window, side="right")
        met = ends - np.arange(n) - 1
        first = np.repeat(np.arange(n), met)
        second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(met) - met, met)
        a, b = order[first], order[second]
        codes.append(np.minimum(a, b) * n + np.maximum(a, b))
    pair, count = np.unique(np.concatenate(codes), return_counts=True)
    pair = pair[count >= least]
    return pair // n, pair % n


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of the component of each of n points, given links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compare(proj: Projections):
    """From rows sorted by (t, key, i, j): for each point its links (by weight, each pair in the first table
    in which it meets) and the root of its links here."""

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        held: dict[str, np.ndarray] | None = None
        for b in batches:
            cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names}
            if held is not None:
                cols = {c: np.concatenate([held[c], x]) for c, x in cols.items()}
            ends = np.flatnonzero(np.any([cols[c][1:] != cols[c][:-1] for c in ("t", "key", "i", "j")], axis=0)) + 1
            cut = ends[-1] if len(ends) else 0
            if cut:
                yield {c: x[:cut] for c, x in cols.items()}
            held = {c: x[cut:] for c, x in cols.items()}
        if held is not None and len(held["t"]):
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches):
            unit = unit_vectors(list(rows["vec"]))
            place = unit @ proj.count
            new = np.any([rows[c][1:] != rows[c][:-1] for c in ("t", "key", "i", "j")], axis=0)
            bounds = np.concatenate([[0], np.flatnonzero(new) + 1, [len(unit)]])
            cell = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
            # Cells in runs of about AT_ONCE possible pairs.
            load = np.cumsum(np.diff(bounds) ** 2) // AT_ONCE
            cuts = [0, *(bounds[1:-1][load[1:] != load[:-1]]), len(unit)]
            left, right = [], []
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                a, b = collisions(cell[s:e] - cell[s], place[s:e], proj.window, proj.least)
                a, b = a + s, b + s
                across = (rows["left"][a] & rows["right"][b]) | (rows["right"][a] & rows["left"][b])
                left.append(a[across])
                right.append(b[across])
            a, b = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (left, right))
            keep = np.zeros(len(a), dtype=bool)
            for at in range(0, len(a), 100_000):
                x, y = a[at : at + 100_000], b[at : at + 100_000]
                keep[at : at + 100_000] = (unit[x] * unit[y]).sum(axis=1) >= proj.cosine
            a, b = a[keep], b[keep]
            if not len(a):
                continue
            used, back = np.unique(np.concatenate([a, b]), return_inverse=True)
            ka, kb, keys = back[: len(a)], back[len(a) :], proj.keys(unit[used])
            links = np.zeros(len(unit), dtype=np.int64)
            for at in range(0, len(a), 100_000):
                x, y = slice(at, at + 100_000), rows["t"][a[at : at + 100_000]]
                same = keys[ka[x]] == keys[kb[x]]
                first = same.argmax(axis=1) == y
                np.add.at(links, a[x][first], rows["weight"][b[x][first]])
                np.add.at(links, b[x][first], rows["weight"][a[x][first]])
            root = _roots(len(unit), a, b)
            yield pa.RecordBatch.from_arrays([pa.array(rows["cls"][used]), pa.array(links[used]), pa.array(rows["cls"][root[used]])], names=["cls", "links", "root"])

    return run


def near_duplicates(vectors: DataFrame, *, cosine: float = 0.95, recall: float = 0.995, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per row of vectors: vec_id, n_links, component_id, kept.

    Two vectors of the same length link if their cosine, in double precision, is `cosine` or more. Pairs are
    found by Projections with at least `recall` at the threshold and more above it; every pair found is
    verified, so none below the threshold links. n_links counts the other rows linked directly,
    component_id is the least vec_id reachable, kept says that it is the row's own.

    Equal vectors are one class with a weight; their links to each other always count. Small rows (table,
    cell, class) find the cells with two members or more, and only for these the vectors are shuffled. A cell of
    any size is dealt over tasks by pairs of shares of SHARE members; a task sends on a sum and a root per
    member, never its pairs.

    Within a cell the kept lines are sorted and each vector's window holds its partners; pairs that meet in enough windows are
    verified. Ties: equal cosines need no order; links are symmetric.

    Vectors that are null, empty, zero, or hold null or non-finite components link with nothing, as do rows
    with a null vec_id (component_id null, kept false). Rows that repeat a vec_id share its links. Other
    columns are ignored. No rows give no rows.
    """
    x = F.col("x")
    fine = (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists(x, lambda v: v != 0)
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(embedding).cast("array<double>").alias("x"))
    rows = rows.withColumn("fine", F.coalesce(fine & F.col("id").isNotNull(), F.lit(False))).withColumn("k", row_key("x"))
    good = rows.where("fine").select("id", "k.k1", "k.k2", "x")
    classes = stored(good.groupBy("k1", "k2").agg(F.min("id").alias("cls"), F.count("*").alias("weight"), F.first("x").alias("x")), "neardup")
    lengths = {r[0]: r[1] for r in classes.groupBy(F.size("x")).count().collect()}  # lengths of vectors, a handful
    links = edges = None
    for dims, n in sorted(lengths.items()):
        proj = Projections(dims, n, cosine, recall)

        def spread(batches: Iterator[pa.RecordBatch], proj: Projections = proj) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                vec = [np.array(v, dtype=np.float64).tobytes() for v in b.column("x").to_pylist()]
                keys = proj.keys(unit_vectors(vec))
                t = np.tile(np.arange(keys.shape[1], dtype=np.int32), len(keys))
                yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(keys.ravel()), b.column("cls").take(pa.array(np.repeat(np.arange(len(keys)), keys.shape[1])))], names=["t", "key", "cls"])

        def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                vec = [np.array(v, dtype=np.float64).tobytes() for v in b.column("x").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("weight"), pa.array(vec, pa.binary())], names=["cls", "weight", "vec"])

        mine = classes.where(F.size("x") == dims)
        met = stored(mine.select("cls", "x").mapInArrow(spread, "t int, key long, cls long"), "neardup")
        size = met.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
        several = met.join(size, ["t", "key"])
        parts = F.ceil(F.col("n") / SHARE).cast("long")
        dealt = several.withColumn("own", F.pmod(F.xxhash64("cls"), parts)).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        dealt = dealt.select("t", "key", "cls", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")
        full = dealt.join(mine.select("cls", "weight", "x").mapInArrow(packed, "cls long, weight long, vec binary"), "cls")
        full = full.select("t", "key", "i", "j", "cls", "weight", "vec", (F.col("own") == F.col("i")).alias("left"), (F.col("own") == F.col("j")).alias("right"))
        full = full.repartition("t", "key", "i", "j").sortWithinPartitions("t", "key", "i", "j")
        got = stored(full.mapInArrow(_compare(proj), "cls long, links long, root long"), "neardup")
        s, e = got.groupBy("cls").agg(F.sum("links").alias("links")), got.select(F.col("cls").alias("a"), F.col("root").alias("b"))
        links, edges = (s, e) if links is None else (links.union(s), edges.union(e))
    if links is None:
        return rows.select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").cast("long").alias("component_id"), F.col("id").isNotNull().alias("kept"))
    comps = components(edges)
    per_class = classes.select("k1", "k2", "cls", "weight").join(links.groupBy("cls").agg(F.sum("links").alias("links")), "cls", "left").join(comps.withColumnRenamed("node", "cls"), "cls", "left")
    per_class = per_class.select(F.col("k1").alias("c1"), F.col("k2").alias("c2"), (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("links"), F.coalesce("component", "cls").alias("comp"))
    out = rows.select("id", "fine", "k.k1", "k.k2").join(per_class, (F.col("k1") == F.col("c1")) & (F.col("k2") == F.col("c2")) & F.col("fine"), "left")
    comp = F.coalesce("comp", "id")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), comp.cast("long").alias("component_id"), F.coalesce(comp == F.col("id"), F.lit(False)).alias("kept"))
