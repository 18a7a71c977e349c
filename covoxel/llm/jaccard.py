"""N-gram Jaccard join with R-trees over count vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, forget, mix, reclaim, slices, stored, word_hashes

#: Groups of a count vector, points in a leaf, children of a node above, members of a block that one task holds of either side,
#: documents from which a shingle is put last in the global order, and bits of the table of such shingles.
GROUPS, LEAF, FAN, SHARE, FREQUENT, BITS = 512, 32, 8, 512, 16, 24
_P = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: Sequence[str | None], k: int) -> list[np.ndarray]:
    """For each text the sorted distinct 64-bit hashes of its k-word shingles.

    A-Z are lowered; words are runs of bytes other than ASCII white space. Fewer than k words: the
    whole sequence is the one shingle. No words, or null: none.
    """
    out: list[np.ndarray] = []
    at = 0
    while at < len(texts):
        group, size = [], 0
        while at < len(texts) and (not group or size + len(texts[at] or "") <= 1 << 20):
            group.append((texts[at] or "").encode("utf-8", "replace").lower())
            size += len(group[-1])
            at += 1
        out += _sets(group, k)
    return out


def _sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    found = list(word_hashes(b" ".join(texts)))
    start, word = (np.concatenate([np.zeros(0, kind), *(x[i] for x in found)]) for i, kind in ((0, np.int64), (1, np.uint64)))
    with np.errstate(over="ignore"):
        bound = np.searchsorted(start, np.cumsum([0, *(len(t) + 1 for t in texts)]))
        n = max(0, len(word) - k + 1)
        grams = np.zeros(n, dtype=np.uint64)
        for j in range(k):
            grams = grams * _P + word[j : j + n]
        grams = mix(grams)
        sets = []
        for a, b in zip(bound[:-1], bound[1:], strict=True):
            if b - a >= k:
                s = np.sort(grams[a : b - k + 1])
                sets.append(s[np.concatenate([[True], s[1:] != s[:-1]])])
            elif b > a:
                whole = np.uint64(b - a)
                for w in word[a:b]:
                    whole = whole * _P + w
                sets.append(mix(np.array([~whole])))
            else:
                sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def count_vector(s: np.ndarray) -> np.ndarray:
    """How many of a set's hashes fall into each group: one byte each if all fit, else four."""
    n = np.bincount((s % np.uint64(GROUPS)).astype(np.int64), minlength=GROUPS)
    return n.astype(np.uint8 if n.max() < 256 else np.uint32)


def read_vectors(raw: Sequence[bytes]) -> np.ndarray:
    wide = [np.frombuffer(v, np.uint8 if len(v) == GROUPS else np.uint32) for v in raw]
    if all(v.dtype == np.uint8 for v in wide):
        return np.frombuffer(b"".join(raw), np.uint8).reshape(-1, GROUPS).astype(np.int64)
    return np.array([v.astype(np.int64) for v in wide]).reshape(-1, GROUPS)


def least_overlap(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """The smallest intersection with which sets of n and m reach the threshold."""
    return -(-percent * (n + m) // (100 + percent))


class CountTree:
    """A packed R-tree over count vectors: points in order of size, then of their counts, LEAF to a leaf and FAN nodes to a
    node above; each node knows the coordinate-wise greatest counts and the sizes below it."""

    def __init__(self, n: np.ndarray, vectors: np.ndarray):
        coarse = vectors.reshape(len(n), 8, -1).sum(axis=2)
        self.order = np.lexsort([*coarse.T, n])
        self.n, self.points = n[self.order], vectors[self.order].astype(np.int64)
        #: From the leaves up: greatest counts, least and greatest size.
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        high, low_n, high_n, width = self.points, self.n, self.n, LEAF
        while len(n) and (not self.levels or len(high) > FAN):
            first = np.arange(0, len(high), width)
            high, low_n = np.maximum.reduceat(high, first, axis=0), low_n[first]
            high_n = np.maximum.reduceat(high_n, first)
            self.levels.append((high, low_n, high_n))
            width = FAN

    def search(self, n: int, vector: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Points (numbers as given) whose summed coordinate minima leave room for the threshold, and those sums. A node is
        entered only if its box does."""
        none = np.zeros(0, np.int64)
        at = np.arange(len(self.levels[-1][1])) if self.levels else none
        for depth in range(len(self.levels) - 1, -1, -1):
            high, low_n, high_n = self.levels[depth]
            at = at[(100 * low_n[at] <= 10000 * n // percent) & (100 * high_n[at] >= percent * n)]
            if not len(at):
                return none, none
            bound = np.minimum(high[at], vector).sum(axis=1)
            at = at[bound >= least_overlap(n, np.maximum(low_n[at], -(-percent * n // 100)), percent)]
            width, below = (FAN, len(self.levels[depth - 1][1])) if depth else (LEAF, len(self.n))
            at = (at[:, None] * width + np.arange(width)).ravel()
            at = at[at < below]
        if not len(at):
            return none, none
        bound = np.minimum(self.points[at], vector).sum(axis=1)
        m = self.n[at]
        ok = (bound >= least_overlap(n, m, percent)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
        return self.order[at[ok]], bound[ok]


def block_pairs(ids: np.ndarray, comp: np.ndarray, n: np.ndarray, vectors: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int, window: tuple[int, int | None]) -> set[tuple[int, int]]:
    """Pairs of a left and a right point of different components that pass the bound: for each left point
    those of the given ranks, the greatest bounds first."""
    found: set[tuple[int, int]] = set()
    l, r = np.flatnonzero(left), np.flatnonzero(right)
    tree = CountTree(n[r], vectors[r])
    for i in l:
        got, bound = tree.search(int(n[i]), vectors[i].astype(np.int64), percent)
        got = r[got]
        order = np.lexsort([ids[got], -bound])
        got = got[order][ids[got[order]] != ids[i]][window[0] : window[1]]
        for j in got[comp[got] != comp[i]]:
            found.add((int(min(ids[i], ids[j])), int(max(ids[i], ids[j]))))
    return found


def _search_blocks(percent: int, window: tuple[int, int | None]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        held: list[dict[str, np.ndarray]] = []

        def take(rows: dict[str, np.ndarray]) -> None:
            seen.update(block_pairs(rows["doc"], rows["comp"], rows["n"], read_vectors(rows["vec"]), rows["left"], rows["right"], percent, window))

        for b in batches:
            cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in b.schema.names}
            key = np.stack([cols["token"], cols["i"], cols["j"]], axis=1)
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1), len(key)]
            for s, e in zip(cuts[:-1], cuts[1:], strict=True):
                part = {c: x[s:e] for c, x in cols.items()}
                if held and any(held[-1][c][-1] != part[c][0] for c in ("token", "i", "j")):
                    take({c: np.concatenate([h[c] for h in held]) for c in part})
                    held = []
                held.append(part)
            if len(seen) > 100_000:
                yield _pairs(seen)
                seen = set()
        if held:
            take({c: np.concatenate([h[c] for h in held]) for c in held[0]})
        yield _pairs(seen)

    def _pairs(seen: set[tuple[int, int]]) -> pa.RecordBatch:
        p = np.array(sorted(seen), dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(p[:, 0]), pa.array(p[:, 1])], names=["a", "b"])

    return run


def _frequent_bits(docs: DataFrame, k: int) -> np.ndarray:
    """A table of 2 ** BITS bits, set for shingles that FREQUENT documents or more hold.

    Counted over all documents: a task counts its own, and only what it has met twice is summed further,
    so a shingle spread thinner than that over the tasks may be missed. The table only orders shingles;
    any order gives the same links. The driver gets the table's words that aren't 0, at most 2 MB.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        size = 0

        def met_twice() -> pa.RecordBatch:
            s = np.sort(np.concatenate(held)) if held else np.zeros(0, np.uint64)
            at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
            n = np.diff(at, append=len(s))
            return pa.RecordBatch.from_arrays([pa.array(s[at][n > 1].view(np.int64)), pa.array(n[n > 1])], names=["token", "n"])

        for b in slices(batches):
            for s in shingle_sets(b.column(0).to_pylist(), k):
                held.append(s)
                size += len(s)
                if size > 8_000_000:
                    yield met_twice()
                    held, size = [], 0
        yield met_twice()

    seen = docs.select("text").mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= FREQUENT)
    return bit_table(seen.select("token"))


def bit_table(hashes: DataFrame) -> np.ndarray:
    """2 ** BITS bits, set for the first BITS bits of each hash in a column of longs. Bits are joined to words
    before they come to the driver: at most 2 MB, whatever the number of hashes."""
    bit = F.shiftrightunsigned(hashes.columns[0], 64 - BITS)
    at = hashes.select(bit.bitwiseAND(F.lit(63)).alias("b"), F.shiftright(bit, 6).alias("w"))
    words = at.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, cast(b as int))")).alias("x"))
    table = np.zeros(1 << (BITS - 6), dtype=np.int64)
    for w, x in words.collect():
        table[w] = x
    return table.view(np.uint64)


def in_table(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    bit = hashes.view(np.uint64) >> np.uint64(64 - BITS)
    return (table[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) != 0


def jaccard_classes(docs: DataFrame, *, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of docs (doc_id integer, text): doc_id, n_shingles, class_id, component_id.

    Documents with the same set of shingles are one class (class_id: its least doc_id). Two sets link when
    100 * intersection >= percent * union; component_id is the least doc_id reachable over links. No link
    is lost and no cap is set:

    1. Each set is ordered by (frequent or not, hash); two sets that link share a shingle of their first
       n - ceil(percent * n / 100) + 1. Classes that share one form a block: nothing else need be compared.
    2. Every member is compared with its block's least member, by the bound of 3 first: as many pairs as members. A block whose
       members are in one component by then, or that has two members, is done.
    3. In the others, hashed counts by group are points of an R-tree. Summed coordinate minima bound the
       intersection; leaves and then points that can't reach the threshold, or whose component is the same,
       are left out; the best few partners are verified first, then, after the components have been
       joined anew, all others.

    All that is verified is verified exactly, on the sets. Blocks of more than SHARE members are dealt
    over tasks by pairs of shares, so none holds an unbounded block. Pairs of a group of near copies aren't
    emitted once they are known to be connected. Texts are never shuffled, and sets only of documents in
    a pair that passed the bound. What is broadcast are tables of 2 ** BITS bits: of frequent shingles, of repeated
    ones, of documents in pairs. They save shuffles; a full one, as at a great scale, changes no result.

    Null and empty texts: no shingles, linked with nothing, component_id = doc_id. A null doc_id takes its
    class's ids, null if the class has none. Rows with the same doc_id are one document; ties fall to the least id. Words of a very
    long text are found piece by piece, and its set is one array. Other columns are
    ignored. No rows give no rows.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bits = _frequent_bits(docs, words)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            n, d1, d2, vec, prefix = [], [], [], [], []
            for s in shingle_sets(b.column("text").to_pylist(), words):
                n.append(len(s))
                with np.errstate(over="ignore"):
                    d1.append(int(np.bitwise_xor.reduce(mix(s + _P)).view(np.int64)) if len(s) else 0)
                    d2.append(int(np.add.reduce(mix(s ^ _P)).view(np.int64)) if len(s) else 0)
                vec.append(count_vector(s).tobytes())
                often = in_table(s, bits)
                first = np.concatenate([s[~often], s[often]])  # both parts stay in order of hash
                prefix.append(first[: len(s) + (-percent * len(s) // 100) + 1].view(np.int64) if len(s) else first.view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()), pa.array(vec, pa.binary()), pa.array(prefix, pa.list_(pa.int64()))], names=["doc_id", "n", "d1", "d2", "vec", "prefix"])

    signed = stored(docs.mapInArrow(sign, "doc_id long, n long, d1 long, d2 long, vec binary, prefix array<long>"), "jaccard")
    ids = stored(signed.select("doc_id", "n", "d1", "d2"), "jaccard")
    classes = stored(ids.where("n > 0").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "jaccard")
    reps = signed.join(classes, ["d1", "d2"]).where("doc_id = rep").dropDuplicates(["doc_id", "d1", "d2"]).select(F.col("doc_id").alias("doc"), "n", "vec", "prefix")
    reps = stored(reps, "jaccard")
    forget(signed)
    reclaim(docs.sparkSession)
    points = stored(reps.select("doc", "n", "vec"), "jaccard")

    # Most shingles of the prefixes occur once: their count alone is shuffled, and a table of bits keeps most of
    # them from being shuffled again with their documents.
    repeated = bit_table(reps.select(F.explode("prefix").alias("token")).groupBy("token").count().where("count > 1").select("token"))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("prefix")
            token, of = lists.flatten().to_numpy(zero_copy_only=False), pa.compute.list_parent_indices(lists)
            keep = in_table(token, repeated)
            yield pa.RecordBatch.from_arrays([pa.array(token[keep]), b.column("doc").take(of.filter(pa.array(keep)))], names=["token", "doc"])

    tokens = stored(reps.select("doc", "prefix").mapInArrow(spread, "token long, doc long"), "jaccard")
    forget(reps)
    blocks = tokens.groupBy("token").agg(F.count("*").alias("members"), F.min("doc").alias("least"), F.bit_xor(F.xxhash64("doc")).alias("s1"), F.bit_xor(F.xxhash64(F.lit(1), "doc")).alias("s2")).where("members > 1")
    # Blocks with the same members are one.
    blocks = stored(blocks.groupBy("members", "least", "s1", "s2").agg(F.min("token").alias("token")).drop("s1", "s2"), "jaccard")
    members = stored(tokens.join(blocks, "token"), "jaccard")
    forget(tokens)
    reclaim(docs.sparkSession)
    star = members.where("doc > least").select(F.col("least").alias("a"), F.col("doc").alias("b")).distinct()

    def within_bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, m = (b.column(c).to_numpy() for c in ("n", "m"))
            if not len(n):
                continue
            bound = np.minimum(read_vectors(b.column("v").to_pylist()), read_vectors(b.column("w").to_pylist())).sum(axis=1)
            keep = pa.array(bound >= least_overlap(n, m, percent))
            yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])

    with_points = star.join(points.toDF("a", "n", "v"), "a").join(points.toDF("b", "m", "w"), "b")
    star = with_points.where(f"100 * least(n, m) >= {percent} * greatest(n, m)").mapInArrow(within_bound, "a long, b long")

    def verified(pairs: DataFrame) -> DataFrame:
        """Those of the pairs that link, compared on the sets. Only the sets of documents in a pair (and the few
        that share a bit with one) leave the scan of the texts."""
        pairs = stored(pairs, "jaccard")
        reclaim(docs.sparkSession)
        involved = bit_table(pairs.select(F.explode(F.array("a", "b")).alias("doc")).select(F.xxhash64("doc").alias("h")))

        def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices(batches):
                keep = np.flatnonzero(in_table(b.column("h").to_numpy(), involved))
                texts = b.column("text").take(pa.array(keep)).to_pylist()
                sets = [s.view(np.int64) for s in shingle_sets(texts, words)]
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(keep)), pa.array(sets, pa.list_(pa.int64()))], names=["doc", "s"])

        texts = docs.where("doc_id is not null").select("doc_id", "text", F.xxhash64("doc_id").alias("h"))
        sets = stored(texts.mapInArrow(expand, "doc long, s array<long>"), "jaccard")
        with_a = pairs.join(sets.toDF("a", "sa"), "a")
        both = with_a.join(sets.toDF("b", "sb"), "b")
        shared = both.select("a", "b", F.size(F.array_intersect("sa", "sb")).cast("long").alias("i"), (F.size("sa") + F.size("sb")).cast("long").alias("t"))
        out = stored(shared.where(f"100 * i >= {percent} * (t - i)").select("a", "b"), "jaccard")
        forget(sets, pairs)
        reclaim(docs.sparkSession)
        return out

    links = verified(star)
    comps = stored(components(links), "jaccard")
    many = members.where("members > 2").select("token", "doc", "members")
    for window in ((0, 4), (4, None)):
        known = many.join(comps.withColumnRenamed("node", "doc"), "doc", "left").withColumn("comp", F.coalesce("component", "doc"))
        known = stored(known.select("token", "doc", "members", "comp"), "jaccard")
        mixed = known.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token")
        open_ = known.join(mixed, "token").join(points, "doc")
        parts = F.ceil(F.col("members") / SHARE).cast("long")
        mine = F.pmod(F.xxhash64("doc"), parts)
        dealt = open_.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
        dealt = dealt.withColumns({"i": F.least("mine", "other"), "j": F.greatest("mine", "other")}).withColumns({"left": F.col("mine") == F.col("i"), "right": F.col("mine") == F.col("j")})
        dealt = dealt.select("token", "i", "j", "doc", "comp", "n", "vec", "left", "right").repartition("token", "i", "j").sortWithinPartitions("token", "i", "j")
        links = links.union(verified(dealt.mapInArrow(_search_blocks(percent, window), "a long, b long").distinct()))
        comps = stored(components(links), "jaccard")
        forget(known)

    out = ids.join(classes, ["d1", "d2"], "left")
    out = out.withColumn("class_id", F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("doc_id")))
    out = out.join(comps.withColumnRenamed("node", "class_id"), "class_id", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), "class_id", F.coalesce("component", "class_id").alias("component_id"))
