"""Hard negatives by a vector-approximation file."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import finite, narrow, whole_columns, wide

#: Cells of a dimension: a byte tells which.
CELLS = 256
#: Anchors whose bounds are held at a time; bytes of vectors in a group; anchors of a group.
AT_ONCE, GROUP_BYTES, GROUP_ANCHORS = 128, 32 << 20, 4096
#: Below every score.
NONE = -(1 << 62)

BLOCK = "block long, dims int, n long, ids binary, labels binary, anchors binary, low binary, step binary, cells binary, exact binary"
ANCHORS = "block long, dims int, n long, at binary, labels binary, exact binary"
FOUND = "anchor_block long, at int, slot int, score long, other long"


def quantise(columns: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of equal width between the least and the largest component of each dimension: the least ones, the widths, and the
    cell of each component. Components within least + width * cell + (0 .. width - 1) are in the cell."""
    low = columns.min(axis=1)
    step = (columns.max(axis=1) - low) // CELLS + 1
    return low, step, ((columns - low[:, None]) // step[:, None]).astype(np.uint8)


def bounds(anchors: np.ndarray, low: np.ndarray, step: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of the scores of anchors (rows) with the vectors of a block, from their cells alone: for every
    dimension a table of the least and the largest product in each cell, looked up by all vectors."""
    lower = np.zeros((len(anchors), cells.shape[1]), dtype=np.int64)
    upper = np.zeros_like(lower)
    for d in range(len(low)):
        left = low[d] + step[d] * np.arange(CELLS)
        of_left, of_right = anchors[:, d, None] * left, anchors[:, d, None] * (left + step[d] - 1)
        lower += np.take(np.minimum(of_left, of_right), cells[d], axis=1)
        upper += np.take(np.maximum(of_left, of_right), cells[d], axis=1)
    return lower, upper


class Best:
    """The first `most` of the vectors seen so far for each of some slots: larger scores first, then smaller ids."""

    def __init__(self, slots: int, most: int):
        self.most = most
        self.slot, self.score, self.other = (np.zeros(0, dtype=np.int64) for _ in range(3))
        self.last = np.full(slots, NONE)  # the score of the last one, where there are `most`

    def add(self, slot: np.ndarray, score: np.ndarray, other: np.ndarray) -> None:
        slot, score, other = (np.concatenate(x) for x in ((self.slot, slot), (self.score, score), (self.other, other)))
        order = np.lexsort((other, -score, slot))
        slot = slot[order]
        first = np.flatnonzero(np.diff(slot, prepend=-1))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(first, append=len(slot)))
        keep = order[rank < self.most]
        self.slot, self.score, self.other = slot[rank < self.most], score[keep], other[keep]
        full = rank == self.most - 1
        self.last[slot[full]] = score[order[full]]


def _at_least(values: np.ndarray, ok: np.ndarray, most: int) -> np.ndarray:
    """For each row, the `most`-th largest of the values that are ok; NONE where there are fewer."""
    if values.shape[1] < most:
        return np.full(len(values), NONE)
    return np.partition(np.where(ok, values, NONE), values.shape[1] - most, axis=1)[:, values.shape[1] - most]


class Block:
    """A stored block of vectors."""

    def __init__(self, row: dict):
        self.block, self.dims, self.n = row["block"], row["dims"], row["n"]
        self.ids, self.labels = wide(row["ids"]), wide(row["labels"])
        self.low, self.step = wide(row["low"]), wide(row["step"])
        self.cells = np.frombuffer(row["cells"], dtype=np.uint8).reshape(self.dims, self.n)
        self.packed = row["exact"]

    def exact(self, rows: np.ndarray) -> np.ndarray:
        """The vectors of some rows; the others' components aren't widened."""
        b = self.packed
        return np.frombuffer(b, dtype=f"<i{b[0]}", offset=1).reshape(self.n, self.dims)[rows].astype(np.int64)


class Anchors:
    """Some anchors of one vector length."""

    def __init__(self, rows: list[dict]):
        self.block = np.concatenate([np.full(r["n"], r["block"]) for r in rows])
        self.at, self.labels = (np.concatenate([wide(r[c]) for r in rows]) for c in ("at", "labels"))
        self.exact = np.concatenate([wide(r["exact"]).reshape(r["n"], r["dims"]) for r in rows])

    def __getitem__(self, of: slice) -> Anchors:
        part = object.__new__(Anchors)
        part.block, part.at, part.labels, part.exact = self.block[of], self.at[of], self.labels[of], self.exact[of]
        return part

    def __len__(self) -> int:
        return len(self.at)


def _parts(rows: list[dict]) -> Iterator[tuple[Anchors, np.ndarray]]:
    """AT_ONCE anchors at a time, with the windows that are asked of them: the anchor, the slot, the least and the largest score,
    by anchor."""
    a = Anchors(rows)
    of_at = {x: k for k, x in enumerate(zip(a.block.tolist(), a.at.tolist(), strict=True))}
    asked = sorted((of_at[r["block"], w["at"]], w["slot"], w["low"], w["high"]) for r in rows for w in r.get("windows", ()))
    windows = np.array(asked, dtype=np.int64).reshape(-1, 4).T
    for s in range(0, len(a), AT_ONCE):
        mine = windows[:, slice(*np.searchsorted(windows[0], [s, s + AT_ONCE]))].copy()
        mine[0] -= s
        yield a[s : s + AT_ONCE], mine


def _scores(a: Anchors, rows: np.ndarray, b: Block, others: np.ndarray) -> np.ndarray:
    out = np.empty(len(rows), dtype=np.int64)
    for s in range(0, len(rows), 1 << 16):
        x = slice(s, s + (1 << 16))
        out[x] = np.einsum("ij,ij->i", a.exact[rows[x]], b.exact(others[x]))
    return out


def _positives(a: Anchors, blocks: list[Block], most: int) -> Best:
    """For each anchor the first rows of its label; only those whose upper bound reaches the last one known are scored."""
    best = Best(len(a), most)
    for b in blocks:
        lower, upper = bounds(a.exact, b.low, b.step, b.cells)
        like = a.labels[:, None] == b.labels[None, :]
        own = np.flatnonzero(a.block == b.block)
        like[own, a.at[own]] = False
        need = np.maximum(best.last, _at_least(lower, like, most))
        i, j = np.nonzero(like & (upper >= need[:, None]))
        best.add(i, _scores(a, i, b, j), b.ids[j])
    return best


def _negatives(a: Anchors, blocks: list[Block], most: int, row: np.ndarray, low: np.ndarray, high: np.ndarray) -> Best:
    """For each window (slots: an anchor's row, in order, and the least and the largest score) the first rows of other labels; only
    those whose bounds meet the window, above the last one known, are scored."""
    best = Best(len(row), most)
    nth = np.arange(len(row)) - np.searchsorted(row, row)  # which of its anchor's windows
    turns = [np.flatnonzero(nth == k) for k in range(int(nth.max(initial=-1)) + 1)]
    for b in blocks:
        lower, upper = bounds(a.exact, b.low, b.step, b.cells)
        unlike = a.labels[:, None] != b.labels[None, :]
        chosen, need = np.zeros(lower.shape, dtype=bool), np.maximum(low, best.last)
        for slots in turns:
            x, hi = row[slots], high[slots][:, None]
            if (best.last[slots] == NONE).any():
                sure = unlike[x] & (lower[x] >= low[slots][:, None]) & (upper[x] <= hi)
                need[slots] = np.maximum(need[slots], _at_least(lower[x], sure, most))
            chosen[x] |= unlike[x] & (upper[x] >= need[slots][:, None]) & (lower[x] <= hi)
        i, j = np.nonzero(chosen)
        score = _scores(a, i, b, j)
        first = np.searchsorted(i, np.arange(len(a) + 1))
        # For every slot the scored rows of its anchor, one after another.
        n = first[row + 1] - first[row]
        slot, take = np.repeat(np.arange(len(row)), n), np.repeat(first[row] - np.cumsum(n) + n, n) + np.arange(n.sum())
        fits = (score[take] >= need[slot]) & (score[take] <= high[slot])
        best.add(slot[fits], score[take[fits]], b.ids[j[take[fits]]])
    return best


def _make_blocks(rows: int):
    """Vectors as they come, as blocks of one length each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 32
        for batch in batches:
            lengths = pa.compute.list_value_length(batch.column("x"))
            for dims in pa.compute.unique(lengths).to_pylist():
                whole = batch.filter(pa.compute.equal(lengths, dims))
                for s in range(0, whole.num_rows, rows):
                    b = whole.slice(s, rows)
                    columns = whole_columns(b.column("x"), dims)
                    low, step, cells = quantise(columns)
                    ids, labels, anchors = (b.column(c).to_numpy(zero_copy_only=False) for c in ("id", "label", "anchor"))
                    cols = [at, dims, b.num_rows, narrow(ids), narrow(labels), narrow(anchors.astype(np.int64)), narrow(low), narrow(step), cells.tobytes(), narrow(columns.T)]
                    at += 1
                    yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cols, [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 7], strict=True)], names=[c.split()[0] for c in BLOCK.split(", ")])

    return run


def _take_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            at = np.flatnonzero(wide(r["anchors"]))
            if len(at):
                cols = [r["block"], r["dims"], len(at), narrow(at), narrow(wide(r["labels"])[at]), narrow(wide(r["exact"]).reshape(r["n"], r["dims"])[at])]
                yield pa.RecordBatch.from_arrays([pa.array([c], t) for c, t in zip(cols, [pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 3], strict=True)], names=[c.split()[0] for c in ANCHORS.split(", ")])


def _blocks_of(right: pa.Table, dims: int) -> Iterator[Block]:
    for batch in right.to_batches(max_chunksize=1):
        if batch.num_rows and batch.column("dims")[0].as_py() == dims:
            yield Block(batch.to_pylist()[0])


def _search(most: int, windows: bool):
    """A group of anchors against a group of blocks. Without windows, slot 0 is the anchor; with, a slot is a positive's rank."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out = [pa.table({"anchor_block": pa.array([], pa.int64()), "at": pa.array([], pa.int32()), "slot": pa.array([], pa.int32()), "score": pa.array([], pa.int64()), "other": pa.array([], pa.int64())})]
        rows = left.to_pylist()
        for dims in sorted({r["dims"] for r in rows}):
            blocks = list(_blocks_of(right, dims))
            for a, asked in _parts([r for r in rows if r["dims"] == dims]):
                if not windows:
                    best = _positives(a, blocks, most)
                    row, rank = best.slot, np.zeros(len(best.slot), dtype=np.int64)
                else:
                    at, slots, low, high = asked
                    best = _negatives(a, blocks, most, at, low, high)
                    row, rank = at[best.slot], slots[best.slot]
                out.append(pa.table([pa.array(a.block[row]), pa.array(a.at[row], pa.int32()), pa.array(rank, pa.int32()), pa.array(best.score), pa.array(best.other)], names=out[0].column_names))
        return pa.concat_tables(out)

    return run


def hard_negatives(vectors: DataFrame, anchors: Column, *, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", block_rows: int = 4096) -> DataFrame:
    """For every anchor (rows of vectors for which `anchors` is true) and each of its `positives` best rows of the same label, the
    `negatives` best rows of other labels whose score is between low and high percent of the positive's: anchor_id, positive_id,
    rank (from 1), negative_id, positive_score, negative_score, positive_rank.

    Components are floor(256 * x), a score is the whole-number inner product; larger scores come first, ties by smaller id. A positive with a
    negative score has no window; where fewer rows fit, all are returned. Exact: bounds only spare scores.

    How: vectors are written once, in blocks; each block holds, next to its vectors, their cells in every dimension, a byte each, in steps
    of its own between its extremes (so an odd vector blurs one block at most). Groups of up to GROUP_ANCHORS anchors meet groups of about
    GROUP_BYTES of blocks, one task each; the pairs of groups are dealt evenly whatever the labels, so a hot
    label is no hot key. In a task, tables of the least and largest product by cell give each score's bounds; a vector is scored
    exactly only if its bounds can enter the window: first the positives (above the last of the best known), then, with their
    windows known, the negatives. Every task sends on the few best of its blocks for each anchor, and a window over
    anchors merges them. Work is anchors x vectors, the stated query set against all rows. Memory: one group of either side and
    AT_ONCE x block_rows bounds. Nothing but group counts comes to the driver.

    Rows with a null id, label or vector, or a null or non-finite component, take no part. Rows that repeat an id are rows of their own, so an
    anchor that occurs twice is answered twice. Vectors of unlike lengths have no score with each other. Empty vectors score 0. Other columns are
    ignored. Components whose scores might not fit 64 bits (beyond 46,000 in 64 dimensions) are an ArithmeticError. No rows give no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(embedding).alias("x"), F.coalesce(anchors, F.lit(False)).alias("anchor"))
    rows = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & finite("x"))
    blocks = stored(rows.mapInArrow(_make_blocks(block_rows), BLOCK), "negatives")
    chosen = stored(blocks.mapInArrow(_take_anchors, ANCHORS), "negatives")
    size, n_blocks = blocks.agg(F.sum(F.length("cells") + F.length("exact")), F.count("*")).first()
    some = chosen.agg(F.sum("n")).first()[0] or 0
    # Enough groups to bound a task's memory and to occupy the cluster; a group without blocks does no harm.
    over = max(-(-(size or 0) // GROUP_BYTES), min(n_blocks, int(spark.conf.get("spark.sql.shuffle.partitions"))), 1)
    under = max(1, -(-some // GROUP_ANCHORS))
    deal = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    right = blocks.select("dims", "block", "n", "ids", "labels", "low", "step", "cells", "exact", deal("block", over).alias("h"), every(under).alias("g"))
    left = chosen.withColumn("g", deal("block", under)).withColumn("h", every(over))

    def search(left: DataFrame, most: int, windows: bool) -> DataFrame:
        return left.groupBy("g", "h").cogroup(right.groupBy("g", "h")).applyInArrow(_search(most, windows), FOUND)

    order = Window.partitionBy("anchor_block", "at", "slot").orderBy(F.desc("score"), "other")
    best = search(left, positives, False).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= positives)
    # floor and ceil of whole percentages; a window of a negative score is empty, as its ends are the wrong way round.
    share = lambda p, up: F.expr(f"{'-' if up else ''}((({'-' if up else ''}{p} * score) - pmod({'-' if up else ''}{p} * score, 100L)) div 100L)")
    best = stored(best.select("anchor_block", "at", F.col("rank").alias("slot"), F.col("score").alias("positive_score"), F.col("other").alias("positive_id"), share(low, True).alias("low"), share(high, False).alias("high")), "negatives")
    windows = best.where("low <= high").groupBy(F.col("anchor_block").alias("block")).agg(F.collect_list(F.struct("at", "slot", "low", "high")).alias("windows"))  # of a block's anchors, at most block_rows * positives
    asked = left.join(stored(windows, "negatives"), "block")
    found = search(asked, negatives, True).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    ids = blocks.mapInArrow(_anchor_ids, "anchor_block long, at int, anchor_id long")
    out = found.join(best, ["anchor_block", "at", "slot"]).join(ids, ["anchor_block", "at"])
    return out.select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"), F.col("slot").alias("positive_rank"))


def _anchor_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.select(["block", "ids", "anchors"]).to_pylist():
            at = np.flatnonzero(wide(r["anchors"]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), r["block"])), pa.array(at, pa.int32()), pa.array(wide(r["ids"])[at])], names=["anchor_block", "at", "anchor_id"])
