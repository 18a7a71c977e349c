"""Vector compression: product codes whose codebooks come from a tree of NumPy sums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .vectors import finite, narrow, whole_columns, wide

#: Vectors whose distances to one codebook are held at a time.
AT_ONCE = 1024


def assign(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of a codebook (entries x width) for the columns of a part (width x vectors), the first of equals, and
    its squared distance. Distances grow by one dimension at a time, some vectors by all entries."""
    n = part.shape[1]
    nearest, distance = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    for s in range(0, n, AT_ONCE):
        sum_of = np.zeros((min(AT_ONCE, n - s), len(book)), dtype=np.int64)
        for column, entries in zip(part[:, s : s + AT_ONCE], book.T, strict=True):
            apart = column[:, None] - entries[None, :]
            apart *= apart
            sum_of += apart
        nearest[s : s + AT_ONCE] = best = sum_of.argmin(axis=1)
        distance[s : s + AT_ONCE] = sum_of[np.arange(len(best)), best]
    return nearest, distance


class Sums:
    """What a round gathers: for every part and entry the number of its vectors and the sum of their components."""

    def __init__(self, books: np.ndarray):
        self.count = np.zeros(books.shape[:2], dtype=np.int64)
        self.sum = np.zeros(books.shape, dtype=np.int64)
        self.most = 0  # the largest magnitude of a component

    def add(self, block: np.ndarray, books: np.ndarray) -> Sums:
        for p, book in enumerate(books):
            part = block[p * book.shape[1] : (p + 1) * book.shape[1]]
            nearest, _ = assign(part, book)
            np.add.at(self.count[p], nearest, 1)
            np.add.at(self.sum[p], nearest, part.T)
        self.most = max(self.most, int(np.abs(block).max(initial=0)))
        return self

    def merge(self, other: Sums) -> Sums:
        self.count += other.count
        self.sum += other.sum
        self.most = max(self.most, other.most)
        return self

    def means(self, books: np.ndarray) -> np.ndarray:
        if int(self.count.max(initial=0)) * self.most >= 1 << 63:
            raise ArithmeticError("the sums of a codebook entry don't fit 64 bits")
        used = self.count > 0
        return np.where(used[..., None], self.sum // np.maximum(self.count, 1)[..., None], books)


def padded_dims(dims: int, parts: int) -> int:
    return max(1, -(-dims // parts)) * parts


def _blocks(dims: int, parts: int, rows: int):
    """Vectors of one length as blocks of columns, with their ids and labels beside them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, rows):
                b = whole.slice(s, rows)
                block = np.zeros((padded_dims(dims, parts), b.num_rows), dtype=np.int64)
                block[:dims] = whole_columns(b.column("x"), dims)
                one = pa.array([0, b.num_rows], pa.int32())
                lists = [pa.ListArray.from_arrays(one, pa.concat_arrays([b.column(c)])) for c in ("id", "label")]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([narrow(block)], pa.binary())], names=["id", "label", "columns"])

    return run


def _encode(books: np.ndarray):
    """The vectors of blocks with their codes and errors."""
    parts, _, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                block = wide(b.column("columns")[i].as_py()).reshape(parts * width, -1)
                code, error = np.empty((block.shape[1], parts), dtype=np.uint8), np.zeros(block.shape[1], dtype=np.int64)
                for p, book in enumerate(books):
                    code[:, p], distance = assign(block[p * width : (p + 1) * width], book)
                    error += distance
                digits = code.tobytes().hex()
                codes = pa.array([digits[k : k + 2 * parts] for k in range(0, len(digits), 2 * parts)], pa.string())
                yield pa.RecordBatch.from_arrays([b.column("id")[i].values, b.column("label")[i].values, codes, pa.array(error)], names=["vec_id", "label", "code", "error"])

    return run


def vector_codes(vectors: DataFrame, *, parts: int = 16, entries: int = 64, rounds: int = 2, vec_id: str = "vec_id", embedding: str = "embedding", label: str = "label", block_rows: int = 8192, depth: int = 2) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """Product codes of all vectors, and the codebooks (parts x entries x width) by vector length.

    The frame has one row for each vector without null or non-finite components: vec_id, label, code, error, label_error,
    codebooks_sha256. Components are floor(256 * x); a vector is cut into `parts` equal parts. The codebook of a part begins as
    that part of the `entries` smallest vec_ids' vectors. In each of `rounds` rounds every part goes to the nearest entry by squared
    Euclidean distance (the first of equals) and each entry becomes its parts' mean, rounded down; unused ones stay.
    code has two hexadecimal digits a part, error is the sum of its final squared distances, label_error the sum of errors over
    the same label. All of it is whole-number arithmetic, so no order of tasks changes a digit.

    How: vectors are written once as columnar blocks of block_rows, a row each. A round is one treeAggregate over the blocks:
    a task adds its blocks' sums and counts by np.add.at into one tensor, and tensors of parts * entries * (width + 1) numbers merge
    in a tree of `depth` levels; only that one tensor, whose size doesn't depend on the data, comes to the driver. Labels' errors
    are summed before they are joined, so a hot label is a join that AQE splits; Spark broadcasts the sums if their table is
    below its threshold.

    Null vectors are dropped; null labels are one label. A null vec_id comes after all others, rows that repeat a vec_id are rows of their own,
    in the order of their vectors; fewer than `entries` vectors make fewer entries. Each vector length has its own codebooks;
    a length that `parts` doesn't divide is filled up with zeros. Other columns are ignored. Components whose squared
    distances might not fit 64 bits (beyond 46,000 in 64 dimensions) are an ArithmeticError. No rows give no rows.
    """
    if not 1 <= entries <= 256 or parts < 1 or rounds < 0:
        raise ValueError("entries lie between 1 and 256, parts are at least 1, rounds at least 0")
    spark = vectors.sparkSession
    rows = vectors.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), F.col(embedding).alias("x")).where(finite("x"))
    kinds = dict(rows.dtypes)
    lengths = sorted(r[0] for r in rows.select(F.size("x")).distinct().collect())  # lengths of vectors, a handful
    books_of: dict[int, np.ndarray] = {}
    out = None
    for dims in lengths:
        mine = rows.where(F.size("x") == dims)
        blocks = stored(mine.mapInArrow(_blocks(dims, parts, block_rows), f"id array<{kinds['id']}>, label array<{kinds['label']}>, columns binary"), "codes")
        seeds = mine.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).select("x").collect()  # `entries` vectors
        width = padded_dims(dims, parts) // parts
        start = np.zeros((len(seeds), parts * width), dtype=np.int64)
        start[:, :dims] = whole_columns(pa.array([r.x for r in seeds], pa.list_(pa.float64())), dims).T
        books = start.reshape(len(seeds), parts, width).transpose(1, 0, 2)
        held = blocks.select("columns").rdd
        for _ in range(rounds):
            now = spark.sparkContext.broadcast(books)  # parts * entries * width numbers

            def gather(sums: Sums | None, row, now=now) -> Sums:
                books = now.value
                return (sums or Sums(books)).add(wide(bytes(row.columns)).reshape(books.shape[0] * books.shape[2], -1), books)

            total = held.treeAggregate(None, gather, lambda a, b: a.merge(b) if a and b else a or b, depth)
            books = total.means(books)
            now.unpersist()
        books_of[dims] = books
        coded = blocks.mapInArrow(_encode(books), f"vec_id {kinds['id']}, label {kinds['label']}, code string, error long")
        coded = coded.withColumn("codebooks_sha256", F.lit(books_digest(books)))
        out = coded if out is None else out.unionByName(coded)
    if out is None:
        none = f"vec_id {kinds['id']}, label {kinds['label']}, code string, error long, label_error long, codebooks_sha256 string"
        return spark.createDataFrame([], none), books_of
    sums = stored(out.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "codes")
    out = out.join(sums, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")
    return out, books_of


def books_digest(books: np.ndarray) -> str:
    """SHA-256 of all entries' components by part, entry and place, decimal, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The vector that a code stands for, as floats."""
    from .vectors import SCALE

    return np.concatenate([book[i] for book, i in zip(books, bytes.fromhex(code), strict=True)]) / SCALE
