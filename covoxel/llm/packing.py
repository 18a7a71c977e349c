"""Packing documents into token sequences, by minimum bin slack."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stored

#: Words whose ids a worker remembers; at this number it starts anew. It changes no result.
REMEMBERED = 600_000
PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


class _Words(dict):
    """The ids (little-endian unsigned 32-bit) of words between spaces and line ends.

    The vocabulary drops white space and lowers case, so a text's ids are those of its words, one after
    the other, and ASCII letters may be lowered before. A word of ASCII letters is one unit to the
    vocabulary's splitter; so is a full stop or comma behind it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.any = Tokenizer.from_file(path)
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.NFC()
        self.letters.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)

    def __missing__(self, word: bytes) -> bytes:
        if word[-1:] in (b".", b",") and word[:-1].isalpha():
            return self[word[:-1]] + self[word[-1:]]
        by = self.letters if word.isalpha() else self.any
        ids = self[word] = array("I", by.encode(word.decode(), add_special_tokens=False).ids).tobytes()
        return ids


@cache
def _words(path: str) -> _Words:
    return _Words(path)


def token_bytes(text: str | None, path: str) -> bytes:
    """The ids of a text (null: none) as little-endian unsigned 32-bit numbers."""
    words = _words(path)
    if len(words) > REMEMBERED:
        words.clear()
    # Only spaces and line ends split here: the vocabulary's splitter never joins what they part.
    return b"".join(map(words.__getitem__, (text or "").encode("utf-8", "replace").lower().replace(b"\n", b" ").split(b" "))) if text else b""


def fill_plan(counts: dict[int, int], capacity: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Minimum bin slack over a histogram of lengths: [(windows, [(length, how many in each window)])].

    Each round fixes the longest remaining piece and looks for the multiset of the remaining lengths
    that fills its window closest to capacity: bit s of a big integer says that the sum s can be
    reached, lengths are added from the longest down (a length that occurs c times as parts of 1, 2,
    4, ... pieces), and the steps are traced back to counts. The filling is then used for as many
    windows as its lengths last: each round leaves one length with fewer pieces than a window took of it, at
    most half of what it had, so a length n ends a round at most log2(capacity / n) + 2 times and there are at most
    4 * capacity rounds, whatever the number of documents. Deterministic; an empty histogram has an empty plan.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    order = sorted(left, reverse=True)
    full = (1 << (capacity + 1)) - 1
    plan = []
    while order:
        first = order[0]
        room = capacity - first
        reach, steps = 1, []
        for n in order:
            if n > room or reach >> room & 1:
                continue
            c, part = min(left[n] - (n == first), room // n), 1
            while c > 0 and not reach >> room & 1:
                k = min(part, c)
                new = (reach | reach << n * k) & full
                if new != reach:
                    steps.append((n, k, reach))
                    reach = new
                c, part = c - k, part * 2
        got = (reach & ((1 << (room + 1)) - 1)).bit_length() - 1
        use = {first: 1}
        for n, k, before in reversed(steps):
            if not before >> got & 1:
                use[n] = use.get(n, 0) + k
                got -= n * k
        times = min(left[n] // k for n, k in use.items())
        plan.append((times, sorted(use.items(), reverse=True)))
        for n, k in use.items():
            left[n] -= times * k
        order = [n for n in order if left[n] > 0]
    return plan


def _runs(plan: list[tuple[int, list[tuple[int, int]]]], capacity: int) -> dict[int, np.ndarray]:
    """By length: rows (first rank, pieces in a window, first window, first offset, the window's fill)."""
    at, seq, out = {}, 0, {}
    for times, use in plan:
        offset, fill = 0, sum(n * k for n, k in use)
        for n, k in use:
            out.setdefault(n, []).append((at.get(n, 0), k, seq, offset, fill))
            at[n] = at.get(n, 0) + times * k
            offset += n * k
        seq += times
    return {n: np.array(r, dtype=np.int64) for n, r in out.items()}


def pack(docs: DataFrame, tokenizer: str, *, capacity: int = 4096, end_id: int = 2, per_task: int = 50_000, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    padded (what its sequence is padded to); with_ids adds the ids themselves.

    A document is its text's ids and end_id. It is cut at multiples of capacity; the last pieces are
    packed by fill_plan() over the histogram of lengths, which has at most `capacity` rows however many
    documents there are: that, and the plan, are all that the driver and the tasks hold. A piece's
    window and offset follow from its rank among the pieces of its length. Ranks are given within
    salted shares of a length of about per_task pieces, so a length that a third of the pieces have is
    split. Neither texts nor ids are shuffled. A sequence whose fill is a power of two isn't padded.

    Null and empty texts: end_id alone. Repeated rows are packed once per row. Null ids stay null.
    No rows give no rows. Other columns are dropped. Very long texts give many pieces.
    """
    kind = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {kind}, {PIECE}" + ", ids binary" * with_ids
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2000):
            rows: list[list] = [[] for _ in range(5 + with_ids)]
            for i, text in enumerate(b.column("text")):
                ids = token_bytes(text.as_py(), tokenizer) + end
                for at in range(0, len(ids), 4 * capacity):
                    piece = ids[at : at + 4 * capacity]
                    for col, x in zip(rows, (i, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4, piece), strict=False):
                        col.append(x)
            cols = [b.column("doc_id").take(pa.array(rows[0], pa.int64())), *(pa.array(x, pa.int64()) for x in rows[1:5]), *(pa.array(x, pa.binary()) for x in rows[5:])]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"][: 5 + with_ids])

    pieces = stored(docs.select("doc_id", "text").mapInArrow(cut, schema), "pack")
    counts = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    runs = _runs(fill_plan(counts, capacity), capacity)
    salts = max(16, -(-max(counts.values(), default=0) // per_task))

    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(salts)).cast("int"))
    shares = salted.groupBy("length", "salt").count()
    before = F.sum("count").over(Window.partitionBy("length").orderBy("salt")) - F.col("count")
    shares = shares.select(F.col("length").alias("l"), F.col("salt").alias("s"), before.alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "start", "ids_crc32"))
    ranked = salted.withColumn("within", within).join(shares, (F.col("length") == F.col("l")) & (F.col("salt") == F.col("s")))
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within") - 1).drop("salt", "within", "l", "s", "before")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, rank = (b.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            seq, offset, fill = (np.zeros(len(n), dtype=np.int64) for _ in range(3))
            for m in np.unique(n):
                rows, at = runs[int(m)], np.flatnonzero(n == m)
                r = rows[np.searchsorted(rows[:, 0], rank[at], side="right") - 1]
                k = rank[at] - r[:, 0]
                seq[at], offset[at], fill[at] = r[:, 2] + k // r[:, 1], r[:, 3] + k % r[:, 1] * m, r[:, 4]
            padded = np.where(fill & (fill - 1) == 0, fill, capacity)
            cols = [b.column(i) for i in range(b.num_columns) if b.schema.names[i] != "rank"]
            names = [x for x in b.schema.names if x != "rank"]
            yield pa.RecordBatch.from_arrays([*cols, *map(pa.array, (seq, offset, padded))], names=[*names, "sequence_id", "offset", "padded"])

    return ranked.mapInArrow(place, f"{schema}, sequence_id long, offset long, padded long")
