"""Language-model scoring with a probabilistic suffix tree over words."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import forget, reclaim, slices, stored, stored_by, trim, word_hashes

#: The end of a document as a word: a byte that no text holds.
END = b"\xff"
#: Divergences are summed as whole numbers of this part of a nat, so that no order of rows changes them.
UNIT = float(1 << 24)
#: Tables of packed arrays aren't compressed a second time.
PACKED = "uncompressed"
#: Odd multipliers: a string's number is that of its last word and multiples of those before it.
_TIMES = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], dtype=np.uint64).view(np.int64)


def token_hashes(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of the words of all texts, A-Z lowered, each text followed by END; and how many each text has, with it."""
    raw = b"".join((t or "").encode("utf-8", "replace").lower() + b" " + END + b" " for t in texts)
    words = np.concatenate([np.zeros(0, dtype=np.uint64), *(h for _, h in word_hashes(raw))]).view(np.int64)
    return words, np.diff(np.flatnonzero(words == end_hash()), prepend=-1)


@cache
def end_hash() -> int:
    return int(next(word_hashes(END))[1].view(np.int64)[0])


def packed(a: np.ndarray) -> bytes:
    """64-bit numbers as bytes: their count and width, then all lowest bytes, all second ones, and so on, compressed. Small
    numbers take a byte or less, sorted ones lose their common leading bits."""
    a = np.ascontiguousarray(a, dtype=np.int64)
    width = 8 if not len(a) or a.min() < 0 else max(1, (int(a.max()).bit_length() + 7) // 8)
    of, planes = a.view(np.uint8).reshape(-1, 8), np.empty((width, len(a)), dtype=np.uint8)
    for i in range(width):  # plane by plane: several times as fast as a transposed copy
        planes[i] = of[:, i]
    return len(a).to_bytes(8, "little") + bytes([width]) + pa.compress(planes, codec="zstd", asbytes=True)


def unpacked(b: bytes) -> np.ndarray:
    n, width = int.from_bytes(b[:8], "little"), b[8]
    planes = np.frombuffer(pa.decompress(memoryview(b)[9:], decompressed_size=width * n, codec="zstd"), dtype=np.uint8).reshape(width, n)
    out = np.zeros((n, 8), dtype=np.uint8)
    for i in range(width):
        out[:, i] = planes[i]
    return out.view(np.int64).ravel()


class Distinct:
    """The distinct keys of an array, sorted, and the place of one element of each."""

    def __init__(self, a: np.ndarray):
        self.order = np.argsort(a)
        ordered = a[self.order]
        self.new = np.ones(len(a), dtype=bool)
        np.not_equal(ordered[1:], ordered[:-1], out=self.new[1:])
        self.keys, self.one = ordered[self.new], self.order[self.new]

    @property
    def back(self) -> np.ndarray:
        out = np.empty(len(self.order), dtype=np.int64)
        out[self.order] = np.cumsum(self.new) - 1
        return out

    def total(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[self.order], np.flatnonzero(self.new)) if len(values) else values


# What is written between rounds: a block's documents' ids and its packed arrays by name. What blocks ask: sorted keys with a
# value each, for one part of the key space; kind 0 are strings, 1 contexts. What parts reply: a sum for each key.
STATE = "block long, ids array<{}>, held map<string, binary>"
ASKED = "block long, part long, kind long, keys binary, sums binary"
REPLY = "block long, part long, kind long, sums binary, total long, distinct long"


class Parameters:
    def __init__(self, depth: int, weight: float, divergence: float, least: int, parts: int):
        if not 0 <= depth < len(_TIMES):
            raise ValueError(f"depth lies between 0 and {len(_TIMES) - 1}")
        self.depth, self.weight, self.divergence, self.least, self.parts = depth, float(weight), divergence, least, parts
        self.rounds = depth + 2 if depth else 1
        self.total = self.distinct = 0


class Block:
    """The tokens of some documents, and what is known of the strings that end at each.

    Arrays by token: n(d) is the training count of the string of the d words before the token and the token itself;
    total(d) that of the d words alone, which is n(d - 1) one token earlier. Before a document's start stand ends.
    """

    def __init__(self, held: dict[str, bytes], by: Parameters):
        self.held, self.by = held, by
        self.length = unpacked(held["length"])
        self.start = np.cumsum(self.length) - self.length
        self.place = unpacked(held["place"])
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self._n: dict[int, np.ndarray] = {}
        self._keys: list[tuple[np.ndarray, np.ndarray]] = []  # by d: the strings, and the word d places before each token

    def n(self, d: int) -> np.ndarray:
        if d not in self._n:
            known = unpacked(self.held[f"n{d}"])
            self._n[d] = known if d else known[self.place]
        return self._n[d]

    def before(self, a: np.ndarray, fill: int) -> np.ndarray:
        """The value one token earlier, `fill` at a document's first token."""
        out = np.empty_like(a)
        out[1:] = a[:-1]
        out[self.start] = fill
        return out

    def strings(self, d: int) -> np.ndarray:
        """The number of the string of the d words before each token and the token."""
        if not self._keys:
            words = unpacked(self.held["table"])[self.place]
            self._keys.append((words * _TIMES[0], words))
        while len(self._keys) <= d:
            key, history = self._keys[-1]
            history = self.before(history, end_hash())
            self._keys.append((key + history * _TIMES[len(self._keys)], history))
        return self._keys[d][0]

    def total(self, d: int) -> np.ndarray:
        ends = int(self.n(0)[self.length[0] - 1])  # documents learned from: what a context of ends alone counts
        return self.before(self.n(d - 1), ends)

    def counted(self, d: int) -> tuple[np.ndarray, np.ndarray]:
        """Tokens whose context of d words has been seen often enough, and how often."""
        if d not in self.known:
            total = self.total(d)
            at = np.flatnonzero(total >= self.by.least)
            self.known[d] = at, total[at]
        return self.known[d]

    def contexts(self, d: int) -> np.ndarray:
        return self.before(self.strings(d - 1), d)

    def probabilities(self, depth: int) -> Iterator[np.ndarray]:
        """After contexts of 0, 1, ... depth words, where counted; elsewhere as after the longest that is."""
        p = (self.n(0) + 1) / (self.by.total + self.by.distinct + 1)
        yield p
        for d in range(1, depth + 1):
            at, total = self.counted(d)
            p = p.copy()
            p[at] = (self.n(d)[at] + self.by.weight * p[at]) / (total + self.by.weight)
            yield p

    def ask(self, level: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Round `level`: the strings of that level with their training counts here; and the contexts of one word less,
        each with what the strings that this block answers for add to its divergence: p ln(p / q) less the part of an
        unseen word's share, q r ln r."""
        learned = np.repeat(unpacked(self.held["learned"]), self.length)
        if level == 0:
            of = Distinct(unpacked(self.held["table"]) * _TIMES[0])
            yield 0, of.keys, np.bincount(self.place, weights=learned, minlength=len(of.keys)).astype(np.int64)[of.order]
        elif level <= self.by.depth:
            at, _ = self.counted(level)
            of = Distinct(self.strings(level)[at])
            yield 0, of.keys, of.total(learned[at])
        if level >= 2:
            d = level - 1
            one = unpacked(self.held["one"])  # one token of each string: 1, or 2 where this block answers for it
            x = np.flatnonzero(one)
            of = Distinct(self.contexts(d)[x])
            *_, q, p = self.probabilities(d)
            p, q, r = p[x], q[x], self.by.weight / (self.total(d)[x] + self.by.weight)
            adds = np.where((one[x] == 2) & (self.n(d)[x] > 0), p * np.log(p / q) - q * r * np.log(r), 0.0)
            yield 1, of.keys, of.total(np.rint(adds * UNIT).astype(np.int64))

    def hear(self, level: int, strings: np.ndarray, contexts: np.ndarray) -> None:
        """Takes the sums of round `level` over all blocks, doubled, plus 1 where this block is the first to hold the key. A
        context is retained if its divergence reaches the limit; best is the longest retained by token."""
        if level == 0:
            of = Distinct(unpacked(self.held["table"]) * _TIMES[0])
            known = (strings >> 1)[of.back]
            self.held["n0"] = packed(known)
            self._n[0] = known[self.place]
        elif level <= self.by.depth:
            at, _ = self.counted(level)
            of = Distinct(self.strings(level)[at])
            n, one = np.zeros(len(self.place), dtype=np.int64), np.zeros(len(self.place), dtype=np.int64)
            n[at] = (strings >> 1)[of.back]
            one[at[of.one]] = 1 + (strings & 1)
            self._n[level] = n
            self.held |= {f"n{level}": packed(n), "one": packed(one)}
        if level >= 2:
            at, total = self.counted(level - 1)
            r = self.by.weight / (total + self.by.weight)
            kept = (contexts >> 1)[Distinct(self.contexts(level - 1)[at]).back] / UNIT + r * np.log(r) >= self.by.divergence
            best = self.best()
            best[at[kept]] = level - 1
            self.held["best"] = packed(best)

    def best(self) -> np.ndarray:
        return unpacked(self.held["best"]) if "best" in self.held else np.zeros(len(self.place), dtype=np.int64)

    def scores(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By document: words known, log10 probability at the root, and after the longest retained contexts."""
        best, p, known = self.best(), np.empty(len(self.place)), (self.n(0) > 0).astype(np.int64)
        for d, of_d in enumerate(self.probabilities(self.by.depth)):
            at = best == d
            p[at] = of_d[at]
            if d == 0:
                root = np.add.reduceat(np.log10(of_d), self.start)
        return np.add.reduceat(known, self.start), root, np.add.reduceat(np.log10(p), self.start)


def _make_blocks(block_bytes: int):
    """Documents as they come, block_bytes of text or one text to a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, made, size = TaskContext.get().partitionId(), 0, 0
        held: list[list] = [[], [], [], []]  # ids, words, lengths, learned

        def block() -> pa.RecordBatch:
            of, join = Distinct(np.concatenate(held[1])), np.concatenate
            arrays = {"length": join(held[2]), "learned": join(held[3]), "place": of.back, "table": of.keys}
            return _state((at << 32) + made, pa.concat_arrays(held[0]), {name: packed(a) for name, a in arrays.items()})

        for b in batches:
            texts, s = b.column("text").to_pylist(), 0
            while s < len(texts):
                e = s
                while e < len(texts) and size < block_bytes and (e == s or e - s < 1000):
                    size += len(texts[e] or "") + 1
                    e += 1
                words, length = token_hashes(texts[s:e])
                for col, x in zip(held, (b.column("doc_id").slice(s, e - s), words, length, b.column("learned").slice(s, e - s).to_numpy(zero_copy_only=False)), strict=True):
                    col.append(x)
                s = e
                if size >= block_bytes:
                    yield block()
                    made, size, held[:] = made + 1, 0, [[], [], [], []]
        if held[0]:
            yield block()
        trim()

    return run


def _state(block: int, ids: pa.Array, held: dict[str, bytes]) -> pa.RecordBatch:
    of = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
    arrays = [pa.array([block], pa.int64()), of, pa.array([list(held.items())], pa.map_(pa.string(), pa.binary()))]
    return pa.RecordBatch.from_arrays(arrays, names=["block", "ids", "held"])


def _ask(level: int, by: Parameters):
    """A block's questions of a round, cut by ranges of keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at, held in zip(b.column("block").to_pylist(), b.column("held"), strict=True):
                for kind, keys, sums in Block(dict(held.as_py()), by).ask(level):
                    if not len(keys):
                        continue
                    part = ((keys >> 32) + (1 << 31)) * by.parts >> 32
                    first = np.flatnonzero(np.diff(part, prepend=-1))
                    spans = list(zip(first, [*first[1:], len(keys)], strict=True))
                    cols = [np.full(len(spans), at), part[first], np.full(len(spans), kind), [packed(keys[s:e]) for s, e in spans], [packed(sums[s:e]) for s, e in spans]]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["block", "part", "kind", "keys", "sums"])

    return run


def _sum_keys(rows: pa.Table) -> pa.Table:
    """For one part of the key space: each key's sum over all blocks, sent back to every block that asked, doubled, plus
    1 for the first of them."""
    rows = rows.sort_by("block")
    keys = [unpacked(k) for k in rows.column("keys").to_pylist()]
    of, values = Distinct(np.concatenate(keys)), np.concatenate([unpacked(v) for v in rows.column("sums").to_pylist()])
    sums = of.total(values)
    back = 2 * sums[of.back]
    back[np.minimum.reduceat(of.order, np.flatnonzero(of.new))] += 1
    cuts = np.cumsum([0, *map(len, keys)])
    answers = pa.array([packed(back[s:e]) for s, e in zip(cuts[:-1], cuts[1:], strict=True)], pa.binary())
    none = [None] * (len(keys) - 1)
    return pa.table([rows.column("block"), rows.column("part"), rows.column("kind"), answers, pa.array([int(sums.sum()), *none], pa.int64()), pa.array([int((sums > 0).sum()), *none], pa.int64())], names=["block", "part", "kind", "sums", "total", "distinct"])


def _hear(level: int, by: Parameters):
    """A block after a round's replies; after the last one, its documents' scores."""

    def run(row: pa.Table, replies: pa.Table) -> pa.Table:
        block = Block(dict(row.column("held")[0].as_py()), by)
        of_kind = []
        for kind in (0, 1):
            mine = replies.filter(pa.compute.equal(replies.column("kind"), kind)).sort_by("part")
            of_kind.append(np.concatenate([np.zeros(0, dtype=np.int64), *map(unpacked, mine.column("sums").to_pylist())]))
        block.hear(level, *of_kind)
        ids = row.column("ids").chunk(0).flatten()
        if level < by.rounds - 1:
            return pa.Table.from_batches([_state(row.column("block")[0].as_py(), ids, block.held)])
        known, root, model = block.scores()
        learned = pa.array(unpacked(block.held["learned"]).astype(bool))
        cols = [ids, learned, pa.array(block.length), pa.array(known), pa.array(np.full(len(known), by.total)), pa.array(root), pa.array(model)]
        return pa.table(cols, names=["doc_id", "learned", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame, train: Column, *, depth: int = 3, weight: float = 60.0, divergence: float = 0.02, least: int = 2, block_bytes: int = 6 << 20) -> DataFrame:
    """One row per row of docs (doc_id, text): doc_id, learned, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the rows for which `train` is true. Its root is the add-one distribution of the training tokens'
    words, (c + 1) / (N + V + 1); base_score is a text's log10 probability under it. Contexts are the last 1 to `depth`
    words; before a text's start stand ends. Those that were seen `least` times or more are counted (the default leaves out only
    those seen once, which tell nothing that their one occurrence doesn't), with every word that followed. After
    a counted context that was seen C times, P(w) = (c(w) + weight * P(w after the context's last words but one)) / (C + weight):
    smoothed by the next shorter context, down to the root, it sums to 1. A context is retained if the Kullback-Leibler divergence
    of this distribution from the next shorter one's, over all words, is `divergence` nats or more. score is the text's log10
    probability, each word's taken after the longest retained context that it follows. Counts are exact and of whole
    texts; the tree has no bound but the corpus, and grows with it.

    How: tokens become 64-bit hashes in blocks of about block_bytes of text. In each round every block sends the distinct
    strings that end in its tokens, sorted, with their training counts, one row for each part of the key space; each part sums them and
    sends the sums back, and so each block knows the counts of the tree's nodes that it meets, and no other. Blocks are
    bucketed, so that only questions and replies are shuffled. A string is asked for
    only if its context was seen often enough, as the round before told. The divergence of a context is summed in the
    same way, from terms that only the first block holding a string adds. A block sends a key once, so a frequent word, line or
    document is no hot key; parts cut the key space evenly. Texts are read once and never shuffled; nothing but N and V comes to
    the driver. Memory of a task: one block, or one part's keys, which are those of about four blocks. Each round is written to the shared folder.

    Null texts are empty: the end alone. No training rows: N and V are 0, every probability is 1. Rows are scored one by
    one, repeated or not; ties have no meaning here. A very long text is a block of its own, made words piece by piece. Other
    columns are ignored, whatever their names. No rows give no rows.
    """
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(train, F.lit(False)).alias("learned"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // (4 * block_bytes)))
    by = Parameters(depth, weight, divergence, least, parts)
    state_row, out_row = STATE.format(kind), f"doc_id {kind}, learned boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"

    now = stored_by(rows.mapInArrow(_make_blocks(block_bytes), state_row), "lm", "block", parts, PACKED)
    for level in range(by.rounds):
        asked = now.mapInArrow(_ask(level, by), ASKED).repartition(parts, "part", "kind")
        replies = stored(asked.groupBy("part", "kind").applyInArrow(_sum_keys, REPLY), "lm", PACKED)
        reclaim(spark)  # the questions' shuffle
        if level == 0:
            total, distinct = replies.agg(F.sum("total"), F.sum("distinct")).first()
            by.total, by.distinct = total or 0, distinct or 0
        heard = now.groupBy("block").cogroup(replies.repartition(parts, "block").groupBy("block"))
        if level == by.rounds - 1:
            return heard.applyInArrow(_hear(level, by), out_row)
        before, now = now, stored_by(heard.applyInArrow(_hear(level, by), state_row), "lm", "block", parts, PACKED)
        forget(before, replies)
        reclaim(spark)
    raise AssertionError("the last round returns")
