"""Quality by ordinal cumulative-link regression on graded ratings."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Features are hashed into so many weights. Of the rated documents, at most SAMPLE are learned from.
WEIGHTS, SAMPLE = 1 << 18, 20_000
#: Shares of a text that are features: each is cut into so many steps.
STEPS = 12


class _Slots(dict):
    """word -> weight number. Remembers what it has met, up to a million words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        self[word] = at = zlib.crc32(word.strip(b".,;:!?\"'()[]")) % WEIGHTS
        return at


_slots = _Slots()


def features(text: str | None) -> np.ndarray:
    """The weights a whole text switches on: one for each distinct word (A-Z lowered, outer punctuation off),
    and one for the step of each share: capitals, marks, digits, repeated words and lines, and of its length. A null
    text has those of an empty one."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    words = raw.lower().split()
    kinds = set(words)
    lines = raw.split(b"\n")
    size, n = max(1, len(raw)), max(1, len(words))
    upper = len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    marks = len(raw) - len(raw.translate(None, b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
    digits = len(raw) - len(raw.translate(None, b"0123456789"))
    shares = (upper / size, marks / size, digits / size, 1 - len(kinds) / n, 1 - len(set(lines)) / len(lines), min(1.0, np.log10(n) / 6))
    slot = _slots
    steps = [zlib.crc32(b"\0share %d %d" % (i, int(np.ceil(s * STEPS)))) % WEIGHTS for i, s in enumerate(shares)]
    return np.unique(np.array([*map(slot.__getitem__, kinds), *steps], dtype=np.int32))


@dataclass(frozen=True)
class Grader:
    """P(grade > k) = logistic(w . x - threshold[k]), thresholds ascending: all grades share the weights w."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, sets: Sequence[np.ndarray]) -> np.ndarray:
        """For each text P(grade > 0), P(grade > 1), ..."""
        score = np.array([self.weights[s].sum(dtype=np.float64) for s in sets]).reshape(-1, 1)
        return 1 / (1 + np.exp(np.clip(self.thresholds - score, -60, 60)))


def fit(sets: Sequence[np.ndarray], grades: np.ndarray, levels: int, *, passes: int = 6, rate: float = 0.15, l1: float = 4.0, l2: float = 1.0) -> Grader:
    """Maximum likelihood of the cumulative-link model by follow-the-regularized-leader steps.

    The likelihood of grade g is F(t[g] - s) - F(t[g-1] - s), F logistic, s the shared score. l1 sets the weights
    of uninformative words to exactly 0. Rows are visited in an order fixed by their place. No rows: weights 0 and
    thresholds 0, so that nothing is preferred. Thresholds are kept ascending.
    """
    z, n, w = np.zeros(WEIGHTS), np.zeros(WEIGHTS), np.zeros(WEIGHTS)
    if not len(sets):
        return Grader(w.astype(np.float32), np.zeros(levels - 1))
    share = np.cumsum(np.bincount(grades, minlength=levels))[:-1] / len(grades)
    share = np.clip(share, 1e-3, 1 - 1e-3)
    t = np.maximum.accumulate(np.log(share / (1 - share)))
    nt = np.ones(levels - 1)
    rng = np.random.default_rng(11)
    for _ in range(passes):
        for i in rng.permutation(len(sets)):
            x, g = sets[i], grades[i]
            zx, nx = z[x], n[x]
            wx = np.where(np.abs(zx) <= l1, 0.0, (np.sign(zx) * l1 - zx) / ((1.0 + np.sqrt(nx)) / rate + l2))
            s = wx.sum()
            upper = 1 / (1 + np.exp(np.clip(s - t[g], -60, 60))) if g < levels - 1 else 1.0
            lower = 1 / (1 + np.exp(np.clip(s - t[g - 1], -60, 60))) if g else 0.0
            grad = 1 - upper - lower  # of the negative log likelihood, by the score
            step = (np.sqrt(nx + grad * grad) - np.sqrt(nx)) / rate
            z[x] = zx + grad - step * wx
            n[x] = nx + grad * grad
            p = max(upper - lower, 1e-12)
            for k, f, sign in ((g, upper, -1.0), (g - 1, lower, 1.0)):
                if 0 <= k < levels - 1:
                    d = sign * f * (1 - f) / p
                    nt[k] += d * d
                    t[k] -= 0.1 * d / np.sqrt(nt[k])
            t = np.maximum.accumulate(t)
    w = np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((1.0 + np.sqrt(n)) / rate + l2))
    return Grader(w.astype(np.float32), t)


def learn(docs: DataFrame, ratings: DataFrame, levels: int, sample: int = SAMPLE) -> Grader:
    """From ratings (doc_id, grade from 0 to levels - 1) of docs (doc_id, text).

    At most `sample` rated ids are used, those of least hash: the only bound on what is learned from. Their
    feature numbers, not their texts, come to the driver. Null ids, null and foreign grades are skipped. Of an id's ratings the
    least counts, and of its texts the least by code point, so that reruns agree.
    """
    chosen = ratings.where(F.col("doc_id").isNotNull() & F.col("grade").between(0, levels - 1)).groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = pa.array([features(t).tobytes() for t in b.column("text").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("grade"), x], names=["doc_id", "grade", "x"])

    kind = dict(docs.dtypes)["doc_id"]
    rated = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id")  # at most `sample` rows
    rated = rated.groupBy("doc_id", "grade").agg(F.min("text").alias("text"))
    rows = sorted(rated.select("doc_id", "grade", "text").mapInArrow(run, f"doc_id {kind}, grade int, x binary").collect(), key=lambda r: r[0])
    return fit([np.frombuffer(r[2], dtype=np.int32) for r in rows], np.array([r[1] for r in rows], dtype=np.int64), levels)


def grade(docs: DataFrame, model: Grader, *, least: int | None = None, tail: float = 0.5) -> DataFrame:
    """docs with expected_grade, p_tail (of grade `least` or better, by default the best) and selected
    (p_tail >= tail) added, in one narrow pass over whole texts.

    Null and empty texts are graded by what an empty text's features say; repeated rows are graded alike, and so are texts
    with the same features. A very long text is graded whole. Columns of docs that have the name of an
    added one are replaced. No rows give no rows.
    """
    base = docs.drop(*[c for c in ("expected_grade", "p_tail", "selected") if c in docs.columns])
    schema = T.StructType([*base.schema.fields, T.StructField("expected_grade", T.DoubleType()), T.StructField("p_tail", T.DoubleType()), T.StructField("selected", T.BooleanType())])
    at = (len(model.thresholds) if least is None else least) - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.tails([features(t) for t in b.column("text").to_pylist()])
            added = [pa.array(p.sum(axis=1)), pa.array(p[:, at]), pa.array(p[:, at] >= tail)]
            yield pa.RecordBatch.from_arrays([*b.columns, *added], names=[*b.schema.names, "expected_grade", "p_tail", "selected"])

    return base.mapInArrow(run, schema)


def ratings(labels: DataFrame) -> DataFrame:
    """Grades from the labels: 0 toxic, 1 of low quality, 2 good. Rows without either label have none."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))
