"""Language identification with hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

#: Dimensions of the vectors, letters in an n-gram, about how many characters, and how many distinct n-grams, are counted at a time.
DIMENSIONS, GRAM, CHUNK, STEP = 512, 3, 500_000, 1 << 14
UNDETERMINED = "und"


@cache
def _is_letter() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def letter_vectors(codes: np.ndarray, dims: int = DIMENSIONS) -> np.ndarray:
    """A random vector of +1 and -1 for each code point: the same on every machine, from splitmix64."""
    words = np.uint64(1) + np.arange(dims // 64, dtype=np.uint64)
    with np.errstate(over="ignore"):
        z = codes.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + words * np.uint64(0xD1B54A32D192ED03)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(31)
    bits = np.unpackbits(z.view(np.uint8).reshape(len(codes), -1), axis=1)[:, :dims]
    return (bits.astype(np.int8) * 2 - 1).astype(np.int8)


def gram_vectors(grams: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Rows of letter numbers -> their letters' vectors, each rotated by its distance from the end, multiplied."""
    n = grams.shape[1]
    out = vectors[grams[:, n - 1]]
    for back in range(1, n):
        out = out * np.roll(vectors, back, axis=1)[grams[:, n - 1 - back]]
    return out


def document_vectors(texts: Sequence[str | None], dims: int = DIMENSIONS) -> tuple[np.ndarray, np.ndarray]:
    """The bundles (sums) of each text's n-gram vectors, and whether it has a letter.

    Case is folded; every run of other characters is one space, and one stands at either end. A whole
    text is counted, however long: a text of more than CHUNK characters is read in pieces that overlap by an n-gram less a letter, at
    any character, so texts without spaces take no more memory.
    """
    out, some = np.zeros((len(texts), dims), dtype=np.float32), np.zeros(len(texts), dtype=bool)
    at = 0
    long = [i for i, t in enumerate(texts) if t and len(t) > CHUNK]
    if long:
        short = [None if t and len(t) > CHUNK else t for t in texts]
        out, some = document_vectors(short, dims)
        for i in long:
            out[i], some[i] = _long_vector(texts[i], dims)
        return out, some
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end] or "") <= CHUNK):
            size += len(texts[end] or "")
            end += 1
        _bundle([t or "" for t in texts[at:end]], out[at:end], some[at:end], dims)
        at = end
    return out, some


def _codes(text: str) -> np.ndarray:
    """A text's letters as they are, everything else as a space."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return np.where(_is_letter()[codes], codes, 32)


def _long_vector(text: str, dims: int) -> tuple[np.ndarray, bool]:
    """As of a text in one piece. Case is folded in the whole, since it may depend on what stands beside a letter; each piece goes on from
    the last letters and spaces of the one before, so any character can be the last of a piece."""
    low, total, some = text.lower(), np.zeros((1, dims), dtype=np.float32), False
    tail = np.array([32], dtype=np.uint32)
    for at in range(0, len(low), CHUNK):
        codes = np.concatenate([tail, _codes(low[at : at + CHUNK])])
        codes = codes[np.concatenate([[True], (codes[1:] != 32) | (codes[:-1] != 32)])]
        some = some or bool((codes != 32).any())
        _count(codes, np.zeros(len(codes), dtype=np.int64), total, dims)
        tail = codes[1 - GRAM :]
    if tail[-1] != 32:
        codes = np.concatenate([tail, np.array([32], dtype=np.uint32)])
        _count(codes, np.zeros(len(codes), dtype=np.int64), total, dims)
    return total[0], some


def _bundle(texts: list[str], out: np.ndarray, some: np.ndarray, dims: int) -> None:
    low = [t.lower() for t in texts]
    codes = _codes("".join(f" {t} " for t in low))
    of = np.repeat(np.arange(len(texts)), [len(t) + 2 for t in low])
    letter = codes != 32
    keep = letter.copy()
    keep[1:] |= letter[:-1] | (of[1:] != of[:-1])
    keep[:1] = True
    some |= np.bincount(of[letter], minlength=len(texts)) > 0
    _count(codes[keep], of[keep], out, dims)


def _count(codes: np.ndarray, of: np.ndarray, out: np.ndarray, dims: int) -> None:
    """Add to each text's vector (rows of out; of: the text of each letter or space) those of its n-grams: STEP distinct ones at a time,
    however many there are, as in scripts with thousands of letters."""
    texts = len(out)
    seen = np.zeros(0x110000, dtype=np.int64)
    seen[codes] = 1
    symbols = np.flatnonzero(seen)
    seen[symbols] = np.arange(len(symbols))
    s, k = seen[codes], len(symbols)
    n = len(s) - GRAM + 1
    if n <= 0:
        return
    key = np.zeros(n, dtype=np.int64)
    for j in range(GRAM):
        key = key * k + s[j : j + n]
    inside = of[:n] == of[GRAM - 1 :]
    key, doc = key[inside], of[:n][inside]
    if k**GRAM <= 1 << 23:
        found = np.zeros(k**GRAM, dtype=np.int32)
        found[key] = 1
        grams = np.flatnonzero(found)
        found[grams] = np.arange(len(grams), dtype=np.int32)
        key = found[key]
    else:
        grams, key = np.unique(key, return_inverse=True)
    vectors = letter_vectors(symbols, dims)
    step = max(1, min(STEP, (1 << 22) // max(1, texts)))  # bounds the matrices of counts and of n-grams
    order = None if len(grams) <= step else np.argsort(key, kind="stable")
    for a in range(0, len(grams), step):
        g = grams[a : a + step]
        if order is None:
            ks, ds = key, doc
        else:
            lo, hi = np.searchsorted(key, [a, a + len(g)], sorter=order)
            ks, ds = key[order[lo:hi]] - a, doc[order[lo:hi]]
        counts = np.bincount(ds * len(g) + ks, minlength=texts * len(g)).reshape(texts, len(g)).astype(np.float32)
        parts = np.stack([g // k ** (GRAM - 1 - j) % k for j in range(GRAM)], axis=1)
        out += counts @ gram_vectors(parts, vectors).astype(np.float32)


@dataclass(frozen=True)
class Profiles:
    """A prototype for each language: a unit vector. Its size doesn't depend on the corpus."""

    languages: tuple[str, ...]
    prototypes: np.ndarray

    def predict(self, texts: Sequence[str | None]) -> tuple[list[str], np.ndarray]:
        v, some = document_vectors(texts, self.prototypes.shape[1] if self.languages else DIMENSIONS)
        if not self.languages:
            return [UNDETERMINED] * len(texts), np.zeros(len(texts))
        norm = np.maximum(np.sqrt((v.astype(np.float64) ** 2).sum(axis=1)), 1e-12)
        cos = (v @ self.prototypes.T.astype(np.float32)) / norm[:, None]
        best = cos.argmax(axis=1)
        score = np.where(some, np.clip(cos[np.arange(len(texts)), best], 0.0, 1.0), 0.0)
        return [self.languages[b] if s else UNDETERMINED for b, s in zip(best, some, strict=True)], score.astype(np.float64)


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Prototypes from every row of docs with a language and a letter.

    A document adds its vector at unit length, rounded to thousandths, so that sums don't depend on the
    order of the rows. Each task sums by language before the shuffle; languages x dimensions sums come
    to the driver. Rows with a null language teach nothing; no such rows give no languages.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in slices(batches):
            v, some = document_vectors(b.column(0).to_pylist())
            norm = np.sqrt((v.astype(np.float64) ** 2).sum(axis=1))
            rounded = np.rint(v / np.maximum(norm, 1e-12)[:, None] * 1000).astype(np.int64)
            names = np.array(b.column(1).to_pylist(), dtype=object)
            for name in set(names[some]):
                total[name] = total.get(name, 0) + rounded[some & (names == name)].sum(axis=0)
        for name, v in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(v)), pa.array(range(len(v)), pa.int32()), pa.array(v)], names=["lang", "i", "v"])

    rows = docs.where(F.col(lang).isNotNull()).select(F.col(text).cast("string"), F.col(lang).cast("string")).mapInArrow(sums, "lang string, i int, v long")
    got: dict[str, np.ndarray] = {}
    for name, i, v in rows.groupBy("lang", "i").agg(F.sum("v")).collect():
        got.setdefault(name, np.zeros(DIMENSIONS))[i] = v
    names = sorted(got)
    return Profiles(tuple(names), np.array([got[n] / max(np.linalg.norm(got[n]), 1e-12) for n in names]) if names else np.zeros((0, DIMENSIONS)))


def identify(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (cosine with the nearest prototype, 0 if negative) added.

    One narrow pass over whole texts; no other column enters a prediction. Null texts and texts without
    a letter: und, 0. Ties go to the first language by code point. Columns of docs that have the name
    of an added one are replaced. No rows give no rows.
    """
    base = docs.drop(*[c for c in ("lang_pred", "score") if c in docs.columns])
    schema = T.StructType([*base.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            lang, score = profiles.predict(b.column(text).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(lang, pa.string()), pa.array(score)], names=[*b.schema.names, "lang_pred", "score"])

    return base.mapInArrow(run, schema)
