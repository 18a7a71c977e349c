"""What the operators on vectors share: which vectors count, and their components as whole numbers in NumPy columns."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components are multiplied by this and rounded down.
SCALE = 256.0


def finite(c: str) -> Column:
    """Whether a vector is there and all its components are numbers."""
    x = F.col(c)
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False))


def whole_columns(vectors: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE * x) of vectors of one length, a row of the result for each dimension.

    A component so large that scores and squared distances could leave 64 bits is an error, as in Spark's own arithmetic."""
    most = math.isqrt((1 << 53) // max(1, dims))
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), dims)
    scaled = np.floor(flat * SCALE)
    if scaled.size and max(scaled.max(), -scaled.min()) > most:
        raise ArithmeticError(f"a vector's component times {SCALE:g} is beyond {most}: scores wouldn't fit 64 bits")
    return np.ascontiguousarray(scaled.T.astype(np.int64))


def narrow(a: np.ndarray) -> bytes:
    """Whole numbers in the fewest bytes each; the first byte says how many."""
    most = max(int(a.max(initial=0)), -1 - int(a.min(initial=0)))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << (8 * w - 1))
    return bytes([width]) + a.astype(f"<i{width}").tobytes()


def wide(b: bytes) -> np.ndarray:
    return np.frombuffer(b, dtype=f"<i{b[0]}", offset=1).astype(np.int64)
