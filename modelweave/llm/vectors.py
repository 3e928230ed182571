"""Integer vectors for the two clustering operators: which rows count, how blocks of them are kept."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LARGEST = 2**27  # components beyond this would give squared distances that no long holds
BLOCK = 4096  # vectors in a row of a block table


def finite(v: Column, scale: int) -> Column:
    """Whether a vector of doubles has components only, all finite and, scaled, at most ``LARGEST``."""
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST / scale))
    return v.isNotNull() & F.coalesce(good, F.lit(False))


def integers(column: pa.Array, rows: int, scale: int) -> np.ndarray:
    """floor(scale * x) of a column of equally long vectors of doubles."""
    values = np.asarray(column.flatten(), dtype=np.float64).reshape(rows, -1)
    return np.floor(values * scale).astype(np.int64)


def narrow(x: np.ndarray) -> tuple[bytes, str]:
    """The values in the narrowest integer type that holds them, and that type's name."""
    top = int(np.abs(x).max(initial=0))
    kind = next(t for t, most in (("i1", 127), ("<i2", 32767), ("<i4", 2**31 - 1), ("<i8", 2**63 - 1)) if top <= most)
    return np.ascontiguousarray(x, dtype=kind).tobytes(), kind


def wide(raw: bytes, kind: str, *shape: int) -> np.ndarray:
    return np.frombuffer(raw, kind).astype(np.int64).reshape(shape)


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Exact squared distances of all points to all centres."""
    top = max(np.abs(points).max(initial=0), np.abs(centres).max(initial=0))
    if 4 * points.shape[1] * int(top) ** 2 < 2**53:  # every sum is exact in double precision
        p, c = points.astype(np.float64), centres.astype(np.float64)
        return ((p * p).sum(1)[:, None] - 2 * (p @ c.T) + (c * c).sum(1)).astype(np.int64)
    return np.stack([((points - c) ** 2).sum(1) for c in centres], axis=1)


def one_list(column: pa.Array) -> pa.Array:
    """A column as the single list of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column)


def summed(rows: DataFrame, keys: list[str], values: list[str]) -> list:
    """Exact sums by key, as Python integers; only for keys whose number is fixed."""
    sums = [F.sum(F.col(v).cast("decimal(38,0)")).alias(v) for v in values]
    return rows.groupBy(*keys).agg(*sums).collect()


def as_long(value: int) -> Column:
    """A literal; null if no long holds it."""
    return F.lit(value if -(2**63) <= value < 2**63 else None).cast("long")
