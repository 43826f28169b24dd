"""Integer vectors inside Spark tasks: exact inner products and squared distances."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

LONGEST = np.iinfo(np.int64).max


def whole(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(fine(x.cast("double")), F.lit(False))), F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as longs; values beyond a long are the nearest long."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))


def matrix(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """A list column as rows of a matrix; shorter rows are filled with zeros, which add nothing to an inner product."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(int(sizes.max(initial=0)), width or 0)
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width), flat.dtype)
    out[np.arange(width) < sizes[:, None]] = flat
    return out


def largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def product_kind(x: np.ndarray, y: np.ndarray) -> type:
    """The fastest number type in which all inner products of rows of x and y are exact."""
    most = largest(x) * largest(y) * max(1, x.shape[1])
    return np.float32 if most < 1 << 24 else np.float64 if most < 1 << 53 else object


def distance_kind(x: np.ndarray, y: np.ndarray) -> type:
    return np.int64 if (largest(x) + largest(y)) ** 2 * max(1, x.shape[1]) < LONGEST else object


def as_longs(values: np.ndarray) -> np.ndarray:
    """Numbers as 64-bit integers; those beyond are the nearest one."""
    if values.dtype == object:
        return np.array([max(-int(LONGEST), min(int(LONGEST), int(v))) for v in values], np.int64)
    return values.astype(np.int64)
