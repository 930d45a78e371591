"""Vectors as whole numbers: which rows count, how components become integers, and blocks of them inside tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Components are held within this bound, so that squared distances and products of 512 of them fit a long.
LARGEST = 1 << 24


def is_whole(vector: Column, dims: int | None = None) -> Column:
    """No component is null or non-finite; with ``dims``, there are exactly so many. False for null."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x.cast("double")))
    right_size = F.size(vector) == dims if dims is not None else F.lit(True)
    return F.coalesce(right_size & finite, F.lit(False))


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component, held within +-LARGEST."""
    return F.transform(
        vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * float(scale), F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")
    )


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of one length as rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def padded(column: pa.Array, width: int) -> np.ndarray:
    """Lists of any length as rows of a matrix of 32-bit integers: zeros are added, what lies beyond ``width`` is left out."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
    if len(lengths) and (lengths == width).all():
        return values.reshape(-1, width)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    places = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out = np.zeros((len(lengths), width), dtype=np.int32)
    inside = places < width
    out[rows[inside], places[inside]] = values[inside]
    return out


def exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of all rows of ``a`` with all rows of ``b`` as 64-bit integers.

    Doubles hold the sums exactly below 2^53, which leaves the work to the fast matrix product; else integers do it.
    """
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    most = float(np.abs(a).max()) * float(np.abs(b).max()) * a.shape[1]
    if most < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T
