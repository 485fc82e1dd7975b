"""What the operators on embeddings share: which rows take part, and their components as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for a vector that is not null and has no null and no non-finite component."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.col(vector).isNotNull() & ~F.exists(F.col(vector).cast("array<double>"), bad)


def integers(column: pa.Array, scale: int) -> np.ndarray:
    """A row for each list of an Arrow column, of floor(scale * x) in double. scale is a power of two, so the product is
    exact. Vectors of different lengths, and integers too large for sums of products in 62 bits, are refused."""
    lengths = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths[:5].tolist()}")
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    width = int(lengths[0]) if len(lengths) else 0
    if flat.size and 4.0 * width * np.abs(flat).max() ** 2 >= 2.0**62:
        raise ValueError("components are too large: sums of their products would not fit in a long")
    return flat.reshape(len(column), width)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integer-valued rows as longs, exact: in double where no sum can pass 2**53, else in long arithmetic."""
    if not a.size or not b.size or a.shape[1] * np.abs(a).max() * np.abs(b).max() < 2.0**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def with_vectors(rows: DataFrame, key: str, vector: str, *more: Column) -> DataFrame:
    """_id (long), the further columns and _v (array of doubles) of the rows that take part; all others are not read."""
    return rows.where(usable(vector)).select(F.col(key).cast("long").alias("_id"), *more, F.col(vector).cast("array<double>").alias("_v"))
