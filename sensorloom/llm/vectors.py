"""What the operators on vectors share: which rows take part, and equal lengths."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: str) -> Column:
    """Neither null nor with a component that is null, NaN or infinite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & ~odd, F.lit(False))


def width(rows: DataFrame, vector: str, multiple: int = 1) -> int:
    """Number of components of the longest vector, rounded up to a multiple; at least one multiple."""
    longest = rows.agg(F.max(F.size(vector))).first()[0] or 1
    return -(-max(longest, 1) // multiple) * multiple


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Rows of a list column as doubles, shorter ones with zeros behind."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if (lengths == size).all():
        return values.reshape(len(column), size)
    out = np.zeros((len(column), size))
    out[np.arange(size) < lengths[:, None]] = values
    return out
