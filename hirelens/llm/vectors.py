"""Vector columns: which rows take part, and vectors as arrays in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(col: Column) -> Column:
    """Not null, without null or non-finite components."""
    whole = F.forall(col, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(col.isNotNull() & whole, F.lit(False))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of numbers as the rows of a double matrix; shorter ones end in zeros."""
    size = np.asarray(column.value_lengths()).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(size) and (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width))
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out
