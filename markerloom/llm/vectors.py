"""Column expressions and array helpers for vector columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True where a vector is neither null nor holds null or non-finite components."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, width: int | None = None, dtype: type = np.float64) -> np.ndarray:
    """A list column as rows; shorter lists are filled up with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    sizes = np.diff(column.offsets.to_numpy()).astype(np.int64)
    width = width if width is not None else int(sizes.max(initial=0))
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    if n and (sizes == width).all():
        return values.reshape(n, width)
    out = np.zeros((n, width), dtype=dtype)
    row = np.repeat(np.arange(n), sizes)
    out[row, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out
