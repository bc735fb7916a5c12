"""Vectors in columns: which rows count, and columns as matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def finite(vector: Column) -> Column:
    """Vectors that are there and hold numbers only: no null, no NaN, no infinity."""
    c = lambda x: x.cast("double")
    odd = lambda x: x.isNull() | F.isnan(c(x)) | (F.abs(c(x)) == F.lit(float("inf")))
    return vector.isNotNull() & ~F.exists(vector, odd)


def vector_rows(df: DataFrame, vector: str, *columns: Column) -> DataFrame:
    """``columns`` and ``_v`` (array of doubles) of the rows whose vector counts."""
    return df.filter(finite(F.col(vector))).select(*columns, F.col(vector).cast("array<double>").alias("_v"))


def matrix(column: pa.Array, width: int = 0) -> np.ndarray:
    """Vectors as rows of a matrix of at least ``width`` columns.  Shorter ones are filled up with zeros."""
    sizes = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = max(width, int(sizes.max(initial=0)))
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    out = np.zeros((len(sizes), width))
    out[np.arange(width) < sizes[:, None]] = flat
    return out
