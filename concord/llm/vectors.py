"""Vectors in tasks: array columns as matrices, and the valid rows of a vector table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matrix(column, dims: int, kind=np.float64) -> np.ndarray:
    """(rows, dims) of a list column without nulls; shorter rows are filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    off = column.offsets.to_numpy().astype(np.int64)
    size = np.diff(off)
    values = column.values.to_numpy(zero_copy_only=False)[off[0]:off[-1]]
    if len(size) and (size == dims).all():
        return values.reshape(len(size), dims).astype(kind)
    out = np.zeros((len(size), dims), kind)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(values)) - np.repeat(off[:-1] - off[0], size)] = values
    return out


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def width(rows: DataFrame, vector: str) -> int:
    """Components of the longest vector (0 for no rows)."""
    return rows.agg(F.max(F.size(vector))).first()[0] or 0
