"""Vectors as Spark columns and as numpy arrays."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T


def vector_type(vectors: DataFrame, vector_col: str) -> str:
    """``array<float>`` for single-precision vectors, else ``array<double>``."""
    kind = vectors.schema[vector_col].dataType
    single = isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType)
    return "array<float>" if single else "array<double>"


def finite(vector: Column) -> Column:
    """True for a vector with components that are all numbers; NULL, NaN and infinity are none. An empty one has none."""
    as_double = vector.cast("array<double>")
    numbers = F.forall(as_double, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return F.coalesce((F.size(as_double) > 0) & numbers, F.lit(False))


def matrix(column: pa.Array, dtype: type = np.float64) -> np.ndarray:
    """Vectors of one length as rows."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
