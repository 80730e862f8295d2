"""Embedding helpers: usable rows and unit vectors in double precision."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Neither null nor empty, no null or non-finite component, not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(vectors) -> np.ndarray:
    """Vectors of equal length as rows of a double matrix."""
    return np.array([np.asarray(v, dtype=np.float64) for v in vectors], dtype=np.float64)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows divided by their length; scaled by the largest component first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))
