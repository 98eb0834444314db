"""Rows of vectors: which count, and their bytes."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def vector_rows(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``vec_id`` (long), ``vector`` (array<double>) and ``valid``: not null, not
    empty, no null or non-finite component, and not all zero."""
    v = F.col("vector")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = rows.select(F.col(id_col).cast("long").alias("vec_id"),
                      F.col(vec_col).cast("array<double>").alias("vector"))
    return own.withColumn("valid", F.coalesce(
        (F.size(v) > 0) & finite & F.exists(v, lambda x: x != 0.0), F.lit(False)))


def matrix(column: pd.Series) -> np.ndarray:
    """Rows of equal length as a float64 matrix."""
    return np.array(column.tolist(), np.float64)


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1; scaled by the largest component first, so that
    squares neither overflow nor vanish."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)
