"""What the operators on embeddings share: sound vectors, and one row for each distinct one."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sound(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``id, v`` of vectors (arrays of double) that have an id and are neither null, empty, zero nor hold a null,
    NaN or infinite component."""
    v = F.col(vector).cast("array<double>")
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return (rows.where(F.col(id_col).isNotNull() & F.col(vector).isNotNull())
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
            .where((F.size("v") > 0) & F.forall("v", finite) & F.exists("v", lambda x: x != 0)))


def matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), float).reshape(len(column), -1)


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one. Scaled by the largest component first, so that no square over- or underflows."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
