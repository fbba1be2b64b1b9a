"""Vector columns: which rows count, and how a batch of them becomes one array."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """True where the vector is there and each component is a finite number."""
    inside = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(F.forall(vector, inside), F.lit(False))


def usual_length(rows: DataFrame, vector: str) -> int | None:
    """The length that most vectors have; the longer one of equally frequent ones."""
    found = rows.groupBy(F.size(vector).alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    return found["d"] if found else None


def matrix(column: pa.Array, length: int) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), dtype=np.float64).reshape(len(flat), length)
