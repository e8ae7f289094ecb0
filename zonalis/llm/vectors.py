"""Checked vector columns for the embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str) -> Column:
    """Whether an array column is there, not empty, and holds neither null nor a non-finite number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def matrix(column: pa.ChunkedArray | pa.Array, dtype: str) -> np.ndarray:
    """Rows of a list column of equal lengths."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


def dealt(rows: DataFrame, by: str, least: int) -> tuple[DataFrame, int]:
    """rows with `_part`, a digest of column `by` into about count / least parts, and how many."""
    parts = max(1, -(-rows.count() // least))
    return rows.withColumn("_part", F.pmod(F.xxhash64(by), F.lit(parts)).cast("int")), parts
