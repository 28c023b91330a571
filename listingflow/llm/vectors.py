"""Valid vectors of an embeddings table."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def all_finite(col) -> F.Column:
    """The array is there and every component is a finite number."""
    x = F.col(col) if isinstance(col, str) else col
    inf = F.lit(float("inf"))
    return F.coalesce(F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < inf)), F.lit(False))


def finite(col) -> F.Column:
    """The array is there, not empty, and every component is a finite number."""
    x = F.col(col) if isinstance(col, str) else col
    return F.coalesce(F.size(x) > 0, F.lit(False)) & all_finite(x)


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """An Arrow column of long lists as rows of ``width`` integers; missing components are 0."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) and lists.num_chunks else lists
    out = np.zeros((len(column), width), np.int64)
    if len(column):
        lengths = np.diff(lists.offsets.to_numpy())
        flat = lists.flatten().to_numpy(zero_copy_only=False)
        out[np.repeat(np.arange(len(lengths)), lengths),
            np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def blocks_of(rows: int, most: int) -> int:
    """How many blocks of at most about ``most`` rows."""
    return max(1, -(-rows // most))


def spread_copies(df: DataFrame, name: str, count) -> DataFrame:
    """Each row once for every number from 0 below ``count`` (a column or a number)."""
    n = F.lit(count) if isinstance(count, int) else count
    return df.withColumn(name, F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))))
