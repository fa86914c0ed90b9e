"""Which vectors of a table take part, and their components as integers and as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Larger scaled components are refused: products of two of them are added up in longs.
LARGEST = 1 << 22


def finite(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad, F.lit(False))


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is ``finite`` and as long as most of them (of equally frequent lengths the longest)."""
    rows = vectors.where(finite(F.col(column)))
    lengths = rows.groupBy(F.size(column).alias("length")).agg(F.count("*").alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("length")).first()
    return rows.where(F.size(column) == most["length"]) if most else rows


def scaled(vector: Column, scale: int) -> Column:
    """Floor of every component times ``scale``, as longs."""

    def one(x: Column) -> Column:
        product = scale * x.cast("double")
        refused = F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more"))
        return F.when(F.abs(product) < LARGEST, F.floor(product)).otherwise(refused.cast("bigint"))

    return F.transform(vector, one)


def matrix(lists: pa.Array, kind: type) -> np.ndarray:
    """A column of equally long lists as a matrix."""
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)
    return flat.reshape(len(lists), len(flat) // max(1, len(lists)))


def list_column(rows: np.ndarray) -> pa.ListArray:
    """A matrix as a column of lists."""
    n, width = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(rows.reshape(-1)))
