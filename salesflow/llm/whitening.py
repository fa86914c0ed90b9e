"""Whitening of embeddings with a covariance weighted by multiplicity.

Components become integers, and rows with identical integer vectors are grouped. Each distinct vector
enters the fit once, with its count (or one) as weight: exact integer sums first, then one weighted
matrix product of centred vectors in every task, added up entry by entry. What reaches the driver is the
covariance, whose size depends on the dimension alone. Every distinct vector is projected once; rows are
joined back to theirs.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from salesflow.llm.ship import ship_package
from salesflow.llm.vectors import list_column, matrix, scaled, usable
from salesflow.session import stage

ROWS = 2000  # of a matrix at once


@dataclass(frozen=True)
class Whitened:
    """``rows``: all columns of the input that take part, ``whitened`` (array of doubles, one for each
    component) and ``deviation`` (decimal). ``n``: the fit's weight; ``explained``: each component's share of the
    total variance; ``identity_error``: largest absolute entry of the whitened covariance minus the identity."""

    rows: DataFrame
    n: int
    explained: list[float]
    identity_error: float


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def _totals(distinct: DataFrame, column: str, kind: type, dimension: int) -> np.ndarray:
    """Weighted sums of a column of vectors, last the weights' own; integers are exact."""
    name = "bigint" if kind is np.int64 else "double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(dimension + 1, kind)
        for part in _chunks(batches):
            weights = part.column("weight").to_numpy().astype(kind)
            total[:-1] += weights @ matrix(part.column(column), kind)
            total[-1] += weights.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dimension + 1)), pa.array(total)], names=["i", "v"])

    sums = distinct.select("weight", column).mapInArrow(run, f"i bigint, v {name}").groupBy("i").agg(F.sum("v").alias("v"))
    out = np.zeros(dimension + 1, kind)
    for row in sums.collect():
        out[row["i"]] = row["v"]
    return out


def _covariance(distinct: DataFrame, column: str, kind: type, sums: np.ndarray, n: int) -> np.ndarray:
    """Weighted covariance (divisor ``n``) of a column of vectors; centred before multiplying."""
    dimension = len(sums)
    upper = np.triu_indices(dimension)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = np.zeros((dimension, dimension))
        for part in _chunks(batches):
            own = (n * matrix(part.column(column), kind) - sums) / n  # exact until divided, if of integers
            weights = part.column("weight").to_numpy().astype(np.float64)
            product += (own * weights[:, None]).T @ own
        yield pa.RecordBatch.from_arrays([pa.array(upper[0]), pa.array(upper[1]), pa.array(product[upper])],
                                         names=["i", "j", "v"])

    parts = distinct.select("weight", column).mapInArrow(run, "i bigint, j bigint, v double")
    out = np.zeros((dimension, dimension))
    for row in parts.groupBy("i", "j").agg(F.sum("v").alias("v")).collect():
        out[row["i"], row["j"]] = out[row["j"], row["i"]] = row["v"] / n
    return out


def _deviations(gaps: np.ndarray) -> pa.Array:
    """Exact sum of squares of every row of whole numbers."""
    if not gaps.size or float(np.abs(gaps).max()) ** 2 * gaps.shape[1] < 2.0 ** 62:
        return pa.array((gaps * gaps).sum(axis=1)).cast(pa.decimal128(38, 0))
    wide = gaps.astype(object)
    return pa.array([Decimal(int(v)) for v in (wide * wide).sum(axis=1)], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, column: str = "embedding", scale: int = 64, offset: int = 0,
           weighting: str = "rows", components: int = 32) -> Whitened:
    """Whitened vectors of the rows of ``vectors``.

    Each component ``c`` becomes ``floor(scale * c) + offset``. With ``weighting="rows"`` every row counts in the
    fit, with ``"distinct"`` every distinct vector once. Components are unit eigenvectors of the covariance
    by falling eigenvalue, at most ``components`` of those whose eigenvalue is not zero but for rounding; with none
    ``whitened`` is an empty array. ``deviation`` is the sum over dimensions of ``(n * x - S) ** 2``, exact.

    Rows take no part whose vector is null, holds null or non-finite entries, or has another length than
    most. Repeated rows, null and tied ids each keep a row of their own. An empty table gives no rows.
    Columns named ``whitened`` or ``deviation`` are replaced; all others pass through.
    """
    if weighting not in ("rows", "distinct"):
        raise ValueError("weighting must be 'rows' or 'distinct'")
    ship_package(vectors.sparkSession)
    kept = [c for c in vectors.columns if c.lower() not in ("whitened", "deviation")]
    ints = F.transform(scaled(F.col(column), scale), lambda x: x + offset)
    rows = stage(usable(vectors, column).select(F.struct(*kept).alias("row"), ints.alias("x")).withColumn(
        "key", F.xxhash64("x")), "integer-vectors")
    weight = F.count("*") if weighting == "rows" else F.max(F.lit(1).cast("bigint"))
    distinct = stage(rows.groupBy("key", "x").agg(weight.alias("weight")), "distinct-vectors")
    first = distinct.select(F.size("x").alias("d")).first()
    if first is None:
        out = rows.select("row.*", F.array().cast("array<double>").alias("whitened"),
                          F.lit(0).cast("decimal(38,0)").alias("deviation"))
        return Whitened(out, 0, [], 0.0)
    totals = _totals(distinct, "x", np.int64, first["d"])
    sums, n = totals[:-1], int(totals[-1])
    values, axes = np.linalg.eigh(_covariance(distinct, "x", np.int64, sums, n))
    values, axes = values[::-1], axes[:, ::-1]
    rank = int((values > max(values[0], 0.0) * len(values) * np.finfo(float).eps).sum()) if len(values) else 0
    kept_axes = min(rank, components)
    explained = (values[:kept_axes] / values.clip(min=0).sum()).tolist() if kept_axes else []
    scaling = axes[:, :kept_axes] / np.sqrt(values[:kept_axes])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _chunks(batches):
            gaps = n * matrix(part.column("x"), np.int64) - sums
            yield pa.RecordBatch.from_arrays(
                [part.column("key"), part.column("x"), part.column("weight"), list_column((gaps / n) @ scaling),
                 _deviations(gaps)], names=["key", "x", "weight", "whitened", "deviation"])

    done = stage(distinct.mapInArrow(
        project, "key bigint, x array<bigint>, weight bigint, whitened array<double>, deviation decimal(38,0)"), "whitened")
    error = 0.0
    if kept_axes:
        means = _totals(done, "whitened", np.float64, kept_axes)[:-1]
        error = float(np.abs(_covariance(done, "whitened", np.float64, means, n) - np.eye(kept_axes)).max())
    out = rows.join(done.drop("weight"), ["key", "x"]).select("row.*", "whitened", "deviation")
    return Whitened(out, n, explained, error)


def explode_components(result: Whitened) -> DataFrame:
    """One row for each row and component, numbered from 1: the input's columns, ``component``, ``n``,
    ``deviation``, ``whitened``, ``explained``, ``identity_error``."""
    own = [c for c in result.rows.columns if c not in ("whitened", "deviation")]
    shares = F.array(*[F.lit(v) for v in result.explained]).cast("array<double>")
    each = result.rows.select(*own, "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return each.select(*own, (F.col("place") + 1).alias("component"), F.lit(result.n).cast("bigint").alias("n"),
                       "deviation", "whitened", F.get(shares, F.col("place")).alias("explained"),
                       F.lit(result.identity_error).alias("identity_error"))
