"""Aggregates kept as partial states by month: a new or corrected month is read alone, and merged with the others.

A state holds, for each key and month, what merges exactly: sums, counts, largest values, quantile sketches.
States are far smaller than the rows they stand for (a row for each key and month), and lie in a table of which
single months are written again (``sources.partitions``).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from salesflow.names import REPORT_ID, YTD_BLOCK
from salesflow.sources.partitions import read_partitions, write_partitions

CENTS = 100
SKETCH_SIZE = 4096


@dataclass(frozen=True)
class Partial:
    """How a measure is made from rows, and from states of it."""

    of_rows: Column
    merged: Callable[[str], Column]


def total(column: Column) -> Partial:
    return Partial(F.sum(column), F.sum)


def number(column: Column) -> Partial:
    return Partial(F.count(column), F.sum)


def largest(column: Column) -> Partial:
    return Partial(F.max(column), F.max)


def sketch(column: Column, size: int = SKETCH_SIZE) -> Partial:
    """A KLL sketch of the values; see ``rank_error``."""
    return Partial(F.kll_sketch_agg_double(column.cast("double"), F.lit(size)),
                   lambda name: F.kll_merge_agg_double(F.col(name), F.lit(size)))


def rank_error(size: int = SKETCH_SIZE) -> float:
    """What a sketch's rank is off by at most, as a share of all rows, in 99 of 100 cases; merging does not add to it."""
    return 2.296 / size ** 0.9021


def write_states(rows: DataFrame, path: str, keys: list[str], by: str, measures: dict[str, Partial],
                 emptied: list[object] = ()) -> None:
    """Replace the states of the values of ``by`` (a month) that occur in ``rows``; ``emptied`` are months without rows now."""
    states = rows.groupBy(*[f"`{k}`" for k in keys], f"`{by}`").agg(*[p.of_rows.alias(name) for name, p in measures.items()])
    write_partitions(states, path, by, emptied)


def merge_states(states: DataFrame, keys: list[str], measures: dict[str, Partial]) -> DataFrame:
    """One row for each key over all states given."""
    merged = [p.merged(name).alias(name) for name, p in measures.items()]
    return states.groupBy(*[f"`{k}`" for k in keys]).agg(*merged) if keys else states.agg(*merged)


# --- features per client ----------------------------------------------------

def _cents(column: str) -> Column:
    return F.round(F.col(f"`{column}`") * CENTS).cast("bigint")


def client_measures() -> dict[str, Partial]:
    return {"gasto": total(_cents("2025")), "gastos": number(F.col("`2025`")), "cantidad": total(F.col("CANTIDAD")),
            "cantidades": number(F.col("CANTIDAD")), "compras": number(F.col("Producto")), "ultimo": largest(F.col("`MES NUM`"))}


CLIENT = "Nombre Cliente"


def update_client_features(sales: DataFrame, path: str, by: str = "MES", emptied: list[object] = ()) -> None:
    """Store the states of the months in ``sales`` anew. Rows without a client belong to nobody and are left out."""
    write_states(sales.where(F.col(f"`{CLIENT}`").isNotNull()), path, [CLIENT], by, client_measures(), emptied)


def stored_client_features(spark: SparkSession, path: str, months: list[object] | None = None, by: str = "MES") -> DataFrame:
    """``customer_features`` of all stored months, or of some, which alone are read then."""
    states = read_partitions(spark, path)
    if months is not None:
        states = states.where(F.col(f"`{by}`").isin(months))
    merged = merge_states(states, [CLIENT], client_measures())
    return merged.select(
        CLIENT, (F.col("gasto") / CENTS).alias("Gasto_Total"), F.col("cantidad").alias("Cantidad_Total"),
        F.try_divide(F.col("gasto").cast("double"), F.col("gastos") * CENTS).alias("Gasto_Promedio"),
        F.try_divide("cantidad", "cantidades").alias("Cantidad_Promedio"),
        F.col("compras").alias("Frecuencia_Compra"), F.col("ultimo").alias("Ultimo_Mes"))


# --- annual totals of reports -----------------------------------------------

REPORT_KEYS = [REPORT_ID, "Nivel"]
REPORT_SUMS = {"Venta": "Venta_Total_Anual", "TGT": "Target_Total_Anual", "PY24": "PY24_Total_Anual"}


def report_measures() -> dict[str, Partial]:
    sums = {name: total(F.col(column)) for column, name in REPORT_SUMS.items()}
    return {**sums, "pct": total(F.col("pct")), "pcts": number(F.col("pct"))}


def update_annual_totals(report: DataFrame, path: str, by: str = "Mes") -> None:
    """Store the states of the report months in ``report`` anew; the running year-to-date block is left out."""
    write_states(report.where(F.col(by) != YTD_BLOCK), path, REPORT_KEYS, by, report_measures())


def stored_annual_totals(spark: SparkSession, path: str) -> DataFrame:
    """``annual_totals`` of all stored months."""
    merged = merge_states(read_partitions(spark, path), REPORT_KEYS, report_measures())
    return merged.select(*REPORT_KEYS, *REPORT_SUMS.values(), F.try_divide("pct", "pcts").alias("pct_Promedio"))


# --- quantiles of any range of months ---------------------------------------

def update_sketches(rows: DataFrame, path: str, column: str, by: str, size: int = SKETCH_SIZE) -> None:
    """Store a sketch of ``column`` (nulls and NaN left out) and its count for each month in ``rows``."""
    value = F.col(f"`{column}`").cast("double")
    known = rows.where(value.isNotNull() & ~F.isnan(value))
    write_states(known, path, [], by, {"sketch": sketch(value, size), "n": number(value)})


def stored_quantile(spark: SparkSession, path: str, p: float, by: str, months: list[object] | None = None,
                    size: int = SKETCH_SIZE) -> float | None:
    """The ``p`` quantile of the stored months, or of some of them: off by ``rank_error`` in rank. Reads sketches only."""
    if not 0 <= p <= 1:
        raise ValueError("p must lie between 0 and 1")
    states = read_partitions(spark, path)
    if months is not None:
        states = states.where(F.col(f"`{by}`").isin(months))
    merged = sketch(F.lit(0), size).merged("sketch")
    row = states.agg(F.sum("n").alias("n"), merged.alias("sketch")).where("n > 0").select(
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("q")).first()
    return None if row is None else row["q"]


def trim_by_sketches(df: DataFrame, path: str, column: str, by: str, p: float = 0.99) -> DataFrame:
    """``trim_outliers`` with the quantile of the stored sketches: ``df`` itself is read once."""
    limit = stored_quantile(df.sparkSession, path, p, by)
    return df.where("false") if limit is None else df.where(F.col(f"`{column}`") <= limit)
