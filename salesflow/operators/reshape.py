"""Wide monthly reports to long tables and back."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, functions as F

from salesflow.names import (LEVEL_FAMILY, LEVEL_PRODUCT, MONTH_NAMES, REPORT_ID, REPORT_METRICS,
                             YTD_BLOCK, month_headers)


def _q(name: str):
    return F.col(f"`{name}`")


def unpivot_months(df: DataFrame, ids: list[str], target: str, prior: str,
                   month: str = "Mes_Corto",
                   headers: list[tuple[str, str, str]] | None = None) -> DataFrame:
    """Twelve (target, prior year) column pairs -> one row per month. Nulls are kept."""
    headers = month_headers() if headers is None else headers
    rows = F.array(*[
        F.struct(F.lit(code).alias(month), _q(t).try_cast("double").alias(target),
                 _q(p).try_cast("double").alias(prior))
        for code, t, p in headers])
    return df.select(*[_q(c) for c in ids], F.inline(rows))


def unpivot_all(df: DataFrame, id_col: str = REPORT_ID, label: str = "Columna",
                value: str = "Valor") -> DataFrame:
    """Every column but the id -> (id, label, value), nulls kept."""
    return df.unpivot([id_col], [c for c in df.columns if c != id_col], label, value)


def split_label(df: DataFrame, metrics: list[str] = REPORT_METRICS, label: str = "Columna",
                keep_unmatched: bool = False) -> DataFrame:
    """``{month}_{metric}`` -> Mes and Metrica. Spare columns match no metric and are
    dropped unless asked for, since they would come back as a metric without a name."""
    pattern = f"^(.*)_({'|'.join(re.escape(m) for m in metrics)})$"
    df = df.withColumns({"Mes": F.regexp_extract(label, pattern, 1),
                         "Metrica": F.regexp_extract(label, pattern, 2)}).drop(label)
    return df if keep_unmatched else df.filter(F.col("Metrica") != "")


def pivot_metrics(df: DataFrame, metrics: list[str] = REPORT_METRICS, id_col: str = REPORT_ID,
                  value: str = "Valor") -> DataFrame:
    """Metric rows -> metric columns. The metric names are given, so no job looks for them;
    of several values for one cell the largest is kept, whatever the row order."""
    return df.groupBy(id_col, "Mes").pivot("Metrica", metrics).agg(F.max(value))


def type_metrics(df: DataFrame, metrics: list[str] = REPORT_METRICS) -> DataFrame:
    """Metrics as numbers, 0.0 where there is none; months trimmed and upper case."""
    numbers = {m: F.coalesce(_q(m).try_cast("double"), F.lit(0.0)) for m in metrics}
    return df.withColumns({**numbers, "Mes": F.upper(F.trim("Mes"))})


def reshape_report(df: DataFrame, level: str, metrics: list[str] = REPORT_METRICS,
                   months: list[str] | None = None, id_col: str = REPORT_ID) -> DataFrame:
    """Block report -> one typed row per id and month, tagged with its level.

    The block names are known when the plan is built, so each record yields one row per
    month with all its metrics; only those (not one row per cell) are grouped.
    """
    months = [*MONTH_NAMES, YTD_BLOCK] if months is None else months
    present = set(df.columns)
    blocks = []
    for m in months:
        cells = [f"{m}_{k}" for k in metrics]
        if any(c in present for c in cells):
            blocks.append(F.struct(F.lit(m).alias("Mes"), *[
                (_q(c) if c in present else F.lit(None)).try_cast("double").alias(k)
                for c, k in zip(cells, metrics)]))
    header = LEVEL_PRODUCT  # a repeated header row starts with this word
    long = df.filter(F.col(id_col) != header).select(id_col, F.inline(F.array(*blocks)))
    wide = long.groupBy(id_col, "Mes").agg(*[F.max(k).alias(k) for k in metrics])
    return type_metrics(wide, metrics).withColumn("Nivel", F.lit(level))


def union_levels(family: DataFrame, product: DataFrame) -> DataFrame:
    """Both levels in one table; a column only one of them has is null in the other."""
    return family.unionByName(product, allowMissingColumns=True)


def reshape_both(family: DataFrame, product: DataFrame) -> DataFrame:
    return union_levels(reshape_report(family, LEVEL_FAMILY),
                        reshape_report(product, LEVEL_PRODUCT))
