"""Expressions for exact sums and for model errors."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from salesflow.functions.text import _col


def exact_sum(c: Column | str, scale: int = 2) -> Column:
    """Sum of a double that holds at most ``scale`` decimals.

    Adding whole minor units as bigint stays in generated code, does not depend on
    the order in which partitions arrive and fails loudly on overflow.
    """
    return F.sum(F.round(_col(c) * 10**scale).cast("bigint")) / F.lit(float(10**scale))


def exact_mean(c: Column | str, scale: int = 2) -> Column:
    c = _col(c)
    units = F.sum(F.round(c * 10**scale).cast("bigint"))
    return units / (F.count(c) * F.lit(float(10**scale)))


def log_target(c: Column | str) -> Column:
    return F.log1p(_col(c))


def inverse_log(c: Column | str) -> Column:
    return F.expm1(_col(c))


def residual(actual: Column | str, predicted: Column | str) -> Column:
    return _col(actual) - _col(predicted)


def smoothed_ape(actual: Column | str, predicted: Column | str) -> Column:
    """|y - p| / (y + 1): finite where the actual value is zero."""
    return F.abs(residual(actual, predicted) / (_col(actual) + 1))


def bias_alert(mean_residual: Column | str, tolerance: float = 1.0) -> Column:
    return F.abs(_col(mean_residual)) > tolerance


def is_null_flag(c: Column | str) -> Column:
    return _col(c).isNull().cast("int")
