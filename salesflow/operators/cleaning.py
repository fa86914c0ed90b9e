"""Cleaning: empty rows, text, metrics, outliers, defaults, and the audit of it all."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.types import DoubleType, FloatType

from salesflow.functions import normalise_text
from salesflow.operators.ordering import exact_quantile


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def drop_empty(df: DataFrame) -> DataFrame:
    """Drop rows that hold nothing at all."""
    return df.dropna(how="all")


def drop_incomplete(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.dropna(how="any", subset=subset)


def fill_nulls(df: DataFrame, value: float | str, subset: list[str] | None = None) -> DataFrame:
    """Defaults for nulls. Without ``subset`` every column of the value's type is filled."""
    return df.fillna(value, subset=subset)


def clamp_non_negative(df: DataFrame, columns: list[str]) -> DataFrame:
    """Returns count as no demand: negatives become 0, nulls stay null."""
    return df.withColumns({
        c: F.when(_q(c) < 0, F.lit(0).cast(df.schema[c].dataType)).otherwise(_q(c))
        for c in columns
    })


def positive_sales(df: DataFrame, value: str = "2025", described: str | None = None) -> DataFrame:
    df = df.filter(_q(value) > 0)
    return df.filter(_q(described).isNotNull()) if described else df


def _has_value(df: DataFrame) -> Column:
    """True when at least one column holds something; NaN counts as nothing."""
    filled = []
    for field in df.schema.fields:
        present = _q(field.name).isNotNull()
        if isinstance(field.dataType, (DoubleType, FloatType)):
            present = present & ~F.isnan(_q(field.name))
        filled.append(present)
    return reduce(lambda a, b: a | b, filled)


def _keep(df: DataFrame, numeric: list[str], negatives: str) -> Column:
    """Rows to keep. A required number already means the row is not empty, and a null
    comparison drops the row; plain comparisons can be pushed down to the scan."""
    if not numeric:
        return _has_value(df)
    numbers = [_q(c).try_cast("double") for c in numeric]
    valid = [n >= 0 if negatives == "drop" else n.isNotNull() for n in numbers]
    return reduce(lambda a, b: a & b, valid)


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if c in df.columns]


def clean_dataset(df: DataFrame, text: list[str] = (), numeric: list[str] = (),
                  negatives: str = "drop", observe: Observation | None = None) -> DataFrame:
    """Drop empty rows, normalise text, require every metric to be a number.

    ``negatives="drop"`` removes rows with a negative metric, ``"zero"`` clamps them.
    One filter and one projection, whatever the number of columns. With ``observe``
    the counts before and after come from the same pass as the data.
    """
    if negatives not in ("drop", "zero"):
        raise ValueError("negatives must be 'drop' or 'zero'")
    text, numeric = _present(df, list(text)), _present(df, list(numeric))
    keep = _keep(df, numeric, negatives)
    if observe is not None:
        df = df.observe(observe, F.count(F.lit(1)).alias("initial_rows"),
                        F.count_if(keep).alias("final_rows"))
    columns = {c: normalise_text(_q(c)) for c in text}
    for c in numeric:
        number = _q(c).try_cast("double")
        columns[c] = number if negatives == "drop" else F.when(number < 0, 0.0).otherwise(number)
    return df.filter(keep).withColumns(columns)


def clean_audit(df: DataFrame, numeric: list[str] = (), negatives: str = "drop") -> DataFrame:
    """Rows before, after and removed, in one aggregate over the uncleaned data."""
    keep = _keep(df, _present(df, list(numeric)), negatives)
    counts = df.agg(F.count(F.lit(1)).alias("initial_rows"), F.count_if(keep).alias("final_rows"))
    return counts.withColumn("removed_rows", F.col("initial_rows") - F.col("final_rows"))


def trim_outliers(df: DataFrame, column: str, p: float = 0.99, exact: bool = False,
                  accuracy: int = 10_000) -> DataFrame:
    """Drop values above the ``p`` quantile.

    The default quantile is a sketch of bounded size; ``exact=True`` interpolates the
    true one and costs one shuffle of the distinct values.
    """
    limit = exact_quantile(df, column, p) if exact else df.agg(
        F.percentile_approx(_q(column), F.lit(p), F.lit(accuracy)).alias("q"))
    return df.filter(_q(column) <= limit.scalar())
