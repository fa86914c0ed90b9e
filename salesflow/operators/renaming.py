"""Column names: standard names, block names, metric columns, casts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from salesflow.names import REPORT_ID, SALES_RENAMES, block_labels


def standardise(df: DataFrame, mapping: dict[str, str] = SALES_RENAMES) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def rename_blocks(df: DataFrame, months: list[str] | None = None,
                  metrics: list[str] | None = None, id_col: str = REPORT_ID) -> DataFrame:
    """Positional names: the id, then one label per month and metric, then ``Extra_n``."""
    width = len(df.columns)
    names = [id_col, *block_labels(months, metrics)][:width]
    names += [f"Extra_{i}" for i in range(len(names), width)]
    return df.toDF(*names)


def metric_columns(df: DataFrame, patterns: tuple[str, ...] = ("TGT", "PY")) -> list[str]:
    return [c for c in df.columns if any(p in c for p in patterns)]


def cast_columns(df: DataFrame, columns: list[str], to: str) -> DataFrame:
    """Cast in place; text that is no number becomes null instead of failing the job.

    Text with decimals is cut off on the way to a whole number, not refused.
    """
    whole = to in ("int", "integer", "bigint", "long")

    def cast(name: str) -> Column:
        c = F.col(f"`{name}`")
        if whole and isinstance(df.schema[name].dataType, StringType):
            c = c.try_cast("decimal(38,10)")
        return c.try_cast(to)

    return df.withColumns({c: cast(c) for c in columns})
