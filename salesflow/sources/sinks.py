"""Writers. Every one of them writes from the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame

from salesflow.sources.formats import CSV_TEXT, TIMES


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None,
                  mode: str = "overwrite") -> None:
    """Parquet, optionally in folders by column.

    Rows are rebalanced by the folder columns first: each folder gets files of the advisory
    size, a folder with a third of all rows is split over several tasks, and no task
    leaves a small file in every folder.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ";", single_file: bool = False,
              mode: str = "overwrite") -> None:
    """CSV with a header; texts may hold separators, quotes, blanks and line breaks. ``single_file`` sends every row through one task: for
    small results only."""
    if single_file:
        df = df.coalesce(1)
    df.write.mode(mode).options(**CSV_TEXT, **TIMES).option("header", True).option("sep", sep).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON lines; null fields are left out."""
    df.write.mode(mode).options(**TIMES).json(path)


def export_dataset(df: DataFrame, path: str, columns: list[str] | None = None) -> None:
    """Training table for the dashboard, written in parallel instead of through the driver."""
    write_parquet(df.select(*columns) if columns else df, path)
