"""Relational source, read in parallel ranges of a numeric column."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, column: str | None = None,
                 bounds: tuple[int, int] | None = None, partitions: int = 1,
                 user: str | None = None, password: str | None = None,
                 driver: str | None = None, fetch_size: int = 10_000) -> dict[str, str]:
    """Reader options. With a column and its bounds each task reads its own range;
    rows outside the bounds are still read, by the first and last task."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    if partitions > 1:
        if column is None or bounds is None:
            raise ValueError("a parallel read needs a column and its bounds")
        low, high = bounds
        if low >= high:
            raise ValueError("bounds must be (low, high) with low < high")
        options |= {"partitionColumn": column, "lowerBound": str(low),
                    "upperBound": str(high), "numPartitions": str(partitions)}
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            options[key] = value
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, column: str | None = None,
              bounds: tuple[int, int] | None = None, partitions: int = 1,
              **connection: str) -> DataFrame:
    options = jdbc_options(url, table, column, bounds, partitions, **connection)
    return spark.read.format("jdbc").options(**options).load()
