"""File readers: CSV, headerless block reports, JSON lines, Parquet."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from salesflow.names import REPORT_ID
from salesflow.operators.renaming import rename_blocks
from salesflow.sources.formats import CSV_TEXT, TIMES


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None,
             sep: str = ",", encoding: str = "UTF-8", infer: bool = False,
             multi_line: bool = False) -> DataFrame:
    """CSV with a header row. Give a schema at scale: inference reads the data twice. ``multi_line``
    for texts with line breaks; a file is then read by one task."""
    reader = (spark.read.options(**CSV_TEXT, **TIMES).option("header", True).option("sep", sep)
              .option("encoding", encoding).option("multiLine", multi_line))
    if schema is not None:
        # Columns follow the schema order, so a reordered file must fail, not shift.
        return reader.schema(schema).option("enforceSchema", False).csv(path)
    return reader.option("inferSchema", infer).csv(path)


def read_block_report(spark: SparkSession, path: str, sep: str = ";",
                      months: list[str] | None = None, metrics: list[str] | None = None,
                      keep_null_ids: bool = False, encoding: str = "UTF-8") -> DataFrame:
    """Headerless block report: header rows go by value, columns get block names.

    The first cell of the file names the header; every row starting with it is a
    header. Rows without a first cell go too unless ``keep_null_ids`` is set.
    """
    raw = (spark.read.options(**CSV_TEXT).option("header", False).option("sep", sep)
           .option("encoding", encoding).csv(path))
    first = raw.columns[0]
    top = raw.select(first).first()
    header = top[0] if top else None
    if header is not None:
        raw = raw.filter(~F.col(first).eqNullSafe(F.lit(header)))
    if not keep_null_ids:
        raw = raw.filter(F.col(first).isNotNull())
    return rename_blocks(raw, months=months, metrics=metrics, id_col=REPORT_ID)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              pattern: str | None = None) -> DataFrame:
    """JSON lines from a file or folder; ``pattern`` keeps matching file names."""
    reader = spark.read.options(**TIMES)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
