"""File-drop ingest: CSV files that appear in a folder become JSON lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from salesflow.sources.formats import CSV_TEXT, CORRUPT, TIMES

STATE, LANDED, QUARANTINE = "estado", "bien", "cuarentena"
BAD_ROW = "fila"


def ingest_drop(spark: SparkSession, source: str, target: str, schema: StructType | str,
                checkpoint: str, pattern: str = "*.csv", sep: str = ",",
                remove_source: bool = True, files_per_batch: int | None = None,
                continuous_every: str | None = None, encoding: str = "UTF-8",
                multi_line: bool = False) -> StreamingQuery:
    """Read each dropped file once and land its rows as JSON.

    The header must name the columns of ``schema`` in their order; a file with another header stops
    the query, and no source goes. Rows with a value that does not fit its type, or with too few
    or too many cells, land whole in a quarantine folder of ``target``, in the same commit as the
    good ones. See ``read_landed`` and ``read_quarantine``.

    The checkpoint remembers what was read, so a restart after a lost driver neither
    repeats nor skips a file. Sources are deleted by the run after the one that landed
    them. By default the query drains the folder and stops; with ``continuous_every``
    (for example ``"10 seconds"``) it keeps watching it. ``multi_line`` for texts with line breaks
    (such a file is then read by one task).
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    with_bad = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    reader = (spark.readStream.schema(with_bad).options(**CSV_TEXT, **TIMES)
              .option("header", True).option("sep", sep).option("encoding", encoding)
              .option("multiLine", multi_line).option("enforceSchema", False)
              .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .option("pathGlobFilter", pattern))
    if remove_source:
        reader = reader.option("cleanSource", "delete")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    state = F.when(F.col(CORRUPT).isNull(), LANDED).otherwise(QUARANTINE)
    writer = (reader.csv(source).withColumn(STATE, state).withColumnRenamed(CORRUPT, BAD_ROW)
              .writeStream.format("json").options(**TIMES)
              .partitionBy(STATE).outputMode("append")
              .option("path", target).option("checkpointLocation", checkpoint))
    if continuous_every:
        return writer.trigger(processingTime=continuous_every).start()
    return writer.trigger(availableNow=True).start()


def ingest_once(spark: SparkSession, source: str, target: str, schema: StructType | str, checkpoint: str,
                pattern: str = "*.csv", sep: str = ",", remember: str = "30 days", files_per_batch: int | None = None,
                continuous_every: str | None = None, encoding: str = "UTF-8") -> StreamingQuery:
    """``ingest_drop`` for drops that may be repeated: a file with the content of one seen within ``remember``, under
    whatever name, lands nothing.

    The stream's state keeps a hash of every file's content until it was seen ``remember`` ago by the cluster's clock (files'
    own times do not matter, so none is too late). It lies in the checkpoint and survives a restart. A file is
    one row here: it must fit a task and have no line breaks inside quotes. Its header must name the columns of ``schema`` in their
    order, else the query stops. Files without any row land nothing. Sources stay where they are.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    with_bad = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    whole = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(whole).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    files = reader.load(source).select("path", F.sha2("content", 256).alias("hash"), "content",
                                       F.current_timestamp().alias("seen"))
    fresh = files.withWatermark("seen", remember).dropDuplicatesWithinWatermark(["hash"])
    lines = fresh.select("path", F.split(F.decode("content", encoding), "\r?\n").alias("lines"))
    header = sep.join(schema.names)
    wrong = F.raise_error(F.concat(F.lit(f"the header is not {header}: "), "path"))
    rows = F.when(F.replace(F.get("lines", F.lit(0)), F.lit('"'), F.lit("")) == header,
                  F.slice("lines", F.lit(2), F.size("lines"))).when(
        F.size("lines") > 1, wrong.cast("array<string>")).otherwise(F.array().cast("array<string>"))
    options = {**CSV_TEXT, **TIMES, "sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = lines.select(F.explode(rows).alias("line")).where("line <> ''").select(
        F.from_csv("line", with_bad.toDDL(), options).alias("row")).select("row.*")
    state = F.when(F.col(CORRUPT).isNull(), LANDED).otherwise(QUARANTINE)
    writer = (parsed.withColumn(STATE, state).withColumnRenamed(CORRUPT, BAD_ROW).writeStream.format("json").options(**TIMES)
              .partitionBy(STATE).outputMode("append").option("path", target).option("checkpointLocation", checkpoint))
    if continuous_every:
        return writer.trigger(processingTime=continuous_every).start()
    return writer.trigger(availableNow=True).start()


def read_landed(spark: SparkSession, target: str, schema: StructType | str) -> DataFrame:
    """The good rows, in the columns of ``schema``."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    rows = spark.read.schema(schema).options(**TIMES).json(target)
    return rows.where(F.col(STATE) == LANDED).select(*[f"`{c}`" for c in schema.names])


def read_quarantine(spark: SparkSession, target: str) -> DataFrame:
    """The bad rows as they stood in their files."""
    rows = spark.read.schema(f"{BAD_ROW} string").json(target)
    return rows.where(F.col(STATE) == QUARANTINE).select(BAD_ROW)
