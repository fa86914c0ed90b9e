"""Tables of which single partitions (a month) are written again, all at once or not at all.

A write puts its rows into a folder of its own, ``version=<id>/<by>=<value>``; the table's state says which
version holds which value. Spark's own dynamic overwrite moves folder by folder when it commits, so
a job killed then leaves some values new, some old and some gone; here one rename switches them all.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from salesflow.sources.pointers import StateChanged, current_state, folder_names, publish_state, remove_folder
from salesflow.sources.sinks import write_parquet

VERSION = "version"


def _folder(by: str, value: object) -> str:
    """How Spark names the folder of a value (of plain values: numbers and words)."""
    return f"{by}=__HIVE_DEFAULT_PARTITION__" if value is None else f"{by}={value}"


def _widths(schema: StructType) -> dict[str, str]:
    return {f.name: f.dataType.simpleString() for f in schema}


def write_partitions(df: DataFrame, path: str, by: str, emptied: Iterable[object] = (), attempts: int = 5) -> list[str]:
    """Replace the values of column ``by`` that occur in ``df``, and return their folders' names; other values are
    neither read nor written. ``emptied`` are values to be replaced by nothing where ``df`` has no row of them.

    Readers see the old rows of all these values until the last step, then the new ones. Of two jobs that
    write at once the later one builds on the other's state; what both have written is the later one's.
    Columns and types must stay those of the first write.
    """
    spark = df.sparkSession
    if VERSION in df.columns:
        raise ValueError(f"a column must not be named {VERSION}")
    version = uuid.uuid4().hex
    write_parquet(df, f"{path}/{VERSION}={version}", [by])
    written = [name for name in folder_names(spark, f"{path}/{VERSION}={version}") if name.startswith(f"{by}=")]
    gone = {_folder(by, value) for value in emptied} - set(written)
    for attempt in range(1, attempts + 1):
        number, state = current_state(spark, path)
        schema = state.get("schema") or df.schema.jsonValue()
        if state and (state["by"] != by or _widths(StructType.fromJson(schema)) != _widths(df.schema)):
            raise ValueError(f"{path} has other columns")
        held = {k: v for k, v in state.get("folders", {}).items() if k not in gone}
        try:
            publish_state(spark, path, {"by": by, "schema": schema, "folders": {**held, **dict.fromkeys(written, version)}}, number)
            return written
        except StateChanged:
            if attempt == attempts:
                raise
    raise ValueError("attempts must be at least 1")


def read_partitions(spark: SparkSession, path: str) -> DataFrame:
    """The table's current rows. A filter on its partition column reads only the folders it asks for."""
    _, state = current_state(spark, path)
    if not state:
        raise FileNotFoundError(f"no table at {path}")
    schema = StructType.fromJson(state["schema"])
    paths = [f"{path}/{VERSION}={version}/{folder}" for folder, version in sorted(state["folders"].items())]
    if not paths:
        return spark.createDataFrame([], schema)
    table = spark.read.schema(StructType([*schema.fields]).add(VERSION, "string")).option("basePath", path).parquet(*paths)
    return table.select(*[f"`{c}`" for c in schema.names])


def drop_unused(spark: SparkSession, path: str) -> list[str]:
    """Remove what the current state does not refer to: replaced values and what killed jobs have left. Not
    while a job still writes, or reads an older state."""
    _, state = current_state(spark, path)
    used = {(version, folder) for folder, version in state.get("folders", {}).items()}
    dropped = []
    for name in folder_names(spark, path):
        if not name.startswith(f"{VERSION}="):
            continue
        version = name.removeprefix(f"{VERSION}=")
        kept = {folder for v, folder in used if v == version}
        parts = folder_names(spark, f"{path}/{name}") if kept else []
        unused = [f"{name}/{p}" for p in parts if "=" in p and p not in kept] if kept else [name]
        for folder in unused:
            remove_folder(spark, f"{path}/{folder}")
        dropped += unused
    return dropped
