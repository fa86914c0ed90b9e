"""Joins that look before they broadcast and give one answer whatever the sizes."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.types import (DataType, DecimalType, FractionalType, IntegralType, StringType)

from salesflow.session import plan_bytes, stage


def broadcast_limit(df: DataFrame) -> int:
    """The session's own broadcast threshold in bytes, 0 where broadcasts are off."""
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").strip().lower()
    units = {"kb": 1 << 10, "mb": 1 << 20, "gb": 1 << 30, "k": 1 << 10, "m": 1 << 20,
             "g": 1 << 30, "b": 1}
    for unit, factor in units.items():
        if text.endswith(unit):
            return max(int(text[:-len(unit)]) * factor, 0)
    return max(int(text), 0)


def common_type(types: list[DataType]) -> DataType | str:
    """The type in which keys of these types meet.

    Integers meet as bigint, integers and decimals as a decimal with room for both, other
    numbers as double, a text and anything else as text. Texts of different collations, and
    types without a common one, are refused.
    """
    if all(t == types[0] for t in types):
        return types[0]
    if any(isinstance(t, StringType) for t in types):
        texts = {t for t in types if isinstance(t, StringType)}
        if len(texts) > 1:
            raise ValueError("join keys have different collations")
        return texts.pop()
    if all(isinstance(t, IntegralType) for t in types):
        return "bigint"
    if all(isinstance(t, (IntegralType, DecimalType)) for t in types):
        return DecimalType(38, max(t.scale for t in types if isinstance(t, DecimalType)))
    if all(isinstance(t, (IntegralType, FractionalType)) for t in types):
        return "double"
    raise ValueError(f"join keys have no common type: {[t.simpleString() for t in types]}")


def same_key_types(frames: list[DataFrame], on: list[str]) -> list[DataFrame]:
    """The frames with every ``on`` column in the type common to all of them."""
    for column in on:
        types = [df.schema[column].dataType for df in frames]
        if any(t != types[0] for t in types):
            kind = common_type(types)
            frames = [df.withColumn(column, F.col(f"`{column}`").cast(kind)) for df in frames]
    return frames


def lookup_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "left",
                sized_by: list[DataFrame] | None = None, stage_as: str | None = None,
                limit: int | None = None, size: int | None = None) -> DataFrame:
    """Look up ``right`` for every row of ``left``.

    ``right`` is broadcast when its files are known to fit the session's broadcast threshold
    (Spark applies the same threshold to the same number; the relation in memory is larger than
    its files, so lower the threshold where memory is tight). Beyond it both sides are
    shuffled, and adaptive execution splits the tasks of hot keys by what they really read.
    Key columns are brought to one type first, so every way gives the same rows and types.

    ``sized_by``  frames whose summed size stands for ``right`` (a many-to-one join of
                  them has no more rows than its largest member, which the estimate of
                  the join itself does not know).
    ``stage_as``  write ``right`` first: for aggregates whose size only shows at run time.
    ``size``      measured bytes of ``right``, for a small part of larger files.
    """
    if how not in ("inner", "left"):
        raise ValueError("a lookup is an inner or a left join")
    if stage_as:
        right = stage(right, stage_as)
    sizes = [plan_bytes(d) for d in (sized_by or [right])]
    left, right = same_key_types([left, right], on)
    limit = broadcast_limit(left) if limit is None else limit
    if (None not in sizes and sum(sizes) <= limit) or 0 < (size or 0) <= limit:
        return left.join(F.broadcast(right), on, how)
    return left.join(right, on, how)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count: a lookup on them would repeat rows."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
            .filter(F.col("rows") > 1))


def join_audit(before: DataFrame, join: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row: rows before and after a join and whether it kept them. ``join`` gets the rows;
    both are counted in the one pass that runs it."""
    seen, left = Observation(), Observation()
    rows = F.count(F.lit(1)).alias("rows")
    after = join(before.observe(seen, rows)).observe(left, rows)
    after.agg(F.count(F.lit(1))).collect()
    n, m = seen.get["rows"], left.get["rows"]
    return before.sparkSession.range(1).select(
        F.lit(n).cast("bigint").alias("rows_before"), F.lit(m).cast("bigint").alias("rows_after"),
        F.lit(n == m).alias("preserved"))
