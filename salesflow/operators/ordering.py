"""Global order without a single task: positions, running totals, exact quantiles.

Rows are range-partitioned, each partition is numbered on its own, and the totals of
the partitions before it (one row per partition) are added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesflow.session import stage


def running_total(df: DataFrame, order_by: list[Column], weight: Column,
                  output: str = "running_total") -> DataFrame:
    """Running sum of ``weight`` over the whole frame in ``order_by`` order.

    The order must be total over distinct rows. The ranged rows are staged first, so
    that both uses of the partition number see the same partitions even if tasks are
    run again.
    """
    ranged = (df.repartitionByRange(*order_by)
              .withColumns({"_part": F.spark_partition_id(), "_weight": weight.cast("bigint")}))
    ranged = stage(ranged, "ranged")
    # One row per partition: a bounded table, so one window over it is safe.
    before = (ranged.groupBy("_part").agg(F.sum("_weight").alias("_sum"))
              .withColumn("_before", F.sum("_sum").over(
                  Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
              .select("_part", F.coalesce("_before", F.lit(0)).alias("_before")))
    local = Window.partitionBy("_part").orderBy(*order_by).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return (ranged.withColumn("_local", F.sum("_weight").over(local))
            .join(F.broadcast(before), "_part")
            .withColumn(output, F.col("_local") + F.col("_before"))
            .drop("_part", "_weight", "_local", "_before"))


def exact_quantile(df: DataFrame, column: str, p: float) -> DataFrame:
    """One row, one column: the interpolated ``p`` quantile of the non-null values.

    Values are counted before they are ordered, so a value that fills a third of the
    table is one row here.
    """
    if not 0 <= p <= 1:
        raise ValueError("p must lie between 0 and 1")
    counts = stage(df.select(F.col(f"`{column}`").cast("double").alias("v")).filter("v is not null")
                   .groupBy("v").agg(F.count(F.lit(1)).alias("n")), "value_counts")
    ranged = stage(counts.repartitionByRange("v").withColumn("_part", F.spark_partition_id()), "ranged")
    # One row per partition says which partitions hold the wanted ranks; only those are put in order.
    parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = ranged.groupBy("_part").agg(F.sum("n").alias("_sum")).withColumn("_upto", F.sum("_sum").over(parts))
    position = (counts.agg(F.sum("n")).scalar() - 1) * F.lit(p)
    wanted = sums.withColumn("position", position).where(
        (F.col("_upto") > F.floor("position")) & (F.col("_upto") - F.col("_sum") <= F.ceil("position")))
    local = Window.partitionBy("_part").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = ranged.join(F.broadcast(wanted), "_part").withColumn(
        "upto", F.sum("n").over(local) + F.col("_upto") - F.col("_sum"))
    bounds = ranked.agg(
        F.min(F.when(F.col("upto") > F.floor("position"), F.col("v"))).alias("low"),
        F.min(F.when(F.col("upto") > F.ceil("position"), F.col("v"))).alias("high"),
        F.max(F.col("position") - F.floor("position")).alias("fraction"))
    return bounds.select((F.col("low") + (F.col("high") - F.col("low")) * F.col("fraction"))
                         .alias("quantile"))


def category_index(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, label, index) for each category column: most frequent label first, equal
    counts in label order, nulls left out. All columns share one pass and one ordering."""
    pairs = F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("label"))
        for c in columns]))
    counts = (df.select(pairs).filter("label is not null")
              .groupBy("column", "label").agg(F.count(F.lit(1)).alias("n")))
    order = [F.col("column"), F.col("n").desc(), F.col("label")]
    ordered = running_total(counts, order, F.lit(1), "position")
    first = ordered.groupBy("column").agg(F.min("position").alias("first_position"))
    return (ordered.join(F.broadcast(first), "column")
            .select("column", "label",
                    (F.col("position") - F.col("first_position")).cast("double").alias("index")))
