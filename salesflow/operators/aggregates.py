"""Aggregates: customer features, annual totals, profiles, error measures."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesflow.functions import (bias_alert, exact_mean, exact_sum, is_null_flag, residual,
                                 smoothed_ape)
from salesflow.names import REPORT_ID, YTD_BLOCK


def customer_features(sales: DataFrame, client: str = "Nombre Cliente", value: str = "2025",
                      quantity: str = "CANTIDAD", product: str = "Producto",
                      month: str = "MES NUM", scale: int = 2) -> DataFrame:
    """Spend, volume, means, frequency and last month per client, in one aggregation.

    Rows without a client are left out: they belong to nobody.
    """
    value, quantity = F.col(f"`{value}`"), F.col(f"`{quantity}`")
    return (sales.filter(F.col(f"`{client}`").isNotNull()).groupBy(f"`{client}`").agg(
        exact_sum(value, scale).alias("Gasto_Total"),
        F.sum(quantity).alias("Cantidad_Total"),
        exact_mean(value, scale).alias("Gasto_Promedio"),
        F.avg(quantity).alias("Cantidad_Promedio"),
        F.count(f"`{product}`").alias("Frecuencia_Compra"),
        F.max(f"`{month}`").alias("Ultimo_Mes")))


def annual_totals(report: DataFrame, exclude: tuple[str, ...] = (YTD_BLOCK,)) -> DataFrame:
    """Yearly totals and mean percentage per product or family and level. The running
    year-to-date block is left out, it would count its months twice."""
    if exclude:
        report = report.filter(~F.col("Mes").isin(*exclude))
    return report.groupBy(REPORT_ID, "Nivel").agg(
        F.sum("Venta").alias("Venta_Total_Anual"), F.sum("TGT").alias("Target_Total_Anual"),
        F.sum("PY24").alias("PY24_Total_Anual"), F.avg("pct").alias("pct_Promedio"))


def null_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Nulls per column, one row."""
    columns = df.columns if columns is None else columns
    return df.agg(*[F.coalesce(F.sum(is_null_flag(F.col(f"`{c}`"))), F.lit(0)).alias(c)
                    for c in columns])


def group_count(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).count()


def zone_clients(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Distinct (zone, client) pairs, of one zone if given."""
    if zone is not None:
        df = df.filter(F.col("Nombre_Zona") == zone)
    return df.select("Nombre_Zona", "Cliente").distinct()


def bias_factor(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Totals of actual and predicted and the factor that makes them equal (1.0 where
    nothing was predicted)."""
    totals = df.agg(F.sum(actual).cast("double").alias("total_actual"),
                    F.sum(predicted).cast("double").alias("total_predicted"))
    return totals.withColumn("factor", F.when(F.col("total_predicted") == 0, F.lit(1.0))
                             .otherwise(F.col("total_actual") / F.col("total_predicted")))


def error_metrics(df: DataFrame, actual: str, predicted: str, tolerance: float = 1.0) -> DataFrame:
    """RMSE, MAE, R2, smoothed MAPE (per cent), mean residual and bias alert in one pass."""
    y, r = F.col(actual).cast("double"), residual(F.col(actual), F.col(predicted))
    rows = (df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
            .select(y.alias("y"), r.cast("double").alias("r"),
                    smoothed_ape(actual, predicted).alias("ape")))
    sums = rows.agg(F.count("y").alias("n"), F.sum(F.col("r") * F.col("r")).alias("squares"),
                    F.sum(F.abs("r")).alias("absolute"), F.sum("r").alias("total"),
                    F.var_pop("y").alias("variance"), F.avg("ape").alias("ape"))
    n = F.col("n")
    return sums.select(
        F.sqrt(F.try_divide("squares", n)).alias("rmse"),
        F.try_divide("absolute", n).alias("mae"),
        (1 - F.try_divide("squares", n * F.col("variance"))).alias("r2"),
        (F.col("ape") * 100).alias("mape"),
        F.try_divide("total", n).alias("mean_residual"),
        bias_alert(F.try_divide("total", n), tolerance).alias("biased"))


def residual_histogram(df: DataFrame, actual: str, predicted: str, bins: int = 30) -> DataFrame:
    """Residuals in equal-width bins between their extremes; the last bin is closed."""
    rows = (df.select(residual(F.col(actual), F.col(predicted)).cast("double").alias("r"))
            .filter("r is not null"))
    extremes = rows.agg(F.struct(F.min("r").alias("low"), F.max("r").alias("high"))).scalar()
    ranged = rows.withColumn("e", extremes).select("r", "e.low", "e.high")
    width = (F.col("high") - F.col("low")) / bins
    bucket = F.when(F.col("low") == F.col("high"), F.lit(1)).otherwise(
        F.least(F.width_bucket("r", F.col("low"), F.col("high"), F.lit(bins)), F.lit(bins)))
    return (ranged.select(bucket.cast("int").alias("bin"), "low", width.alias("width"))
            .groupBy("bin").agg(F.first("low").alias("low"), F.first("width").alias("width"),
                                F.count(F.lit(1)).alias("rows"))
            .select("bin", (F.col("low") + (F.col("bin") - 1) * F.col("width")).alias("bin_from"),
                    (F.col("low") + F.col("bin") * F.col("width")).alias("bin_to"), "rows"))


def recommendation_summary(df: DataFrame, by: list[str] | None = None,
                           price: str = "Precio_Caja", boxes: str = "prediction_final",
                           income: str = "ingreso_estimado") -> DataFrame:
    """Total boxes, mean price and total income, over all or per group."""
    return df.groupBy(*(by or [])).agg(
        F.sum(boxes).alias("total_cajas"), F.avg(price).alias("precio_promedio"),
        F.sum(income).alias("ingreso_total"))
