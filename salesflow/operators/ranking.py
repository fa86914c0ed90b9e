"""Catalogue, top-n, lists for pickers, samples and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from salesflow.names import ALL_ZONES, CATALOGUE_COLUMNS
from salesflow.operators.aggregates import zone_clients

def client_dimension(df: DataFrame) -> DataFrame:
    """One (region, zone) context per client: the one most of its sales come from, the
    first in order when several do.

    Contexts are counted first, so a client with a third of all rows is down to a handful
    of them before anything is compared.
    """
    contexts = (df.filter(F.col("Cliente").isNotNull())
                .groupBy("Cliente", "Region", "Nombre_Zona").agg(F.count(F.lit(1)).alias("n")))
    return (contexts.groupBy("Cliente")
            .agg(F.min(F.struct((-F.col("n")).alias("n"), "Region", "Nombre_Zona")).alias("c"))
            .select("Cliente", "c.Region", "c.Nombre_Zona"))


def client_context(df: DataFrame, client: str) -> DataFrame:
    """Context of one client; no row for an unknown one."""
    return client_dimension(df.filter(F.col("Cliente") == client))


def one_per_product(df: DataFrame) -> DataFrame:
    """One row per product: most prior-year boxes in its zone, then lowest price, then
    article. The lowest price per otherwise equal row is found first, which leaves one row
    per zone, product and month for the final choice."""
    rest = [c for c in CATALOGUE_COLUMNS if c != "Precio_Caja"]
    cells = df.groupBy(*rest).agg(F.min("Precio_Caja").alias("Precio_Caja"))
    order = [c for c in CATALOGUE_COLUMNS if c not in ("Producto", "Venta_PY_Zona_Cajas")]
    boxes = F.col("Venta_PY_Zona_Cajas")
    best = cells.groupBy("Producto").agg(F.min(F.struct(
        boxes.isNull().alias("missing"), (-boxes).alias("minus_boxes"), *order)).alias("b"))
    return best.select("Producto", (-F.col("b.minus_boxes")).alias("Venta_PY_Zona_Cajas"),
                       *[f"b.{c}" for c in order]).select(*CATALOGUE_COLUMNS)


def catalogue(df: DataFrame, k: int = 50) -> DataFrame:
    """The ``k`` products with most prior-year boxes, one row each."""
    if k < 1:
        raise ValueError("k must be 1 at least")
    return one_per_product(df).orderBy(F.desc("Venta_PY_Zona_Cajas"), "Precio_Caja",
                                       "ID_Articulo", "Producto").limit(k)


def top_n_per_client(scored: DataFrame, n: int, score: str = "prediction_final",
                     by: list[str] | None = None, ties: list[str | Column] = ("Producto",),
                     rank: str = "puesto") -> DataFrame:
    """The ``n`` best rows per client, ties broken by product. Spark keeps only ``n`` rows
    per client and task before it shuffles."""
    window = Window.partitionBy(*(by or ["Cliente"])).orderBy(F.desc(score), *ties)
    return scored.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= n)


def rank_by_revenue(df: DataFrame, income: str = "ingreso_estimado") -> DataFrame:
    return df.orderBy(F.desc(income), "Producto", "Cliente")


def zone_options(df: DataFrame) -> DataFrame:
    """Zones for a picker: "all" first, then the zones in order, without nulls."""
    zones = df.select(F.col("Nombre_Zona").alias("zona")).distinct().filter("zona is not null")
    every = df.sparkSession.range(1).select(F.lit(0).alias("orden"), F.lit(ALL_ZONES).alias("zona"))
    return (every.unionByName(zones.select(F.lit(1).alias("orden"), "zona"))
            .orderBy("orden", "zona"))


def client_options(df: DataFrame, zone: str | None = None) -> DataFrame:
    """Clients of a zone (all zones by default), in order, each once."""
    if zone == ALL_ZONES:
        zone = None
    return zone_clients(df, zone).select("Cliente").distinct().orderBy(F.asc_nulls_last("Cliente"))


def row_number_of(columns: list[str], seed: int) -> Column:
    """A number below 2**60 from a seeded hash of a row's columns: the same wherever the row lies."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(f"`{c}`").cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def sample_rows(df: DataFrame, fraction: float = 0.2, n: int = 5000, seed: int = 42,
                columns: list[str] | None = None) -> DataFrame:
    """A uniform sample of ``fraction`` of the rows, ``n`` at most: those with the smallest hashes of ``columns`` (all by
    default). Every row has the same chance, whatever partition it lies in; the sample is the same at any partitioning, and
    a smaller one is part of a larger. Rows that agree in ``columns`` share their chance. Each task keeps its ``n`` best."""
    if not 0 <= fraction <= 1 or n < 0:
        raise ValueError("fraction must lie between 0 and 1, and n must not be negative")
    number = row_number_of(columns or df.columns, seed)
    chosen = df.withColumn("_number", number).where(F.col("_number") < int(fraction * (1 << 60)))
    return chosen.orderBy("_number", *[f"`{c}`" for c in columns or ()]).limit(n).drop("_number")


def split(df: DataFrame, weights: tuple[float, ...] = (0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    return df.randomSplit(list(weights), seed)


def split_by_hash(df: DataFrame, columns: list[str] | None = None, train: int = 8,
                  of: int = 10) -> tuple[DataFrame, DataFrame]:
    """Stable (train, test) split by a hash of the row: two narrow filters, where a random
    split first has to sort every partition to be repeatable."""
    bucket = F.pmod(F.xxhash64(*[f"`{c}`" for c in (columns or df.columns)]), F.lit(of))
    return df.filter(bucket < train), df.filter(bucket >= train)


def split_by_key(df: DataFrame, key: str, train: int = 8, of: int = 10,
                 output: str = "parte") -> DataFrame:
    """Stable split: a row's part depends on its integer key alone, not on partitioning or
    seed, so it survives task retries, new data and a rewrite of the table."""
    bucket = F.pmod(F.col(key), F.lit(of))
    return df.withColumn(output, F.when(bucket < train, "train").otherwise("test"))
