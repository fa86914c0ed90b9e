"""Sales joined with geography, product master, zone and family context, annual totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from salesflow.functions import (family_key, normalise_text, piece_price, pieces, unit_price,
                                 zone_code)
from salesflow.names import FAMILY_CONTEXT, REPORT_ID, ZONE_CONTEXT
from salesflow.operators.cleaning import clamp_non_negative, clean_dataset, fill_nulls
from salesflow.operators.colocated import lookup_joins
from salesflow.operators.joins import lookup_join
from salesflow.operators.renaming import standardise
from salesflow.operators.reshape import unpivot_months
from salesflow.session import stage_all


def sales_facts(sales: DataFrame) -> DataFrame:
    """Cleaned raw sales -> standard names and types, zone code, pieces.

    Only negatives that cleaning let through are clamped; returns count as no demand.
    """
    df = standardise(sales)
    df = df.withColumns({
        "Venta_Valor": F.col("Venta_Valor").try_cast("double"),
        "Venta_Cajas": F.col("Venta_Cajas").try_cast("double").try_cast("bigint"),
        "Mes_Num": F.col("Mes_Num").try_cast("int"),
        "zone_code_join": zone_code("Vendedor"),
    })
    df = clamp_non_negative(df, ["Venta_Cajas", "Venta_Valor"])
    return df.withColumn("Venta_Piezas_Reales", pieces("Venta_Cajas"))


def geo_dimension(geo: DataFrame) -> DataFrame:
    return geo.select(F.trim("zone_code").alias("zone_code_join"),
                      F.col("zone_name").alias("Nombre_Zona"), F.col("region").alias("Region"))


def product_dimension(master: DataFrame) -> DataFrame:
    return master.select(F.trim("Producto").alias("Producto_Key"),
                         F.col("Descripcion").alias("Nombre_Producto_Oficial"),
                         F.col("Numero de articulo").alias("ID_Articulo"))


def with_geography(facts: DataFrame, geo: DataFrame, **join) -> DataFrame:
    return lookup_join(facts, geo_dimension(geo), ["zone_code_join"], **join)


def with_product(facts: DataFrame, master: DataFrame, **join) -> DataFrame:
    """Official product name and article. The key stays null for unknown products, as the
    contexts are only joined to products of the master."""
    dim = product_dimension(master).withColumn("_product", F.col("Producto_Key"))
    keyed = facts.withColumn("_product", F.trim("Producto"))
    return lookup_join(keyed, dim, ["_product"], **join).drop("_product")


def with_prices(df: DataFrame) -> DataFrame:
    return (df.withColumn("Precio_Caja", unit_price("Venta_Valor", "Venta_Cajas"))
            .withColumn("Precio_Unitario_Pieza", piece_price("Precio_Caja")))


def enriched_sales(facts: DataFrame, geo: DataFrame, master: DataFrame) -> DataFrame:
    """Facts with zone, region, official product name and prices; join keys kept."""
    df = with_product(with_geography(facts, geo), master)
    return with_prices(df).select(
        "zone_code_join", "Producto_Key", "Region", "Nombre_Zona", "Cliente",
        F.coalesce("Nombre_Producto_Oficial", "Producto").alias("Producto"),
        "ID_Articulo", "Mes_Num", "Mes", "Venta_Cajas", "Venta_Piezas_Reales", "Venta_Valor",
        "Precio_Caja", "Precio_Unitario_Pieza")


def report_long(report: DataFrame, target: str, prior: str, key: str = "Producto",
                policy: str = "cell") -> DataFrame:
    """Wide month report -> cleaned long rows.

    ``policy="cell"`` drops a month without a valid number; ``"row"`` expects a report
    that was cleaned while wide, where one bad month removes the whole row, and keeps
    all of its cells.
    """
    if policy not in ("cell", "row"):
        raise ValueError("policy must be 'cell' or 'row'")
    if policy == "cell":
        report = report.withColumns({c: normalise_text(c) for c in ("Zona", key)})
    long = unpivot_months(report, ["Zona", key], target, prior)
    if policy == "cell":
        long = clean_dataset(long, numeric=[target, prior])
    return clamp_non_negative(long, [target, prior])


def _with_pieces(df: DataFrame, stem: str) -> DataFrame:
    return df.withColumns({f"{side}_{stem}_Piezas": pieces(f"{side}_{stem}_Cajas")
                           for side in ("Meta", "Venta_PY")})


def zone_context(units: DataFrame, values: DataFrame, policy: str = "cell") -> DataFrame:
    """Targets and prior year per zone, product and month: units and values, where both
    reports know the cell."""
    boxes = _with_pieces(report_long(units, "Meta_Zona_Cajas", "Venta_PY_Zona_Cajas",
                                     policy=policy), "Zona")
    money = report_long(values, "Meta_Zona_Valor", "Venta_PY_Zona_Valor", policy=policy)
    both = boxes.join(money, ["Zona", "Producto", "Mes_Corto"], "inner")
    return both.withColumns({"zone_code_join": zone_code("Zona"),
                             "Producto_Key": F.trim("Producto"),
                             "Mes_Corto": F.upper("Mes_Corto")})


def zone_lookup(context: DataFrame) -> DataFrame:
    return context.select("zone_code_join", F.col("Producto_Key").alias("_product"),
                          F.col("Mes_Corto").alias("_month"), *ZONE_CONTEXT)


def _with_prior_price(joined: DataFrame) -> DataFrame:
    return fill_nulls(joined, 0, ZONE_CONTEXT).withColumn(
        "Precio_Promedio_PY_Caja", unit_price("Venta_PY_Zona_Valor", "Venta_PY_Zona_Cajas"))


def with_zone_context(sales: DataFrame, context: DataFrame, product: str = "Producto_Key",
                      **join) -> DataFrame:
    """Zone context for every sale (0 where unknown) and the prior-year market price."""
    keyed = sales.withColumns({"_product": F.col(product), "_month": F.col("Mes")})
    joined = lookup_join(keyed, zone_lookup(context), ["zone_code_join", "_product", "_month"], **join)
    return _with_prior_price(joined.drop("_product", "_month"))


def family_context(units: DataFrame, values: DataFrame, policy: str = "cell") -> DataFrame:
    """Targets and prior year per zone, family and month, from either report."""
    units, values = [d.withColumnRenamed("Producto", "Familia_Nom") for d in (units, values)]
    boxes = _with_pieces(report_long(units, "Meta_Familia_Cajas", "Venta_PY_Familia_Cajas",
                                     "Familia_Nom", policy), "Familia")
    money = report_long(values, "Meta_Familia_Valor", "Venta_PY_Familia_Valor",
                        "Familia_Nom", policy)
    either = boxes.join(money, ["Zona", "Familia_Nom", "Mes_Corto"], "outer")
    return either.withColumns({"Family_Join_Key": family_key("Familia_Nom"),
                               "zone_code_join": zone_code("Zona"),
                               "Mes_Corto": F.upper("Mes_Corto")})


def family_lookup(context: DataFrame) -> DataFrame:
    """One row per zone, first word and month: families that share their first word are
    added up, so that the lookup cannot repeat a sale."""
    return (context.groupBy("zone_code_join", "Family_Join_Key", "Mes_Corto")
            .agg(*[F.sum(c).alias(c) for c in FAMILY_CONTEXT]))


def with_family_context(sales: DataFrame, context: DataFrame, **join) -> DataFrame:
    """Family context for every sale by the first word of its product, 0 where unknown."""
    dim = family_lookup(context).withColumnRenamed("Mes_Corto", "_month")
    keyed = sales.withColumns({"Family_Join_Key": family_key("Producto"),
                               "_month": F.col("Mes")})
    joined = lookup_join(keyed, dim, ["zone_code_join", "Family_Join_Key", "_month"], **join)
    return fill_nulls(joined.drop("Family_Join_Key", "_month"), 0, FAMILY_CONTEXT)


def with_contexts(sales: DataFrame, zone: DataFrame, family: DataFrame, product: str = "Producto_Key",
                  **layout) -> DataFrame:
    """``with_zone_context``, then ``with_family_context``, with one exchange of the sales at most (see ``lookup_joins``, which
    gets ``layout``): both contexts are joined by zone and month, next to product or family."""
    by = ["zone_code_join", "_month"]
    zones, families = stage_all((zone_lookup(zone), "zone_context"), (
        family_lookup(family).withColumnRenamed("Mes_Corto", "_month"), "family_context"))
    lookups = [(zones, [*by, "_product"]), (families, [*by, "Family_Join_Key"])]
    keyed = sales.withColumns({"_product": F.col(product), "_month": F.col("Mes"), "Family_Join_Key": family_key("Producto")})
    joined = lookup_joins(keyed, lookups, by, **layout).drop("_product", "_month", "Family_Join_Key")
    filled = _with_prior_price(fill_nulls(joined, 0, FAMILY_CONTEXT))
    rest = [c for c in filled.columns if c not in FAMILY_CONTEXT]
    return filled.select(*[f"`{c}`" for c in rest], *FAMILY_CONTEXT)


def training_rows(df: DataFrame) -> DataFrame:
    """Last fills and the price sanity filter; join keys are dropped."""
    numbers = ["Venta_Cajas", "Venta_Piezas_Reales", "Venta_Valor", "Precio_Caja",
               "Precio_Unitario_Pieza", "Mes_Num", "Precio_Promedio_PY_Caja"]
    df = fill_nulls(df, 0, numbers).filter(F.col("Precio_Caja") >= 0)
    return df.drop("zone_code_join", "Producto_Key")


def master_sales(master: DataFrame, sales: DataFrame, **join) -> DataFrame:
    """Sold products of the master: described, with a positive amount and no return, and
    their unrounded unit price. The key appears once."""
    master = (master.withColumn("Numero de articulo",
                                F.col("`Numero de articulo`").try_cast("int"))
              .filter(F.col("Descripcion").isNotNull()))
    sales = (sales.withColumn("2025", F.col("`2025`").try_cast("double"))
             .filter((F.col("`2025`") > 0) & (F.col("CANTIDAD") >= 0)))
    joined = lookup_join(sales, master, ["Producto"], "inner", **join)
    return joined.withColumn("Precio_Unitario", unit_price("2025", "CANTIDAD", scale=None))


def with_annual_totals(sales: DataFrame, totals: DataFrame, level: str,
                       product: str = "Producto", **join) -> DataFrame:
    """Annual report totals of one level for every sale. Joining both levels at once would
    repeat the sales of a name that exists on both."""
    dim = totals.filter(F.col("Nivel") == level).withColumn("_product", F.col(REPORT_ID))
    keyed = sales.withColumn("_product", F.col(product))
    return lookup_join(keyed, dim, ["_product"], "left", **join).drop("_product")
