"""Candidate products for every client, price scenarios and the best price."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from salesflow.functions import change_pct, month_number, price_strategy, revenue, scenario_price
from salesflow.names import CATALOGUE_COLUMNS
from salesflow.operators.joins import lookup_join
from salesflow.session import spread


def candidate_grid(clients: DataFrame, catalogue: DataFrame, month: str = "OCT",
                   with_clients: list[str] = (), with_products: list[str] = ()) -> DataFrame:
    """Every catalogue product for every client in one month.

    Each client row unfolds to the numbers 1..K and looks the numbered products up: a
    small catalogue is broadcast, a large one meets the clients on evenly spread keys.
    Clients are dealt to the session's shuffle partitions before they unfold: their rows fit a file or two, the grid
    does not fit a task. What follows by client finds them together. ``with_clients`` and ``with_products`` name columns
    of either side to keep beside the usual ones. ``catalogue`` is read twice; pass it stored.
    """
    order = Window.orderBy(*CATALOGUE_COLUMNS)  # over the K catalogue rows
    products = catalogue.select(*CATALOGUE_COLUMNS, *with_products, F.row_number().over(order).alias("_place"))
    n = catalogue.agg(F.count(F.lit(1)).cast("int")).scalar()
    places = F.explode(F.when(n > 0, F.sequence(F.lit(1), n))).alias("_place")
    unfolded = spread(clients, "Cliente").select("Cliente", "Region", "Nombre_Zona", *with_clients, places)
    grid = lookup_join(unfolded, products, ["_place"], "inner", sized_by=[catalogue]).drop("_place")
    return grid.withColumns({"Mes": F.lit(month), "Mes_Num": month_number(F.lit(month))})


def price_scenarios(top: DataFrame, low: int = -30, high: int = 30, step: int = 5,
                    price: str = "Precio_Caja") -> DataFrame:
    """One row per price change in per cent; ``precio_base`` keeps the price before."""
    changes = F.explode(F.sequence(F.lit(low), F.lit(high), F.lit(step)))
    return (top.withColumn("precio_base", F.col(price)).withColumn("ajuste", changes)
            .withColumn(price, scenario_price("precio_base", "ajuste")))


def split_scenarios(top: DataFrame, points: list[float], low: int = -30, high: int = 30,
                    price: str = "Precio_Caja") -> DataFrame:
    """One row per price that can bring the highest income where demand only changes at ``points`` (and a price at a
    point belongs to the piece below it).

    Within a piece income rises with the price, so its right end is its best: those points that lie
    from ``low`` to ``high`` per cent of the row's own price, and the price at ``high`` itself. The price before and
    the one at ``low`` are rows too. ``ajuste`` is the change in per cent, not whole. A null price stays
    one row, so does zero.
    """
    base, first, last = F.col("precio_base"), scenario_price("precio_base", F.lit(low)), scenario_price("precio_base", F.lit(high))
    inside = F.filter(F.array(*map(F.lit, points)).cast("array<double>"), lambda p: (p > first) & (p < last))
    prices = F.array_distinct(F.concat(F.array(base, first, last), F.coalesce(inside, F.array().cast("array<double>"))))
    return (top.withColumn("precio_base", F.col(price).cast("double")).withColumn(price, F.explode(prices))
            .withColumn("ajuste", F.coalesce(change_pct("precio_base", price), F.lit(0.0))))


def discount_scenario(top: DataFrame, pct: int = -10, price: str = "Precio_Caja") -> DataFrame:
    """The single-step variant: the same products at one changed price."""
    return price_scenarios(top, pct, pct, 1, price)


def with_revenue(df: DataFrame, price: str = "Precio_Caja", demand: str = "prediction_final",
                 scale: int | None = None, output: str = "ingreso_estimado") -> DataFrame:
    return df.withColumn(output, revenue(price, demand, scale))


def best_price(scenarios: DataFrame, keys: list[str], price: str = "Precio_Caja",
               demand: str = "prediction_final", income: str = "ingreso_estimado") -> DataFrame:
    """Change with the highest income per group, its gain over the smallest change and the
    strategy it stands for. Of equal incomes the lowest change wins."""
    known = F.when(~F.isnan(income), F.col(income))  # an unknown income is never the best
    row = F.struct(known.alias("income"), (-F.col("ajuste")).alias("minus_change"),
                   F.col(price).alias("price"), F.col(demand).alias("demand"))
    base = F.struct((-F.abs("ajuste")).alias("closeness"), (-F.col("ajuste")).alias("minus_change"),
                    known.alias("income"))
    best = scenarios.groupBy(*keys).agg(F.max(row).alias("best"), F.max(base).alias("base"))
    change = -F.col("best.minus_change")
    return best.select(
        *keys, change.alias("ajuste"), F.col("best.price").alias("precio_optimo"),
        F.col("best.demand").alias("demanda_optima"), F.col("best.income").alias("ingreso_optimo"),
        F.col("base.income").alias("ingreso_base"),
        change_pct(F.col("base.income"), F.col("best.income")).alias("mejora_pct"),
        price_strategy(change).alias("estrategia"))
