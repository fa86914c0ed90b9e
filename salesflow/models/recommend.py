"""Product recommendations and best prices for all clients in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesflow.functions import change_pct, elasticity_class
from salesflow.models.demand import DemandModel, mean_column, split_points
from salesflow.names import ENCODED, NUMERIC
from salesflow.operators.ranking import top_n_per_client
from salesflow.operators.scenarios import (best_price, candidate_grid, discount_scenario,
                                           price_scenarios, split_scenarios, with_revenue)
from salesflow.session import spread, stage

FEATURES = ["Cliente", "Region", "Nombre_Zona", "Producto", "ID_Articulo", "Mes", *NUMERIC]
PREDICTIONS = ["prediction_final", "prediction_piezas"]
MEANS = [mean_column(c) for c in ENCODED]


def recommend(model: DemandModel | None, clients: DataFrame, products: DataFrame,
              month: str = "OCT", n: int = 5, means: bool = False) -> DataFrame:
    """The ``n`` products with the highest predicted demand per client, with the income
    they would bring. Without a model: the first ``n`` of the catalogue, unscored.

    Clients and products are encoded before they meet, once each. ``means`` keeps the encodings, so that the functions
    below need not look them up again.
    """
    if model is None:
        grid = candidate_grid(clients, products, month)
        return top_n_per_client(grid, n, "Venta_PY_Zona_Cajas",
                                ties=["Precio_Caja", "ID_Articulo", "Producto"])

    products = stage(model.encode(products, ["Producto"]), "encoded_products")  # read twice
    grid = candidate_grid(model.encode(clients, ["Cliente"]), products, month, [mean_column("Cliente")], [mean_column("Producto")])
    scored = model.score(grid).select(*FEATURES, *MEANS, *PREDICTIONS)
    top = with_revenue(top_n_per_client(scored, n))
    return top if means else top.drop(*MEANS)


PRICED = ["Cliente", "Region", "Nombre_Zona", "Producto", "precio_base"]


def _choices(model: DemandModel, top: DataFrame, *more: Column) -> DataFrame:
    """What a model needs of the rows of ``top``, encoded before they unfold: neither client nor product changes with the
    price. Rows that already lie by client stay there, others are dealt by it."""
    known = set(MEANS) <= set(top.columns)
    rows = top.select(*FEATURES, *MEANS, *more) if known else model.encode(top.select(*FEATURES, *more))
    return spread(rows, "Cliente")


def _best_of(model: DemandModel, scenarios: DataFrame) -> DataFrame:
    scored = model.score(scenarios).select(*PRICED, "ajuste", "Precio_Caja", "prediction_final")
    return best_price(with_revenue(scored), PRICED)


def optimise_price(model: DemandModel, top: DataFrame, low: int = -30, high: int = 30,
                   step: int = 5) -> DataFrame:
    """Best price change for each (client, product) row of ``top``, of whole steps."""
    return _best_of(model, price_scenarios(_choices(model, top), low, high, step))


def exact_price(model: DemandModel, top: DataFrame, low: int = -30, high: int = 30) -> DataFrame:
    """The price from ``low`` to ``high`` per cent of its own with the highest predicted income for each (client,
    product) row of ``top``: columns as of ``optimise_price``, never less income than any step gives.

    A forest's demand is constant between the prices it branches at, so only those are scored: as many rows as
    branches lie in the row's range, one a training bin at most.
    """
    return _best_of(model, split_scenarios(_choices(model, top), split_points(model, "Precio_Caja"), low, high))


def price_curve(model: DemandModel, top: DataFrame, **steps: int) -> DataFrame:
    """Every scenario with its predicted demand and income (the data of a price curve)."""
    scored = model.score(price_scenarios(_choices(model, top), **steps))
    return with_revenue(scored.select("Cliente", "Producto", "precio_base", "ajuste",
                                      "Precio_Caja", "prediction_final"))


def best_prices(model: DemandModel, clients: DataFrame, products: DataFrame,
                month: str = "OCT", **steps: int) -> DataFrame:
    """Best price of every client's first recommendation, all clients in one job."""
    return optimise_price(model, recommend(model, clients, products, month, n=1, means=True), **steps)


def best_exact_prices(model: DemandModel, clients: DataFrame, products: DataFrame,
                      month: str = "OCT", low: int = -30, high: int = 30) -> DataFrame:
    """As ``best_prices``, over every price in the range."""
    return exact_price(model, recommend(model, clients, products, month, n=1, means=True), low, high)


def discount_test(model: DemandModel, top: DataFrame, pct: int = -10) -> DataFrame:
    """Predicted boxes of each (client, product) row of ``top`` at its price and at the changed one, the
    change in per cent, and how elastic that makes the demand."""
    columns = ["Cliente", "Region", "Nombre_Zona", "Producto", "precio_base", "Precio_Caja"]
    chosen = _choices(model, top, F.col("prediction_final").alias("demanda_base"))
    rows = model.score(discount_scenario(chosen, pct)).select(
        *columns, "demanda_base", F.col("prediction_final").alias("demanda_nueva"))
    return rows.withColumns({"cambio_pct": change_pct(F.col("demanda_base"), F.col("demanda_nueva")),
                             "clase": elasticity_class(F.col("demanda_base"), F.col("demanda_nueva"))})
