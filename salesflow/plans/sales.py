"""Whole jobs: raw files to training table, reports to customer data, model to prices."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from salesflow.models import demand
from salesflow.models.demand import DemandModel, load_model_or_none
from salesflow.models.recommend import best_exact_prices, best_prices, recommend
from salesflow.names import (GEO_TEXT, LEVEL_PRODUCT, MASTER_TEXT, REPORT_TEXT, SALES_METRICS,
                             SALES_TEXT)
from salesflow.operators.aggregates import annual_totals, customer_features
from salesflow.operators.cleaning import clean_audit, clean_dataset
from salesflow.operators.enrich import (enriched_sales, family_context, master_sales,
                                        sales_facts, training_rows, with_annual_totals,
                                        with_contexts, zone_context)
from salesflow.operators.joins import duplicate_keys
from salesflow.operators.ranking import catalogue, client_dimension
from salesflow.operators.renaming import metric_columns
from salesflow.operators.reshape import reshape_both
from salesflow.session import stage
from salesflow.sources import read_csv, read_json, read_parquet, write_csv, write_parquet
from salesflow.sources.partitions import read_partitions, write_partitions


@dataclass
class RawTables:
    """The seven inputs, as read."""
    master: DataFrame
    sales: DataFrame
    geo: DataFrame
    product_values: DataFrame
    product_units: DataFrame
    family_values: DataFrame
    family_units: DataFrame


def read_raw(spark: SparkSession, master: str, sales: str, geo: str, product_values: str,
             product_units: str, family_values: str, family_units: str,
             infer: bool = False) -> RawTables:
    """Read the inputs from their paths. All CSV cells stay text unless inferred: cleaning
    turns the metrics into numbers, so no pass over the data is spent on guessing types."""
    wide = dict(sep=",", infer=infer)
    return RawTables(read_csv(spark, master, sep=";", infer=infer),
                     read_csv(spark, sales, sep=";", infer=infer), read_json(spark, geo),
                     read_csv(spark, product_values, **wide),
                     read_csv(spark, product_units, **wide),
                     read_csv(spark, family_values, **wide),
                     read_csv(spark, family_units, **wide))


def training_table(raw: RawTables, negatives: str = "drop", policy: str = "cell", **layout) -> DataFrame:
    """Clean, enrich and join everything into one row per sale.

    Contexts are aggregates of the reports; they are staged, so that their real size decides how the
    facts meet them: by broadcast, or in buckets that both contexts share (``layout``: see ``lookup_joins``).
    """
    master = clean_dataset(raw.master, MASTER_TEXT)
    sales = clean_dataset(raw.sales, SALES_TEXT, SALES_METRICS, negatives)
    geo = clean_dataset(raw.geo, GEO_TEXT)
    reports = [raw.product_units, raw.product_values, raw.family_units, raw.family_values]
    if policy == "row":
        reports = [clean_dataset(r, REPORT_TEXT, metric_columns(r)) for r in reports]
    zone = zone_context(reports[0], reports[1], policy)
    family = family_context(reports[2], reports[3], policy)
    facts = sales_facts(sales)
    return training_rows(with_contexts(enriched_sales(facts, geo, master), zone, family, **layout))


def input_report(raw: RawTables, negatives: str = "drop") -> DataFrame:
    """One row for each input of the training table: rows before and after cleaning, rows removed, and
    keys that occur more than once where a lookup on them would repeat sales."""
    checks = [("master", raw.master, MASTER_TEXT, [], ["Producto"]), ("sales", raw.sales, SALES_TEXT, SALES_METRICS, []),
              ("geo", raw.geo, GEO_TEXT, [], ["zone_code"])]
    checks += [(name, getattr(raw, name), REPORT_TEXT, metric_columns(getattr(raw, name)), []) for name in (
        "product_values", "product_units", "family_values", "family_units") if getattr(raw, name) is not None]
    rows = []
    for name, df, text, numbers, keys in checks:
        row = clean_audit(df, numbers, negatives).select(F.lit(name).alias("tabla"), "*")
        repeated = F.lit(0).cast("bigint")
        if keys:
            repeated = duplicate_keys(clean_dataset(df, text), keys).agg(F.count(F.lit(1))).scalar()
        rows.append(row.withColumn("claves_repetidas", repeated))
    return reduce(DataFrame.unionByName, rows)


def build_training_table(raw: RawTables, path: str, by_month: bool = False, **options) -> DataFrame:
    """Write the training table and read it back; by month, a month's score reads only
    its own folder."""
    write_parquet(training_table(raw, **options), path, ["Mes"] if by_month else None)
    return read_parquet(raw.sales.sparkSession, path)


def update_training_table(raw: RawTables, path: str, **options) -> DataFrame:
    """Write the months that occur in ``raw`` anew, leave the others as they are, and return the whole table. A run
    that dies leaves the table as it was."""
    write_partitions(training_table(raw, **options), path, "Mes")
    return read_partitions(raw.sales.sparkSession, path)


def customer_dataset(master: DataFrame, sales: DataFrame, family_report: DataFrame,
                     product_report: DataFrame, level: str = LEVEL_PRODUCT,
                     csv_path: str | None = None,
                     single_file: bool = False) -> tuple[DataFrame, DataFrame]:
    """(sales with annual report totals, features per client) from block reports."""
    sold = master_sales(master, sales)
    totals = annual_totals(reshape_both(family_report, product_report))
    complete = with_annual_totals(sold, totals, level, stage_as="annual_totals")
    if csv_path:
        write_csv(complete, csv_path, ";", single_file)
    return complete, customer_features(sold)


def train(table: DataFrame, model_path: str | None = None, search: bool = True,
          holdout_factor: bool = False, **options) -> tuple[DemandModel, DataFrame]:
    """(calibrated model, its error measures on held-out rows)."""
    train_part, test_part = demand.training_frame(table)
    if search:
        model = demand.tune(train_part, **options)
    else:
        model = demand.fit(train_part, demand.forest(**options))
    model = demand.calibrate(model, test_part if holdout_factor else train_part)
    if model_path:
        model.save(model_path)
    return model, demand.evaluate(model, test_part)


def recommendations(table: DataFrame, model_path: str, month: str = "OCT", n: int = 5,
                    k: int = 50) -> DataFrame:
    """Top products of every client; the bare catalogue where no model is stored."""
    products = stage(catalogue(table, k), "catalogue")
    clients = stage(client_dimension(table), "clients")
    return recommend(load_model_or_none(table.sparkSession, model_path), clients, products, month, n)


def prices(table: DataFrame, model: DemandModel, month: str = "OCT", k: int = 50, exact: bool = False) -> DataFrame:
    """Best price of every client's first recommendation: of steps of 5 per cent, or ``exact``ly of all."""
    products = stage(catalogue(table, k), "catalogue")
    best = best_exact_prices if exact else best_prices
    return best(model, stage(client_dimension(table), "clients"), products, month)
