"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from salesflow.checks import roles
from salesflow.functions import (elasticity_class, exact_sum, family_key, inverse_log, log_target,
                                 month_code, month_number, normalise_text, piece_price, pieces,
                                 unit_price, zone_code)
from salesflow.models import demand
from salesflow.models.recommend import best_exact_prices, best_prices, discount_test, exact_price, price_curve, recommend
from salesflow.names import (ENCODED, GEO_TEXT, INDEXED, LEVEL_PRODUCT, MASTER_TEXT, NUMERIC,
                             REPORT_TEXT, SALES_METRICS)
from salesflow.operators import aggregates, cleaning, enrich, incremental, ranking, renaming, reshape, scenarios
from salesflow.operators.joins import duplicate_keys, join_audit, lookup_join
from salesflow.operators.ordering import category_index
from salesflow.session import files_stamp, spread, stage, stage_folder
from salesflow.plans import sales as sales_plan
from salesflow.sources import (read_block_report, read_csv, read_json, read_parquet, write_csv, write_json,
                               write_parquet)
from salesflow.sources.partitions import read_partitions, write_partitions
from salesflow.streaming.ingest import ingest_drop, ingest_once, read_landed

KEYS = ["l_orderkey", "l_linenumber"]


# --- shared inputs ----------------------------------------------------------

def _gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Line items with the nulls the tables themselves do not have."""
    return roles.table(spark, sf, "lineitem").select(
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.nullif("l_returnflag", F.lit("N")).alias("flag"))


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    facts = enrich.sales_facts(roles.clean_sales(spark, sf))
    geo = cleaning.clean_dataset(roles.geography(spark, sf), GEO_TEXT)
    master = cleaning.clean_dataset(roles.master(spark, sf), MASTER_TEXT)
    return enrich.enriched_sales(facts, geo, master)


def _zone_context(cells: DataFrame, policy: str = "cell", level: str = "product") -> DataFrame:
    reports = [roles.month_report(cells, measure, level) for measure in ("units", "values")]
    if policy == "row":
        reports = [cleaning.clean_dataset(r, REPORT_TEXT, renaming.metric_columns(r)) for r in reports]
    return enrich.zone_context(*reports, policy)


def _family_context(cells: DataFrame, policy: str = "cell") -> DataFrame:
    reports = [roles.month_report(cells, measure, "family") for measure in ("units", "values")]
    if policy == "row":
        reports = [cleaning.clean_dataset(r, REPORT_TEXT, renaming.metric_columns(r)) for r in reports]
    return enrich.family_context(*reports, policy)


def _cells(spark: SparkSession, sf: str) -> DataFrame:
    """Stored: several reports are cut from it, and it is small where the sales are not."""
    return stage(roles.month_cells(spark, sf), "month_cells")


def _with_zone(spark: SparkSession, sf: str, cells: DataFrame) -> DataFrame:
    # Reports name their products, so the context meets the official name.
    return enrich.with_zone_context(_enriched(spark, sf), _zone_context(cells), "Producto",
                                    stage_as="zone_context")


def ml_dataset(spark: SparkSession, sf: str, **layout) -> DataFrame:
    cells = _cells(spark, sf)
    joined = enrich.with_contexts(_enriched(spark, sf), _zone_context(cells), _family_context(cells), "Producto", **layout)
    return enrich.training_rows(joined)


def ml_dataset_colocated(spark: SparkSession, sf: str) -> DataFrame:
    """The training table with both contexts bucketed next to the sales, as beyond the broadcast threshold; a zone and
    month with more than a 400th of all rows is cut into parts."""
    rows = roles.table(spark, sf, "lineitem").count()
    return ml_dataset(spark, sf, limit=0, rows_per_bucket=max(1, rows // 400))


def _reports(spark: SparkSession, sf: str) -> DataFrame:
    cells = _year_cells(spark, sf)
    family, product = [renaming.rename_blocks(roles.block_report(cells, level))
                       for level in ("family", "product")]
    return reshape.reshape_both(family, product)


def _master_sales(spark: SparkSession, sf: str) -> DataFrame:
    return enrich.master_sales(roles.master(spark, sf), roles.raw_sales(spark, sf))


def _fixed_prediction(spark: SparkSession, sf: str) -> DataFrame:
    """Actual quantity next to a prediction worked out from the part key."""
    return roles.table(spark, sf, "lineitem").select(
        *KEYS, F.col("l_quantity").alias("actual"),
        (F.pmod("l_partkey", F.lit(50)) + 1).cast("double").alias("predicted"))


_stored: dict[tuple, DataFrame] = {}


def _store(spark: SparkSession, sf: str, name: str, build) -> DataFrame:
    """A table written once per session and state of the folder, for the queries that start from it."""
    key = (spark.sparkContext.applicationId, sf, files_stamp(spark, sf), name)
    if key not in _stored:
        _stored[key] = stage(build(), name, keep=True)
    return _stored[key]


def _training(spark: SparkSession, sf: str) -> DataFrame:
    """The training table as stored: everything after the enrichment starts from it."""
    return _store(spark, sf, "training", lambda: ml_dataset(spark, sf))


def _products(spark: SparkSession, sf: str) -> DataFrame:
    return _store(spark, sf, "catalogue", lambda: ranking.catalogue(_training(spark, sf), 50))


def _clients(spark: SparkSession, sf: str) -> DataFrame:
    return _store(spark, sf, "clients", lambda: ranking.client_dimension(_training(spark, sf)))


def _grid(spark: SparkSession, sf: str) -> DataFrame:
    return scenarios.candidate_grid(_clients(spark, sf), _products(spark, sf))


def _fixed_score(grid: DataFrame) -> DataFrame:
    """A whole-number demand from client and article, in place of a model."""
    client = F.substring("Cliente", 10, 9).cast("bigint")
    score = F.pmod(client * 31 + F.col("ID_Articulo").cast("bigint") * 17, F.lit(97)) + 1
    scored = grid.withColumn("prediction_final", score.cast("double"))
    return scored.withColumn("prediction_piezas", pieces("prediction_final"))


def _top(spark: SparkSession, sf: str, n: int) -> DataFrame:
    return scenarios.with_revenue(
        ranking.top_n_per_client(_fixed_score(_grid(spark, sf)), n), scale=2)


def _fixed_scenarios(spark: SparkSession, sf: str) -> DataFrame:
    """Price scenarios per part; demand falls with the price, faster for some parts."""
    parts = roles.table(spark, sf, "part").select(
        F.col("p_partkey").alias("Producto"), F.col("p_retailprice").alias("Precio_Caja"),
        F.col("p_size").alias("tamano"))
    # A task reads a million parts of a file at once; dealt before they unfold, no task orders all their scenarios.
    return _fixed_demand(scenarios.price_scenarios(spread(parts, "Producto")))


def _fixed_demand(rows: DataFrame) -> DataFrame:
    slope = F.lit(50) + F.lit(50) * F.pmod("Producto", F.lit(4))
    demand_units = F.col("tamano") * (F.lit(10000) - slope * F.col("ajuste"))
    scored = rows.withColumn("prediction_final", demand_units.cast("double") / 100)
    return scenarios.with_revenue(scored)


_trained: dict[tuple, demand.DemandModel] = {}


def _model(spark: SparkSession, sf: str) -> tuple[demand.DemandModel, DataFrame]:
    """Calibrated model and its stored training table, trained once per session and state of the folder."""
    key = (spark.sparkContext.applicationId, sf, files_stamp(spark, sf))
    table = _training(spark, sf)
    if key not in _trained:
        train, _ = demand.training_frame(table)
        _trained[key] = demand.calibrate(demand.fit(train), train)
    return _trained[key], table


# --- queries ----------------------------------------------------------------

def sales_standardised(spark, sf):
    return renaming.standardise(roles.raw_sales(spark, sf))


def block_rename(spark, sf):
    return renaming.rename_blocks(roles.block_report(roles.year_cells(spark, sf), "product"))


def cast_metrics(spark, sf):
    sign = F.when(F.col("l_returnflag") == "R", "%").otherwise("")
    text = roles.table(spark, sf, "lineitem").select(
        *KEYS, F.concat(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), sign)
        .alias("valor"),
        F.concat(F.col("l_quantity").cast("decimal(18,1)").cast("string"), sign).alias("cajas"))
    return renaming.cast_columns(renaming.cast_columns(text, ["valor"], "double"),
                                 ["cajas"], "int")


def drop_empty_rows(spark, sf):
    return cleaning.drop_empty(_gaps(spark, sf))


def drop_incomplete_rows(spark, sf):
    return cleaning.drop_incomplete(_gaps(spark, sf))


def fill_defaults(spark, sf):
    return cleaning.fill_nulls(cleaning.fill_nulls(_gaps(spark, sf), 0), "Desconocido")


def null_profile(spark, sf):
    return aggregates.null_profile(_gaps(spark, sf))


def clean_sales(spark, sf):
    return roles.clean_sales(spark, sf)


def clean_audit(spark, sf):
    return cleaning.clean_audit(roles.raw_sales(spark, sf), SALES_METRICS)


def positive_sales(spark, sf):
    return cleaning.positive_sales(roles.raw_sales(spark, sf))


def clamp_returns(spark, sf):
    return cleaning.clamp_non_negative(roles.raw_sales(spark, sf), ["2025", "CANTIDAD"])


def outlier_trim(spark, sf):
    lines = roles.table(spark, sf, "lineitem").select(*KEYS, "l_extendedprice")
    return cleaning.trim_outliers(lines, "l_extendedprice", 0.99, exact=True)


def sales_geo(spark, sf):
    facts = enrich.sales_facts(roles.clean_sales(spark, sf))
    geo = cleaning.clean_dataset(roles.geography(spark, sf), GEO_TEXT)
    return enrich.with_geography(facts, geo)


def sales_enriched(spark, sf):
    return _enriched(spark, sf)


def zone_targets_long(spark, sf):
    report = roles.month_report(roles.month_cells(spark, sf), "units", "product")
    return reshape.unpivot_months(report, ["Zona", "Producto"], "Meta_Zona_Cajas",
                                  "Venta_PY_Zona_Cajas")


def zone_context(spark, sf):
    return _zone_context(_cells(spark, sf))


def sales_zone_context(spark, sf):
    return _with_zone(spark, sf, _cells(spark, sf))


def family_context(spark, sf):
    return _family_context(_cells(spark, sf))


def report_long(spark, sf):
    report = renaming.rename_blocks(roles.block_report(roles.year_cells(spark, sf), "product"))
    return reshape.split_label(reshape.unpivot_all(report))


def report_wide(spark, sf):
    return reshape.type_metrics(reshape.pivot_metrics(report_long(spark, sf)))


def report_union(spark, sf):
    return _reports(spark, sf)


def annual_totals(spark, sf):
    return aggregates.annual_totals(_reports(spark, sf))


def master_sales(spark, sf):
    return _master_sales(spark, sf)


def customer_features(spark, sf):
    return aggregates.customer_features(_master_sales(spark, sf))


def sales_annual_context(spark, sf):
    return enrich.with_annual_totals(_master_sales(spark, sf), annual_totals(spark, sf),
                                     LEVEL_PRODUCT, "Descripcion", stage_as="annual_totals")


def input_report(spark, sf):
    cells = _cells(spark, sf)
    return sales_plan.input_report(sales_plan.RawTables(
        roles.master(spark, sf), roles.raw_sales(spark, sf), roles.geography(spark, sf),
        roles.month_report(cells, "values", "product"), roles.month_report(cells, "units", "product"),
        roles.month_report(cells, "values", "family"), roles.month_report(cells, "units", "family")))


def join_audit_query(spark, sf):
    facts = enrich.sales_facts(roles.clean_sales(spark, sf))
    master = cleaning.clean_dataset(roles.master(spark, sf), MASTER_TEXT)
    return join_audit(facts, lambda df: enrich.with_product(df, master))


def dup_keys(spark, sf):
    return duplicate_keys(roles.table(spark, sf, "lineitem"), KEYS)


def group_count(spark, sf):
    return aggregates.group_count(roles.table(spark, sf, "events"), "event_type")


def _fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{stage_folder(spark)}/{name}-{uuid.uuid4().hex}"


def file_drop_ingest(spark, sf):
    """The events dropped as CSV files and landed as JSON by the stream."""
    folder = _fresh_folder(spark, "drop")
    events = roles.table(spark, sf, "events")
    write_csv(events, f"{folder}/in", ",")
    ingest_drop(spark, f"{folder}/in", f"{folder}/out", events.schema,
                f"{folder}/checkpoint").awaitTermination()
    landed = read_landed(spark, f"{folder}/out", events.schema)
    return landed.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def file_drop_once(spark, sf):
    """The events dropped as CSV files, landed, dropped again under other names, and landed again after a restart."""
    folder = _fresh_folder(spark, "drop")
    events = roles.table(spark, sf, "events")
    for _ in range(2):
        write_csv(events, f"{folder}/in", ",", mode="append")
        ingest_once(spark, f"{folder}/in", f"{folder}/out", events.schema, f"{folder}/checkpoint").awaitTermination()
    landed = read_landed(spark, f"{folder}/out", events.schema)
    return landed.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


def customer_features_stored(spark, sf):
    """Client features from states by month: eleven months, then the last one, then March delivered again."""
    folder, sold = _fresh_folder(spark, "features"), _master_sales(spark, sf)
    for months in ("`MES NUM` < 12", "`MES NUM` = 12", "`MES NUM` = 3"):
        incremental.update_client_features(sold.where(months), folder)
    return incremental.stored_client_features(spark, folder)


def annual_totals_stored(spark, sf):
    """Annual totals from states by month: a first delivery of some months, the whole later."""
    folder, report = _fresh_folder(spark, "totals"), _reports(spark, sf)
    incremental.update_annual_totals(report.where("Mes IN ('ENERO', 'MARZO', 'YTD_JUL')"), folder)
    incremental.update_annual_totals(report.where("Mes <> 'ENERO'"), folder)
    return incremental.stored_annual_totals(spark, folder)


def quantiles_stored(spark, sf):
    """99 % quantiles of ranges of months from one sketch a month: rows of the range, and whether the exact rank of the
    value lies within twice the stated error."""
    folder = _fresh_folder(spark, "sketches")
    lines = roles.table(spark, sf, "lineitem").select("l_extendedprice", F.month("l_shipdate").alias("mes"))
    incremental.update_sketches(lines.where("mes <= 9"), folder, "l_extendedprice", "mes")
    incremental.update_sketches(lines.where("mes >= 9"), folder, "l_extendedprice", "mes")
    ranges = [(1, 3), (2, 2), (4, 9), (1, 12)]
    limits = [incremental.stored_quantile(spark, folder, 0.99, "mes", list(range(a, b + 1))) for a, b in ranges]
    rows = F.inline(F.array(*[F.struct(F.lit(a).alias("desde"), F.lit(b).alias("hasta"), F.lit(q).alias("limite"))
                              for (a, b), q in zip(ranges, limits)]))
    share = F.avg((F.col("l_extendedprice") <= F.col("limite")).cast("double"))
    return lines.select("l_extendedprice", "mes", rows).where(F.col("mes").between(F.col("desde"), F.col("hasta"))).groupBy(
        "desde", "hasta").agg(F.count("*").alias("filas"),
                              (F.abs(share - 0.99) <= 2 * incremental.rank_error() + 1 / F.count("*")).alias("dentro"))


def outlier_trim_sketch(spark, sf):
    """The default way of the trim: rows before, and whether the rows left are those below the 99 % quantile but for its accuracy."""
    lines = roles.table(spark, sf, "lineitem")
    left = cleaning.trim_outliers(lines, "l_extendedprice", 0.99).agg(F.count("*")).first()[0]
    return lines.agg(F.count("*").alias("filas"), F.abs(F.lit(left) - F.count("*") * F.lit(0.99)).between(
        0, F.count("*") * F.lit(2e-4) + 1).alias("dentro"))


def csv_roundtrip(spark, sf):
    """The documents, with all their quotes, separators and line breaks, as CSV and back."""
    folder, docs = _fresh_folder(spark, "csv"), roles.table(spark, sf, "documents")
    write_csv(docs, folder, ";")
    return read_csv(spark, folder, docs.schema, ";", multi_line=True)


def json_roundtrip(spark, sf):
    """The web pages as JSON lines and back."""
    folder, pages = _fresh_folder(spark, "json"), roles.table(spark, sf, "pages")
    write_json(pages, folder)
    return read_json(spark, folder, pages.schema, "*.json")


def parquet_by_month(spark, sf):
    """The line items in a folder for each month, and back from all of them."""
    folder = _fresh_folder(spark, "parquet")
    lines = roles.table(spark, sf, "lineitem")
    write_parquet(lines.withColumn("mes", F.month("l_shipdate")), folder, ["mes"])
    return _month_rows(read_parquet(spark, folder))


def _month_rows(lines: DataFrame) -> DataFrame:
    return lines.select(*KEYS, "l_partkey", "l_extendedprice", F.date_format("l_shipdate", "yyyy-MM-dd").alias("l_shipdate"),
                        F.col("mes").cast("int").alias("mes"))


def months_rewritten(spark, sf):
    """All months written; then March at doubled prices and May without returned lines written again, and December emptied.
    A write in between fails halfway and changes nothing."""
    folder = _fresh_folder(spark, "months")
    lines = roles.table(spark, sf, "lineitem").withColumn("mes", F.month("l_shipdate"))
    write_partitions(lines, folder, "mes")
    broken = F.when(F.col("l_linenumber") > 3, F.raise_error(F.lit("cut short"))).otherwise(F.col("l_extendedprice"))
    try:
        write_partitions(lines.withColumn("l_extendedprice", broken.cast("double")), folder, "mes")
    except Exception as error:
        if "cut short" not in str(error):
            raise
    march = lines.where("mes = 3").withColumn("l_extendedprice", F.col("l_extendedprice") * 2)
    write_partitions(march, folder, "mes")
    write_partitions(lines.where("mes = 5 AND l_returnflag <> 'R'"), folder, "mes", emptied=[12])
    return _month_rows(read_partitions(spark, folder))


def tune_folds(spark, sf):
    """Parts and flags by their mean quantity, for each third of the orders held out: rows of the other thirds alone,
    and of other folds there."""
    lines = roles.table(spark, sf, "lineitem")
    outer, fold = (F.pmod(key, F.lit(of)).cast("int") for key, of in ((F.col("l_orderkey"), 3), (F.col("l_suppkey"), 4)))
    nested = demand.nested_encoding(lines, ["l_partkey", "l_returnflag"], "l_quantity", outer, fold, 3)
    return nested.withColumn("value", F.round("value", 9))


def tune_check(spark, sf):
    """A search over four forests on the training table: every point has an error in every fold, the best one won, and
    the errors are those of rows not seen (below the spread of the target, above nothing)."""
    table = _training(spark, sf)
    train, _ = demand.training_frame(table)
    model = demand.tune(train, trees=(2, 3), depths=(2, 4), folds=3)
    spread = train.agg(F.stddev(demand.LABEL)).first()[0]
    best, won = min(model.search, key=lambda tried: tried[1])[0], demand.winning_parameters(model)
    return model.transform(table).agg(
        F.count("prediction_raw").alias("filas"), F.lit(len(model.search)).cast("bigint").alias("puntos"),
        F.lit(sum(len(errors) for *_, errors in model.search)).cast("bigint").alias("errores"),
        F.lit(won == {name: best[name] for name in won}).alias("gana_el_mejor"),
        F.lit(all(0 < e <= 1.2 * spread for *_, errors in model.search for e in errors)).alias("errores_posibles"))


def sample_orders(spark, sf):
    """A fifth of the orders, 500 at most, chosen by the smallest hashes."""
    return ranking.sample_rows(roles.table(spark, sf, "orders"), 0.2, 500, 42, ["o_orderkey"]).select("o_orderkey", "o_custkey")


def sample_parts(spark, sf):
    """A fifth of the parts: all with hashes in the lowest fifth, no limit in the way."""
    parts = roles.table(spark, sf, "part")
    return ranking.sample_rows(parts, 0.2, parts.count(), 7, ["p_partkey"]).select("p_partkey", "p_name")


def catalogue_without_model(spark, sf):
    """What every client is shown where no model is stored: the first five products of the catalogue, unscored."""
    return recommend(None, _clients(spark, sf), _products(spark, sf)).select("Cliente", "Producto", "Precio_Caja", "puesto")


def importance_ranks(spark, sf):
    """The ten most important inputs: known names, in falling order."""
    rows = feature_importance(spark, sf).select("feature", "importance", F.row_number().over(
        Window.orderBy(F.desc("importance"), "feature")).alias("r"))  # ten rows
    known = [*(f"{c}_Media" for c in ENCODED), *(f"{c}_Index" for c in INDEXED), *NUMERIC]
    return rows.agg(F.count("*").alias("filas"), F.countDistinct("feature").alias("distintas"),
                    F.bool_and(F.col("feature").isin(known) & F.col("importance").between(0, 1)).alias("validas"))


def wide_report_file(spark, sf):
    """The wide month report written as a file with its irregular header, read back, and unpivoted."""
    folder = _fresh_folder(spark, "wide")
    write_csv(roles.month_report(_cells(spark, sf), "units", "product"), folder, ",")
    long = reshape.unpivot_months(read_csv(spark, folder, sep=","), ["Zona", "Producto"], "Meta_Zona_Cajas", "Venta_PY_Zona_Cajas")
    return renaming.cast_columns(long, ["Meta_Zona_Cajas", "Venta_PY_Zona_Cajas"], "double")


def block_report_file(spark, sf):
    """The product report written as a file with header rows and read as a block report."""
    folder = _fresh_folder(spark, "report")
    report = roles.block_report(_year_cells(spark, sf), "product")
    write_csv(report.withColumnsRenamed({c: f"c{i}" if i else "Producto" for i, c in enumerate(report.columns)}),
              folder, ";")
    return read_block_report(spark, folder, ";")


def _year_cells(spark: SparkSession, sf: str) -> DataFrame:
    return stage(roles.year_cells(spark, sf), "year_cells")


def zone_context_row(spark, sf):
    """Zone context of reports cleaned while wide: one bad month removes its row. Reports by family, of which some rows
    have all their months."""
    return _zone_context(_cells(spark, sf), "row", "family")


def family_context_row(spark, sf):
    """Family context of reports cleaned while wide."""
    return _family_context(_cells(spark, sf), "row")


def encoded_categories(spark, sf):
    """Parts and flags by the smoothed mean quantity of their rows in other folds."""
    lines = roles.table(spark, sf, "lineitem")
    return demand.target_encoding(lines, ["l_partkey", "l_returnflag"], "l_quantity",
                                  F.pmod("l_orderkey", F.lit(5)).cast("int")).withColumn("value", F.round("value", 9))


def zone_clients(spark, sf):
    return aggregates.zone_clients(_enriched(spark, sf))


def zone_options(spark, sf):
    return ranking.zone_options(_enriched(spark, sf))


def client_options(spark, sf):
    return ranking.client_options(_enriched(spark, sf))


def client_dim(spark, sf):
    return ranking.client_dimension(_enriched(spark, sf))


def client_main_zone(spark, sf):
    """Clients whose sales lie in several zones: the zone of each sale is its supplier's."""
    suppliers = roles.table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"),
                                                          F.col("s_nationkey").alias("n_nationkey"))
    nations = roles.table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("Nombre_Zona"),
                                                      F.col("n_regionkey").alias("r_regionkey"))
    regions = roles.table(spark, sf, "region").select("r_regionkey", F.col("r_name").alias("Region"))
    lines = lookup_join(roles.sold_lines(spark, sf, ["l_suppkey"]), suppliers, ["l_suppkey"], "inner")
    placed = lookup_join(lookup_join(lines, nations, ["n_nationkey"], "inner"), regions, ["r_regionkey"], "inner")
    return ranking.client_dimension(placed.withColumnRenamed("c_name", "Cliente"))


def training_split(spark, sf):
    """The split that training uses: every row in one part, about a fifth held out."""
    train, test = demand.training_frame(_training(spark, sf))
    parts = train.select(F.lit(1).alias("train")).unionByName(test.select(F.lit(0).alias("train")))
    return parts.agg(F.count("*").alias("filas"), F.avg("train").between(0.75, 0.85).alias("cuatro_quintos"))


def catalogue(spark, sf):
    return ranking.catalogue(_training(spark, sf), 50)


def candidate_grid(spark, sf):
    return _grid(spark, sf)


def top_n_per_client(spark, sf):
    return _top(spark, sf, 5).select("Cliente", "Producto", "Precio_Caja", "prediction_final",
                                     "prediction_piezas", "ingreso_estimado", "puesto")


def recommendation_summary(spark, sf):
    by_client = aggregates.recommendation_summary(_top(spark, sf, 5), ["Cliente"])
    return by_client.withColumns({"ingreso_total": F.round("ingreso_total", 2),
                                  "precio_promedio": F.round("precio_promedio", 6)})


def revenue_ranking(spark, sf):
    return ranking.rank_by_revenue(_top(spark, sf, 5)).select("Cliente", "Producto",
                                                              "ingreso_estimado")


def price_scenarios(spark, sf):
    return _fixed_scenarios(spark, sf)


def discount_scenario(spark, sf):
    parts = roles.table(spark, sf, "part").select(
        F.col("p_partkey").alias("Producto"), F.col("p_retailprice").alias("Precio_Caja"),
        F.col("p_size").alias("tamano"))
    return _fixed_demand(scenarios.discount_scenario(parts))


def best_price(spark, sf):
    return scenarios.best_price(_fixed_scenarios(spark, sf), ["Producto", "precio_base"])


def bias_factor(spark, sf):
    return aggregates.bias_factor(_fixed_prediction(spark, sf), "actual", "predicted")


def error_metrics(spark, sf):
    measures = aggregates.error_metrics(_fixed_prediction(spark, sf), "actual", "predicted")
    return measures.withColumns({c: F.round(c, 6) for c in measures.columns if c != "biased"})


def residual_histogram(spark, sf):
    bins = aggregates.residual_histogram(_fixed_prediction(spark, sf), "actual", "predicted")
    return bins.withColumns({c: F.round(c, 6) for c in ("bin_from", "bin_to")})


def split_by_hash(spark, sf):
    return ranking.split_by_key(roles.table(spark, sf, "orders").select("o_orderkey"), "o_orderkey")


def normalise_text_query(spark, sf):
    return roles.table(spark, sf, "documents").select("doc_id", normalise_text("text").alias("texto"))


def _labels(spark, sf):
    """Seller labels with one dash, two dashes and none."""
    nations = roles.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"),
                                                      "n_name")
    customers = lookup_join(roles.table(spark, sf, "customer"), nations, ["c_nationkey"], "inner")
    label = (F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("Venta - "), "n_name"))
             .when(F.col("c_custkey") % 3 == 1, F.concat(F.lit("Venta - "), "n_name", F.lit(" - X")))
             .otherwise(F.concat(F.lit("Venta "), "n_name")))
    return customers.select("c_custkey", label.alias("vendedor"))


def zone_code_query(spark, sf):
    return _labels(spark, sf).withColumn("zona", zone_code("vendedor"))


def family_key_query(spark, sf):
    return roles.table(spark, sf, "part").select("p_partkey", family_key("p_name").alias("familia"))


def unit_price_query(spark, sf):
    boxes = F.col("l_quantity") - 1  # some lines without boxes
    return roles.table(spark, sf, "lineitem").select(
        *KEYS, "l_extendedprice", unit_price("l_extendedprice", boxes).alias("precio_caja")
    ).withColumn("precio_pieza", piece_price("precio_caja"))


def pieces_query(spark, sf):
    return roles.table(spark, sf, "lineitem").select(
        *KEYS, pieces(F.col("l_quantity").cast("int")).alias("piezas"))


def log_target_query(spark, sf):
    rows = roles.table(spark, sf, "lineitem").select(*KEYS, log_target("l_quantity").alias("log"))
    return rows.select(*KEYS, F.round("log", 9).alias("log_venta"),
                       F.round(inverse_log("log"), 9).alias("venta"))


def month_dim(spark, sf):
    codes = roles.table(spark, sf, "lineitem").select(month_code(F.month("l_shipdate")).alias("mes"))
    return aggregates.group_count(codes, "mes").select(
        "mes", month_number("mes").alias("mes_num"), F.col("count").alias("lineas"))


def elasticity_class_query(spark, sf):
    base = F.col("p_size") * 1000
    new = F.col("p_size") * (1000 + (F.pmod("p_partkey", F.lit(7)) - 2) * 5)
    return roles.table(spark, sf, "part").select(
        "p_partkey", base.alias("base"), new.alias("nueva"),
        elasticity_class(base, new).alias("clase"))


def indexed_categories(spark, sf):
    return category_index(_enriched(spark, sf), ["Cliente", "Producto", "Nombre_Zona", "Region",
                                                 "Mes"])


# --- model queries ----------------------------------------------------------

def rf_predictions(spark, sf):
    model, table = _model(spark, sf)
    return model.transform(table).select("Cliente", "Producto", "Mes", "Venta_Cajas",
                                         "prediction", "prediction_raw")


def calibrated(spark, sf):
    model, table = _model(spark, sf)
    return model.transform(table).select("Cliente", "Producto", "Mes", "Venta_Cajas",
                                         "prediction_final", "prediction_piezas")


def model_error(spark, sf):
    model, table = _model(spark, sf)
    _, test = demand.training_frame(table)
    return demand.evaluate(model, test)


def feature_importance(spark, sf):
    model, table = _model(spark, sf)
    return demand.feature_importance(model, model.transform(table).schema)


def recommend_top_n(spark, sf):
    model, _ = _model(spark, sf)
    return recommend(model, _clients(spark, sf), _products(spark, sf))


def best_price_model(spark, sf):
    model, _ = _model(spark, sf)
    return best_prices(model, _clients(spark, sf), _products(spark, sf))


def best_price_exact(spark, sf):
    model, _ = _model(spark, sf)
    return best_exact_prices(model, _clients(spark, sf), _products(spark, sf))


def price_curve_model(spark, sf):
    model, _ = _model(spark, sf)
    top = recommend(model, _clients(spark, sf), _products(spark, sf), n=1, means=True)
    return price_curve(model, top)


def discount_test_model(spark, sf):
    model, _ = _model(spark, sf)
    return discount_test(model, recommend(model, _clients(spark, sf), _products(spark, sf), n=1, means=True))


def model_index(spark, sf):
    """The labels and indices of the model's own index stage."""
    fitted = demand.index_stages().fit(_training(spark, sf))
    rows = [(c, label, float(i)) for c, labels in zip(INDEXED, fitted.labelsArray) for i, label in enumerate(labels)]
    return spark.createDataFrame(rows, "column string, label string, index double")


# --- what holds for any model, for which there is SQL -------------------------

def _close(a, b):
    return F.abs(a - b) <= 1e-9 * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))


def recommend_check(spark, sf):
    """Every client has its rows: ranks, distinct products of the catalogue, income from price and demand."""
    known = _products(spark, sf).select("Producto", F.lit(1).alias("known"))
    top = recommend_top_n(spark, sf).join(known, "Producto", "left")
    income = _close(F.col("ingreso_estimado"), F.col("Precio_Caja") * F.col("prediction_final"))
    return top.groupBy("Cliente").agg(
        F.count("*").alias("filas"), F.sum("puesto").alias("suma_puestos"),
        F.countDistinct("Producto").alias("productos"), F.count("known").alias("en_catalogo"),
        F.count_if(income).alias("ingresos_bien"))


def best_price_exact_check(spark, sf):
    """Every client's exact best price lies in its range, brings the income of its demand, and no whole per cent of
    change brings more."""
    model, _ = _model(spark, sf)
    top = stage(recommend(model, _clients(spark, sf), _products(spark, sf), n=1, means=True), "first_choices")
    steps = price_curve(model, top, step=1).groupBy("Cliente").agg(
        F.count("*").alias("pasos"), F.max("ingreso_estimado").alias("mejor_paso"))
    income, price = F.col("ingreso_optimo"), F.col("precio_optimo")
    inside = (price >= F.col("precio_base") * 0.7 - 1e-9) & (price <= F.col("precio_base") * 1.3 + 1e-9)
    return exact_price(model, top).join(steps, "Cliente", "left").groupBy("Cliente").agg(
        F.count("*").alias("filas"), F.max("pasos").alias("pasos"), F.count_if(inside).alias("en_rango"),
        F.count_if(_close(income, price * F.col("demanda_optima"))).alias("ingresos_bien"),
        F.count_if((income >= F.col("mejor_paso")) | _close(income, F.col("mejor_paso"))).alias("no_menos"))


def price_curve_check(spark, sf):
    """Every client has every price change once, at the price it stands for."""
    right = _close(F.col("Precio_Caja") * 100, F.col("precio_base") * (F.col("ajuste") + 100))
    return price_curve_model(spark, sf).groupBy("Cliente").agg(
        F.count("*").alias("escenarios"), F.countDistinct("ajuste").alias("ajustes"),
        F.min("ajuste").cast("bigint").alias("desde"), F.max("ajuste").cast("bigint").alias("hasta"),
        F.count_if(right).alias("precios_bien"))


def discount_check(spark, sf):
    """Every client once, at nine tenths of its price, with the change that the two demands make."""
    right = _close(F.col("Precio_Caja") * 10, F.col("precio_base") * 9) & _close(
        F.col("cambio_pct") * F.col("demanda_base"), (F.col("demanda_nueva") - F.col("demanda_base")) * 100)
    return discount_test_model(spark, sf).groupBy("Cliente").agg(F.count("*").alias("filas"),
                                                                 F.count_if(right).alias("bien"))


def calibration_check(spark, sf):
    """Calibrated on the sales of even months, predictions add up to the sales there."""
    model, table = _model(spark, sf)
    part = table.where("Mes_Num % 2 = 0")
    rows = demand.calibrate(model_without_factor(model), part).transform(part)
    return rows.agg(F.count("*").alias("filas"), F.sum("Venta_Cajas").alias("cajas"),
                    _close(F.sum("prediction_final"), F.sum("Venta_Cajas").cast("double")).alias("iguales"))


def model_without_factor(model: demand.DemandModel) -> demand.DemandModel:
    return replace(model, pipeline=PipelineModel(model.stages[:-1]))


def importance_check(spark, sf):
    """The inputs of the model by name, and that their importances make up the whole."""
    rows = feature_importance_all(spark, sf)
    return rows.agg(F.count("*").alias("entradas"), _close(F.sum("importance"), F.lit(1.0)).alias("suma_uno"),
                    F.array_join(F.sort_array(F.collect_list("feature")), ",").alias("nombres"))


def feature_importance_all(spark, sf):
    model, table = _model(spark, sf)
    return demand.feature_importance(model, model.transform(table).schema,
                                     len(INDEXED) + len(ENCODED) + len(NUMERIC))


def model_reload_check(spark, sf):
    """The stored model predicts what the live one does, on every sale."""
    model, table = _model(spark, sf)
    folder = _fresh_folder(spark, "model")
    model.save(folder)
    live = model.transform(table).withColumn("live", F.col("prediction_final")).select(*table.columns, "live")
    both = demand.load_model(spark, folder).transform(live)
    return both.agg(F.count("*").alias("filas"), F.count_if(F.col("live") == F.col("prediction_final")).alias("iguales"))


QUERIES = {
    "sales_standardised": sales_standardised,
    "block_rename": block_rename,
    "cast_metrics": cast_metrics,
    "drop_empty_rows": drop_empty_rows,
    "drop_incomplete_rows": drop_incomplete_rows,
    "fill_defaults": fill_defaults,
    "null_profile": null_profile,
    "clean_sales": clean_sales,
    "clean_audit": clean_audit,
    "positive_sales": positive_sales,
    "clamp_returns": clamp_returns,
    "outlier_trim": outlier_trim,
    "sales_geo": sales_geo,
    "sales_enriched": sales_enriched,
    "zone_targets_long": zone_targets_long,
    "zone_context": zone_context,
    "sales_zone_context": sales_zone_context,
    "family_context": family_context,
    "ml_dataset": ml_dataset,
    "report_long": report_long,
    "report_wide": report_wide,
    "report_union": report_union,
    "annual_totals": annual_totals,
    "master_sales": master_sales,
    "customer_features": customer_features,
    "sales_annual_context": sales_annual_context,
    "join_audit": join_audit_query,
    "dup_keys": dup_keys,
    "group_count": group_count,
    "file_drop_ingest": file_drop_ingest,
    "zone_clients": zone_clients,
    "zone_options": zone_options,
    "client_options": client_options,
    "client_dim": client_dim,
    "catalogue": catalogue,
    "candidate_grid": candidate_grid,
    "top_n_per_client": top_n_per_client,
    "recommendation_summary": recommendation_summary,
    "revenue_ranking": revenue_ranking,
    "price_scenarios": price_scenarios,
    "discount_scenario": discount_scenario,
    "best_price": best_price,
    "bias_factor": bias_factor,
    "error_metrics": error_metrics,
    "residual_histogram": residual_histogram,
    "split_by_hash": split_by_hash,
    "normalise_text": normalise_text_query,
    "zone_code": zone_code_query,
    "family_key": family_key_query,
    "unit_price": unit_price_query,
    "pieces": pieces_query,
    "log_target": log_target_query,
    "month_dim": month_dim,
    "elasticity_class": elasticity_class_query,
    "indexed_categories": indexed_categories,
    "rf_predictions": rf_predictions,
    "calibrated": calibrated,
    "model_error": model_error,
    "feature_importance": feature_importance,
    "recommend_top_n": recommend_top_n,
    "best_price_model": best_price_model,
    "best_price_exact": best_price_exact,
    "best_price_exact_check": best_price_exact_check,
    "price_curve_model": price_curve_model,
    "discount_test_model": discount_test_model,
    "recommend_check": recommend_check,
    "price_curve_check": price_curve_check,
    "discount_check": discount_check,
    "calibration_check": calibration_check,
    "importance_check": importance_check,
    "model_reload_check": model_reload_check,
    "csv_roundtrip": csv_roundtrip,
    "json_roundtrip": json_roundtrip,
    "parquet_by_month": parquet_by_month,
    "block_report_file": block_report_file,
    "zone_context_row": zone_context_row,
    "family_context_row": family_context_row,
    "encoded_categories": encoded_categories,
    "model_index": model_index,
    "client_main_zone": client_main_zone,
    "training_split": training_split,
    "input_report": input_report,
    "ml_dataset_colocated": ml_dataset_colocated,
    "months_rewritten": months_rewritten,
    "tune_folds": tune_folds,
    "tune_check": tune_check,
    "sample_orders": sample_orders,
    "sample_parts": sample_parts,
    "catalogue_without_model": catalogue_without_model,
    "importance_ranks": importance_ranks,
    "wide_report_file": wide_report_file,
    "file_drop_once": file_drop_once,
    "customer_features_stored": customer_features_stored,
    "annual_totals_stored": annual_totals_stored,
    "quantiles_stored": quantiles_stored,
    "outlier_trim_sketch": outlier_trim_sketch,
}
