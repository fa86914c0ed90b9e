"""The given tables in the roles of the sales data model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from salesflow.functions import exact_sum, family_key, month_code
from salesflow.names import SALES_METRICS, SALES_TEXT, month_headers
from salesflow.operators.cleaning import clean_dataset
from salesflow.operators.joins import lookup_join
from salesflow.session import files_stamp
from salesflow.sources import read_parquet

SELLER = "Línea - "
PRIOR_YEAR, CURRENT_YEAR = 2000, 2001
TARGET_GROWTH = 1.1


_schemas: dict[tuple, StructType] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. Its schema is read from the files once for each state of them, not at every use."""
    path = f"{sf}/{name}.parquet"
    key = (path, files_stamp(spark, path))
    if key not in _schemas:
        _schemas[key] = read_parquet(spark, path).schema
    return spark.read.schema(_schemas[key]).parquet(path)


def year_of(year: int) -> Column:
    """Range on the ship date, so that it reaches the scan."""
    date = F.col("l_shipdate")
    return ((date >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
            & (date < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz")))


def buyers(spark: SparkSession, sf: str) -> DataFrame:
    """Client and country of every order. Orders meet customers before they meet the line
    items: the larger side is then shuffled once."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"),
                                               F.col("o_custkey").alias("c_custkey"))
    customers = table(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    nations = table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    placed = lookup_join(orders, customers, ["c_custkey"], "inner")
    return lookup_join(placed, nations, ["c_nationkey"], "inner").select(
        "l_orderkey", "c_name", "n_name")


def sold_lines(spark: SparkSession, sf: str, columns: list[str],
               where: Column | None = None) -> DataFrame:
    lines = table(spark, sf, "lineitem")
    if where is not None:
        lines = lines.filter(where)
    lines = lines.select("l_orderkey", *columns)
    sizes = [table(spark, sf, t) for t in ("orders", "customer")]
    return lookup_join(lines, buyers(spark, sf), ["l_orderkey"], "inner", sized_by=sizes)


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sales as they arrive: one row per line item, returns with a negative sign."""
    sign = F.when(F.col("l_returnflag") == "R", -1.0).otherwise(1.0)
    month = F.month("l_shipdate")
    return sold_lines(spark, sf, ["l_partkey", "l_quantity", "l_extendedprice", "l_returnflag",
                                  "l_shipdate"]).select(
        F.concat(F.lit(SELLER), "n_name").alias("Vendedor"),
        F.col("c_name").alias("Nombre Cliente"),
        F.col("l_partkey").cast("string").alias("Producto"),
        month_code(month).alias("MES"), month.alias("MES NUM"),
        (F.col("l_extendedprice") * sign).alias("2025"),
        (F.col("l_quantity") * sign).alias("CANTIDAD"))


def clean_sales(spark: SparkSession, sf: str, negatives: str = "drop") -> DataFrame:
    return clean_dataset(raw_sales(spark, sf), SALES_TEXT, SALES_METRICS, negatives)


def geography(spark: SparkSession, sf: str) -> DataFrame:
    regions = table(spark, sf, "region").select(F.col("r_regionkey").alias("n_regionkey"),
                                                F.col("r_name").alias("region"))
    nations = table(spark, sf, "nation")
    return lookup_join(nations, regions, ["n_regionkey"]).select(
        F.col("n_name").alias("zone_code"), F.concat(F.lit("Zona "), "n_name").alias("zone_name"),
        "region")


def master(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.col("p_partkey").cast("string").alias("Producto"),
        F.col("p_name").alias("Descripcion"),
        F.col("p_partkey").cast("string").alias("Numero de articulo"))


def _with_part_name(spark: SparkSession, sf: str, lines: DataFrame) -> DataFrame:
    parts = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_name")
    return lookup_join(lines, parts, ["l_partkey"], "inner")


def month_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Prior-year units and values per country, product name and month.

    The one pass over the line items that all month reports are cut from. Units leave out
    returned lines and values leave out unprocessed ones, so each has cells the other lacks.
    """
    where = year_of(PRIOR_YEAR)
    lines = sold_lines(spark, sf, ["l_partkey", "l_quantity", "l_extendedprice", "l_returnflag",
                                   "l_shipdate"], where)
    flag = F.col("l_returnflag")
    return (_with_part_name(spark, sf, lines)
            .groupBy("n_name", "p_name", F.month("l_shipdate").alias("month")).agg(
                F.sum(F.when(flag != "R", F.col("l_quantity"))).alias("units"),
                exact_sum(F.when(flag != "N", F.col("l_extendedprice"))).alias("values")))


def month_report(cells: DataFrame, measure: str, level: str) -> DataFrame:
    """Wide report: per zone and product (or family), target and prior year per month.
    A cell without sales is null."""
    name = F.col("p_name") if level == "product" else family_key("p_name")
    total = F.sum if measure == "units" else exact_sum
    keys = [F.concat(F.lit(SELLER), "n_name").alias("Zona"), name.alias("Producto")]
    wide = cells.groupBy(*keys).pivot("month", list(range(1, 13))).agg(total(F.col(measure)))
    columns = []
    for i, (_, target_header, prior_header) in enumerate(month_headers(), start=1):
        columns += [(F.col(str(i)) * TARGET_GROWTH).alias(target_header),
                    F.col(str(i)).alias(prior_header)]
    return wide.select("Zona", "Producto", *columns)


def year_cells(spark: SparkSession, sf: str) -> DataFrame:
    """Whole boxes per product name, year and month of the two report years."""
    where = year_of(CURRENT_YEAR) | year_of(PRIOR_YEAR)
    lines = table(spark, sf, "lineitem").filter(where).select("l_partkey", "l_quantity", "l_shipdate")
    return (_with_part_name(spark, sf, lines)
            .groupBy("p_name", F.year("l_shipdate").alias("year"),
                     F.month("l_shipdate").alias("month"))
            .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("boxes")))


def block_report(cells: DataFrame, level: str) -> DataFrame:
    """Block report as text cells named ``_c0``...: id, then sales, target, prior year and
    percentage for twelve months and the running half year. Product reports write the
    percentage with a sign that is no number."""
    name = F.col("p_name") if level == "product" else family_key("p_name")
    sums = []
    for b in range(1, 14):
        inside = F.col("month") == b if b <= 12 else F.col("month") <= 7
        for tag, year in (("s", CURRENT_YEAR), ("p", PRIOR_YEAR)):
            sums.append(F.sum(F.when(inside & (F.col("year") == year), F.col("boxes")))
                        .alias(f"{tag}{b}"))
    wide = cells.groupBy(name.alias("_c0")).agg(*sums)
    columns, sign = [F.col("_c0")], "%" if level == "product" else ""
    for b in range(1, 14):
        target = F.expr(f"p{b} + p{b} div 10")
        percent = F.concat(F.expr(f"(100 * s{b}) div (p{b} + p{b} div 10)").cast("string"),
                           F.lit(sign))
        for cell in (F.col(f"s{b}"), target, F.col(f"p{b}"), percent):
            columns.append(cell.cast("string").alias(f"_c{len(columns)}"))
    return wide.select(*columns)
