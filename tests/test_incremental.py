import pytest
from pyspark.sql import functions as F

from conftest import values
from salesflow.operators import incremental as inc
from salesflow.operators.aggregates import annual_totals, customer_features
from salesflow.sources.partitions import read_partitions

SALES = "`Nombre Cliente` string, Producto string, MES string, `MES NUM` double, `2025` double, CANTIDAD double"


@pytest.fixture
def sales(spark):
    rows = [(None if i % 17 == 0 else f"c{i % 6}", None if i % 5 == 0 else "p", f"M{i % 4}", float(i % 4), None if i % 11 == 0 else
             i / 7, None if i % 13 == 0 else float(i % 9)) for i in range(200)] + [("only nulls", None, "M1", None, None, None)]
    return spark.createDataFrame(rows, SALES)


def test_features_month_by_month(spark, sales, tmp_path):
    path = str(tmp_path / "f")
    for month in ("M0", "M1", "M2"):
        inc.update_client_features(sales.where(F.col("MES") == month), path)
    assert values(inc.stored_client_features(spark, path)) == values(customer_features(sales.where("MES <> 'M3'")))
    inc.update_client_features(sales.where("MES = 'M3'").limit(0), path)
    inc.update_client_features(sales.where("MES >= 'M2'"), path)
    got = inc.stored_client_features(spark, path)
    assert got.schema.simpleString() == customer_features(sales).schema.simpleString()
    assert values(got) == values(customer_features(sales))
    assert values(inc.stored_client_features(spark, path, ["M0"])) == values(customer_features(sales.where("MES = 'M0'")))
    inc.update_client_features(sales.limit(0), path, emptied=["M0"])
    assert values(inc.stored_client_features(spark, path)) == values(customer_features(sales.where("MES <> 'M0'")))
    assert read_partitions(spark, path).count() <= 7 * 3  # a row for each client and month


def test_annual_totals_month_by_month(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(f"p{i % 3}", "Producto" if i % 2 else "Familia", m, float(i), float(i * 2), None, float(i % 5))
                                  for i in range(30) for m in ("ENERO", "MARZO", "YTD_JUL")],
                                 "Producto_Familia string, Nivel string, Mes string, Venta double, TGT double, PY24 double, pct double")
    for month in ("ENERO", "MARZO", "ENERO"):
        inc.update_annual_totals(rows.where(F.col("Mes").isin(month, "YTD_JUL")), path)
    assert values(inc.stored_annual_totals(spark, path)) == values(annual_totals(rows))


def test_sketches_merge_over_any_range(spark, tmp_path):
    path, i = str(tmp_path / "q"), F.col("id")
    rows = spark.range(40_000, numPartitions=5).select((i % 12).alias("mes"), F.when(i % 50 == 0, None).when(
        i % 50 == 1, float("nan")).when(i % 3 == 0, 7.0).otherwise(F.pmod(F.xxhash64(i), F.lit(10_000)).cast("double")).alias("v"))
    inc.update_sketches(rows.where("mes < 6"), path, "v", "mes", 1024)
    inc.update_sketches(rows.where("mes >= 5"), path, "v", "mes", 1024)
    for p in (0.0, 0.2, 0.5, 0.99, 1.0):
        for months in (None, [3], [1, 4, 7]):
            own = rows.where("v IS NOT NULL AND NOT isnan(v)")
            own = own if months is None else own.where(F.col("mes").isin(months))
            q = inc.stored_quantile(spark, path, p, "mes", months, 1024)
            below, upto = own.agg(F.avg((F.col("v") < q).cast("double")), F.avg((F.col("v") <= q).cast("double"))).first()
            assert below - 2 * inc.rank_error(1024) <= p <= upto + 2 * inc.rank_error(1024)
    assert inc.stored_quantile(spark, path, 0.5, "mes", [99]) is None
    with pytest.raises(ValueError):
        inc.stored_quantile(spark, path, 1.5, "mes")
