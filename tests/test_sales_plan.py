from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import values
from fixtures import block, write_inputs
from salesflow.names import TRAINING_COLUMNS
from salesflow.operators import enrich
from salesflow.operators.cleaning import clean_dataset
from salesflow.plans import sales as plan
from salesflow.sources import read_block_report, read_csv


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    return plan.read_raw(spark, **write_inputs(tmp_path_factory.mktemp("raw")))


@pytest.fixture(scope="module")
def table(raw, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("out") / "training")
    return plan.build_training_table(raw, path, by_month=True)


def test_training_table_columns_and_rows(table):
    assert sorted(table.columns) == sorted(TRAINING_COLUMNS)
    assert table.count() == 6  # negative, malformed and empty rows are gone
    assert table.where(" or ".join(f"`{c}` is null" for c in TRAINING_COLUMNS if c not in (
        "Region", "Nombre_Zona", "Cliente", "ID_Articulo"))).count() == 0


def row(table, **where):
    for c, v in where.items():
        table = table.filter(F.col(c) == v)
    return table.first()


def test_a_sale_with_every_context(table):
    r = row(table, Cliente="CLINICA UNO", Mes="ENE")
    assert (r.Region, r.Nombre_Zona, r.Producto, r.ID_Articulo) == (
        "COSTA", "LIMA NORTE", "ELIPTIC PF", "101")
    assert (r.Venta_Cajas, r.Venta_Piezas_Reales, r.Precio_Caja, r.Precio_Unitario_Pieza) == (
        10, 200, 10.05, 0.5)
    assert (r.Meta_Zona_Cajas, r.Venta_PY_Zona_Cajas, r.Venta_PY_Zona_Valor) == (11, 10, 205)
    assert (r.Venta_PY_Zona_Piezas, r.Precio_Promedio_PY_Caja) == (200, 20.5)
    # Two families share the first word: they are added up, the sale is not repeated.
    assert (r.Meta_Familia_Cajas, r.Venta_PY_Familia_Cajas, r.Venta_PY_Familia_Valor) == (22, 20, 400)


def test_no_boxes_means_no_price(table):
    r = row(table, Cliente="CLINICA UNO", Mes="FEB")
    assert (r.Producto, r.Venta_Cajas, r.Precio_Caja) == ("GOTA N EXTRA", 0, 0.0)
    assert r.Meta_Zona_Cajas == 0  # units know the cell, values do not: inner join
    assert (r.Meta_Familia_Cajas, r.Meta_Familia_Valor) == (0, 9)  # outer join


def test_negative_cell_is_dropped_or_clamped(table):
    r = row(table, Cliente="BOTICA DOS", Mes="ENE")
    assert (r.Nombre_Zona, r.Meta_Zona_Cajas) == ("CUSCO", 0)


def test_unknown_product_zone_and_client_stay(table):
    r = row(table, Producto="OTRO")
    assert (r.Nombre_Zona, r.ID_Articulo, r.Precio_Caja) == (None, None, 10.0)
    assert row(table, Cliente="TRES").Region is None
    assert table.filter("Cliente is null").first().Producto == "SIN"


def test_row_policy_removes_the_whole_report_row(raw):
    r = row(plan.training_table(raw, policy="row"), Cliente="CLINICA UNO", Mes="ENE")
    assert r.Meta_Zona_Cajas == 0 and r.Venta_PY_Familia_Cajas == 20


def test_returns_can_count_as_zero(raw):
    got = plan.training_table(raw, negatives="zero").filter("Cliente = 'TRES'")
    assert sorted(r.Venta_Valor for r in got.collect()) == [0.0, 10.0]


def test_every_join_way_gives_the_same_table(raw, table):
    sales = clean_dataset(raw.sales, plan.SALES_TEXT, plan.SALES_METRICS)
    facts = enrich.sales_facts(sales)
    master = clean_dataset(raw.master, plan.MASTER_TEXT)
    usual = enrich.with_product(facts, master)
    shuffled = enrich.with_product(facts, master, limit=0)
    assert values(usual, *usual.columns) == values(shuffled, *usual.columns)
    assert usual.count() == facts.count()


def test_customer_dataset(spark, raw, tmp_path):
    header = ["Producto", "x"]
    family, product = tmp_path / "family.csv", tmp_path / "product.csv"
    family.write_text(block([header, ["ELIPTIC", "1", "2", "3", "4"]]))
    product.write_text(block([header, ["ELIPTIC", "10", "20", "30", "40%"],
                              ["ELIPTIC", "9", "8"], ["", "7"]]))
    sales = spark.createDataFrame(
        [("ELIPTIC", "A", 1, 10.0, 2), ("ELIPTIC", "A", 3, 5.0, 0), ("GOTA", "B", 2, 4.0, 4),
         ("GOTA", None, 2, 4.0, 4), ("SIN", "A", 9, 9.0, 9), ("GOTA", "B", 5, 0.0, 1)],
        "Producto string, `Nombre Cliente` string, `MES NUM` int, `2025` double, CANTIDAD int")
    complete, features = plan.customer_dataset(
        raw.master, sales, read_block_report(spark, str(family)),
        read_block_report(spark, str(product)), csv_path=str(tmp_path / "csv"), single_file=True)
    assert values(features) == [("A", 15.0, 2, 7.5, 1.0, 2, 3), ("B", 4.0, 4, 4.0, 4.0, 1, 2)]
    assert complete.count() == 4  # the name on both levels repeats nothing
    eliptic = complete.filter("Producto = 'ELIPTIC' and CANTIDAD = 2").first()
    assert (eliptic.Precio_Unitario, eliptic.Venta_Total_Anual, eliptic.Target_Total_Anual) == (
        5.0, 10.0, 20.0)
    assert complete.filter("Producto = 'GOTA'").first().Venta_Total_Anual is None
    back = read_csv(spark, str(tmp_path / "csv"), sep=";")
    assert back.count() == 4 and back.inputFiles().__len__() == 1


def test_months_are_updated_alone(spark, raw, table, tmp_path):
    path = str(tmp_path / "t")
    assert values(plan.update_training_table(raw, path).select(*table.columns)) == values(table)
    january = replace(raw, sales=raw.sales.where("MES = 'Ene' OR MES = 'ENE'").withColumn("CANTIDAD", F.lit("1")))
    got = plan.update_training_table(january, path)
    others = table.where("Mes <> 'ENE'")
    assert values(got.where("Mes <> 'ENE'").select(*table.columns)) == values(others)
    changed = got.where("Mes = 'ENE'")
    assert changed.count() > 0 and changed.where("Venta_Cajas <> 1").count() == 0


def test_contexts_side_by_side_give_the_same_table(raw, table):
    got = plan.training_table(raw, limit=-1, rows_per_bucket=1)
    assert values(got.select(*table.columns)) == values(table)
