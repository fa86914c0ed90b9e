import pytest
from pyspark.sql import functions as F

from conftest import values
from salesflow.names import CATALOGUE_COLUMNS
from salesflow.operators import ranking as r, scenarios as s

SCHEMA = ("Cliente string, Region string, Nombre_Zona string, Producto string, "
          "Precio_Caja double, ID_Articulo string, Venta_PY_Zona_Cajas double, "
          "Venta_PY_Familia_Cajas double, Meta_Zona_Cajas double, Precio_Promedio_PY_Caja double")


@pytest.fixture
def table(spark):
    rows = [("A", "R2", "Z2", "p1", 5.0, "1", 10.0, 1.0, 1.0, 1.0),
            ("A", "R1", "Z9", "p1", 4.0, "1", 10.0, 1.0, 1.0, 1.0),
            ("B", "R1", "Z1", "p1", 1.0, "1", 9.0, 1.0, 1.0, 1.0),
            ("B", "R1", "Z1", "p2", 3.0, "2", 20.0, 2.0, 2.0, 2.0),
            ("B", "R1", "Z1", "p2", 3.0, "1", 20.0, 2.0, 2.0, 2.0),
            ("C", None, None, "p3", 7.0, "3", 10.0, 3.0, 3.0, 3.0),
            (None, "R1", "Z1", "p4", 7.0, "4", 0.0, 3.0, 3.0, 3.0)]
    return spark.createDataFrame(rows, SCHEMA)


def test_catalogue_keeps_the_best_row_per_product(table):
    got = [(x.Producto, x.Precio_Caja, x.ID_Articulo) for x in r.catalogue(table).collect()]
    assert got == [("p2", 3.0, "1"), ("p1", 4.0, "1"), ("p3", 7.0, "3"), ("p4", 7.0, "4")]
    assert r.catalogue(table, 2).count() == 2
    assert r.catalogue(table).columns == CATALOGUE_COLUMNS
    with pytest.raises(ValueError):
        r.catalogue(table, 0)


def test_client_dimension_has_one_row_each(table):
    assert values(r.client_dimension(table)) == [("A", "R1", "Z9"), ("B", "R1", "Z1"),
                                                 ("C", None, None)]
    assert values(r.client_context(table, "B")) == [("B", "R1", "Z1")]
    assert r.client_context(table, "nobody").count() == 0


def test_pickers(table):
    assert [x.zona for x in r.zone_options(table).collect()] == ["Todas", "Z1", "Z2", "Z9"]
    assert [x.Cliente for x in r.client_options(table, "Z1").collect()] == ["B", None]
    assert [x.Cliente for x in r.client_options(table, "Todas").collect()] == ["A", "B", "C", None]


def test_grid_pairs_every_client_with_the_catalogue(table):
    grid = s.candidate_grid(r.client_dimension(table), r.catalogue(table, 2), "NOV")
    assert values(grid.select("Cliente", "Producto", "Mes", "Mes_Num")) == [
        (c, p, "NOV", 11) for c in "ABC" for p in ("p1", "p2")]
    plan = grid._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_top_n_breaks_ties_and_limits_before_the_shuffle(spark):
    rows = [("A", "x", 1.0), ("A", "w", 2.0), ("A", "v", 1.0), ("B", "u", 0.5)]
    df = spark.createDataFrame(rows, "Cliente string, Producto string, prediction_final double")
    got = r.top_n_per_client(df, 2)
    assert values(got.select("Cliente", "Producto", "puesto")) == [("A", "v", 2), ("A", "w", 1),
                                                                   ("B", "u", 1)]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_grid_top_n_needs_one_shuffle(table):
    grid = s.candidate_grid(r.client_dimension(table), r.catalogue(table, 2))
    top = r.top_n_per_client(grid.withColumn("prediction_final", F.col("Precio_Caja")), 1)
    top.collect()
    plan = top._jdf.queryExecution().executedPlan().toString()
    window = plan[:plan.index("Generate")]
    assert "Exchange" not in window


def test_grid_of_few_files_is_dealt_before_it_unfolds(spark, table):
    grid = s.candidate_grid(r.client_dimension(table).coalesce(1), r.catalogue(table, 2))
    assert grid.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_scenarios_and_best_price(spark):
    top = spark.createDataFrame([("A", "p", 10.0), ("B", "q", 0.0)],
                                "Cliente string, Producto string, Precio_Caja double")
    rows = s.price_scenarios(top)
    assert rows.filter("Cliente = 'A'").count() == 13
    assert [x.Precio_Caja for x in rows.filter("Cliente = 'A' and ajuste in (-30, 0, 30)")
            .orderBy("ajuste").collect()] == [7.0, 10.0, 13.0]
    assert values(s.discount_scenario(top).select("Cliente", "Precio_Caja", "ajuste")) == [
        ("A", 9.0, -10), ("B", 0.0, -10)]
    flat = s.with_revenue(rows.withColumn("prediction_final", F.lit(2.0) * 10 / F.col("Precio_Caja"))
                          .filter("Cliente = 'A'").withColumn("prediction_final", F.lit(3.0)))
    best = s.best_price(flat, ["Cliente", "Producto"]).first()
    assert (best.ajuste, best.estrategia, best.ingreso_base) == (30, "raise", 30.0)
    assert best.mejora_pct == 30.0
    level = s.best_price(rows.withColumn("ingreso_estimado", F.lit(5.0))
                         .withColumn("prediction_final", F.lit(1.0)), ["Cliente"])
    assert {x.ajuste for x in level.collect()} == {-30}  # a tie goes to the lowest change
    nothing = s.best_price(rows.withColumn("ingreso_estimado", F.lit(0.0))
                           .withColumn("prediction_final", F.lit(0.0)), ["Cliente"])
    assert nothing.first().mejora_pct is None


def test_samples_and_splits(spark):
    df = spark.range(1000)
    assert r.sample_rows(df, 0.5, 100).count() == 100
    assert values(r.sample_rows(df)) == values(r.sample_rows(df))
    a, b = r.split(df)
    assert a.count() + b.count() == 1000 and a.intersect(b).count() == 0
    for parts in (r.split_by_hash(df), r.split_by_hash(df.repartition(7))):
        sizes = [p.count() for p in parts]
        assert sum(sizes) == 1000 and 150 < sizes[1] < 250
    assert values(r.split_by_hash(df)[1]) == values(r.split_by_hash(df.repartition(7))[1])
    assert r.split_by_key(df, "id").filter("parte = 'test'").count() == 200
    assert [x.ingreso_estimado for x in r.rank_by_revenue(
        df.limit(3).selectExpr("id as ingreso_estimado", "id as Producto", "id as Cliente")).collect()] == [2, 1, 0]
