from conftest import values
from salesflow.names import MONTH_CODES, block_labels, month_headers
from salesflow.operators import reshape as r
from salesflow.operators.aggregates import annual_totals
from salesflow.operators.renaming import rename_blocks


def wide(spark, rows):
    columns = ["Zona", "Producto"] + [h for _, t, p in month_headers() for h in (t, p)]
    return spark.createDataFrame(rows, ", ".join(f"`{c}` string" for c in columns))


def test_month_headers_are_irregular():
    headers = {code: (t, p) for code, t, p in month_headers()}
    assert headers["ENE"] == ("Enero _TGT ", "Enero _PY 24")
    assert headers["JUN"] == ("Junio_TGT ", "Junio_PY 24")


def test_unpivot_keeps_nulls(spark):
    cells = [str(i) for i in range(24)]
    cells[0], cells[5] = None, "bad"
    got = r.unpivot_months(wide(spark, [("A - Z1", "P", *cells)]), ["Zona", "Producto"], "t", "p")
    rows = {x.Mes_Corto: (x.t, x.p) for x in got.collect()}
    assert list(rows) == MONTH_CODES
    assert rows["ENE"] == (None, 1.0) and rows["MAR"] == (4.0, None) and rows["DIC"] == (22.0, 23.0)


def block(spark, rows):
    width = 1 + len(block_labels()) + 1
    full = [tuple(row) + (None,) * (width - len(row)) for row in rows]
    raw = spark.createDataFrame(full, ", ".join(f"_c{i} string" for i in range(width)))
    return rename_blocks(raw)


def test_long_route_and_direct_route_agree(spark):
    report = block(spark, [["a", "1", "2", "3", "4%", "5", None, "7", "8"],
                           ["Producto", "Venta"], ["b", None, "2"]])
    long = r.split_label(r.unpivot_all(report.filter("Producto_Familia != 'Producto'")))
    assert long.filter("Mes = ''").count() == 0  # the spare column is gone
    routed = r.type_metrics(r.pivot_metrics(long)).selectExpr("*", "'Producto' as Nivel")
    direct = r.reshape_report(report, "Producto")
    assert routed.columns == direct.columns
    assert values(routed) == values(direct)
    assert ("a", "ENERO", 1.0, 2.0, 3.0, 0.0, "Producto") in values(direct)


def test_spare_columns_can_be_kept(spark):
    long = r.split_label(r.unpivot_all(block(spark, [["a", "1"]])), keep_unmatched=True)
    assert long.filter("Mes = ''").count() == 1


def test_narrow_report_has_fewer_months(spark):
    raw = spark.createDataFrame([("a", "1", "2", "3", "4", "5")],
                                ", ".join(f"_c{i} string" for i in range(6)))
    rows = r.reshape_report(rename_blocks(raw), "Familia").collect()
    assert {x.Mes: (x.Venta, x.TGT) for x in rows} == {"ENERO": (1.0, 2.0), "FEBRERO": (5.0, 0.0)}


def test_union_and_annual_totals_skip_the_running_block(spark):
    cells = ["1", "10", "100", "50"] * 13
    both = r.reshape_both(block(spark, [["x", *cells]]), block(spark, [["x", *cells]]))
    assert both.count() == 26
    totals = annual_totals(both).collect()
    assert {(t.Nivel, t.Venta_Total_Anual, t.pct_Promedio) for t in totals} == {
        ("Familia", 12.0, 50.0), ("Producto", 12.0, 50.0)}
    assert annual_totals(both, exclude=()).first().Venta_Total_Anual == 13.0


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("x", 1)], "k string, only_a int")
    b = spark.createDataFrame([("y",)], "k string")
    assert values(r.union_levels(a, b)) == [("x", 1), ("y", None)]
