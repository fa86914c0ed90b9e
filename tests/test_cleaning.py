import pytest
from pyspark.sql import Observation

from conftest import values
from salesflow.operators import cleaning as c
from salesflow.operators.renaming import (cast_columns, metric_columns, rename_blocks,
                                          standardise)

ROWS = [("Ñuñoa ", "10.5", "3"), (None, None, None), ("a", None, "1"), ("b", "-4", "2"),
        ("c", "12%", "1"), ("d", "0", "0"), (None, "7", "1")]


@pytest.fixture
def raw(spark):
    return spark.createDataFrame(ROWS, "name string, `2025` string, CANTIDAD string")


def test_clean_dataset_drops_bad_rows(raw):
    got = c.clean_dataset(raw, ["name", "absent"], ["2025", "CANTIDAD", "absent"])
    assert values(got) == [("D", 0.0, 0.0), ("NUNOA", 10.5, 3.0), (None, 7.0, 1.0)]


def test_clean_dataset_zero_keeps_returns(raw):
    got = c.clean_dataset(raw, ["name"], ["2025", "CANTIDAD"], negatives="zero")
    assert ("B", 0.0, 2.0) in values(got) and got.count() == 4
    with pytest.raises(ValueError):
        c.clean_dataset(raw, negatives="maybe")


def test_clean_dataset_without_metrics_only_drops_empty(raw):
    assert c.clean_dataset(raw, ["name"]).count() == 6


def test_audit_agrees_with_observation(raw):
    seen = Observation("audit")
    c.clean_dataset(raw, [], ["2025", "CANTIDAD"], observe=seen).collect()
    audit = c.clean_audit(raw, ["2025", "CANTIDAD"]).first()
    assert tuple(audit) == (7, 3, 4)
    assert seen.get == {"initial_rows": 7, "final_rows": 3}


def test_nan_alone_is_an_empty_row(spark):
    df = spark.createDataFrame([(float("nan"), None), (1.0, None)], "a double, b string")
    assert c.drop_empty(df).count() == 1
    assert c.clean_audit(df).first().final_rows == 1


def test_incomplete_fill_and_clamp(spark):
    df = spark.createDataFrame([(1, None, "x"), (-2, -3.5, None)], "a int, b double, s string")
    assert c.drop_incomplete(df).count() == 0
    assert values(c.fill_nulls(c.fill_nulls(df, 0), "?")) == [(-2, -3.5, "?"), (1, 0.0, "x")]
    clamped = c.clamp_non_negative(df, ["a", "b"])
    assert values(clamped) == [(0, 0.0, None), (1, None, "x")]
    assert clamped.schema["a"].dataType.simpleString() == "int"


def test_positive_sales(raw):
    typed = cast_columns(raw, ["2025"], "double")
    assert c.positive_sales(typed).count() == 2
    assert c.positive_sales(typed, described="name").count() == 1


def test_trim_outliers(spark):
    df = spark.range(1, 101).selectExpr("cast(id as double) x")
    assert c.trim_outliers(df, "x", 0.99, exact=True).count() == 99
    assert 98 <= c.trim_outliers(df, "x", 0.99).count() <= 99


def test_cast_columns_nulls_malformed(spark):
    df = spark.createDataFrame([("12%",), ("7.9",), (" 5 ",), (None,)], "x string")
    assert [r.x for r in cast_columns(df, ["x"], "double").collect()] == [None, 7.9, 5.0, None]
    assert [r.x for r in cast_columns(df, ["x"], "int").collect()] == [None, 7, 5, None]


def test_names(spark):
    df = spark.createDataFrame([(1,)], "`2025` int")
    assert standardise(df).columns == ["Venta_Valor"]
    wide = spark.createDataFrame([tuple("abcd")], "a string, b string, c string, d string")
    assert rename_blocks(wide, ["M"], ["x", "y"]).columns == ["Producto_Familia", "M_x", "M_y",
                                                             "Extra_3"]
    assert rename_blocks(wide, ["M", "N"], ["x", "y"]).columns[-1] == "N_x"
    mixed = spark.createDataFrame([(1, 2, 3)], "`A_TGT ` int, `B_PY 24` int, tgt int")
    assert metric_columns(mixed) == ["A_TGT ", "B_PY 24"]
