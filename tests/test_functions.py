import math

from pyspark.sql import functions as F

from salesflow import functions as fn
from salesflow.names import MONTH_CODES


def one(spark, text, column):
    return spark.createDataFrame([(text,)], "c string").select(column).first()[0]


def test_normalise_text_folds_only_spanish_accents(spark):
    cases = {"  Clínica Ñandú ": "CLINICA NANDU", "Müller Ç": "MÜLLER Ç", "": "", None: None,
             "áéíóúñÁÉÍÓÚÑ": "AEIOUNAEIOUN", "plain": "PLAIN", "straße": "STRASSE"}
    for text, expected in cases.items():
        assert one(spark, text, fn.normalise_text("c")) == expected


def test_zone_code_is_second_part(spark):
    cases = {"Pharma - Z1": "Z1", "A - Z2 - X": "Z2", "no dash": None, None: None, "A-": ""}
    for text, expected in cases.items():
        assert one(spark, text, fn.zone_code("c")) == expected


def test_family_key_is_first_word(spark):
    for text, expected in {"ELIPTIC PF": "ELIPTIC", "UNO": "UNO", "": "", None: None}.items():
        assert one(spark, text, fn.family_key("c")) == expected


def test_months_both_ways(spark):
    for number, code in enumerate(MONTH_CODES, start=1):
        assert one(spark, f" {code.lower()}", fn.month_number("c")) == number
        assert one(spark, str(number), fn.month_code("c")) == code
    assert one(spark, "XXX", fn.month_number("c")) is None


def test_unit_price_guards_zero_and_null(spark):
    df = spark.createDataFrame([(10.0, 3), (10.0, 0), (10.0, -1), (10.0, None), (None, 2)],
                               "v double, q int")
    assert [r[0] for r in df.select(fn.unit_price("v", "q")).collect()] == [3.33, 0, 0, 0, None]
    exact = df.select(fn.unit_price("v", "q", scale=None)).first()[0]
    assert exact == 10 / 3


def test_pieces_do_not_overflow(spark):
    df = spark.createDataFrame([(2_000_000_000,)], "q int")
    assert df.select(fn.pieces("q")).first()[0] == 40_000_000_000


def test_scenario_price_and_revenue(spark):
    df = spark.createDataFrame([(10.0, -30, 7.0)], "p double, pct int, d double")
    row = df.select(fn.scenario_price("p", "pct").alias("n"), fn.revenue("p", "d").alias("r"),
                    fn.revenue("p", F.lit(1.006), 2).alias("rr")).first()
    assert (row.n, row.r, row.rr) == (7.0, 70.0, 10.06)


def test_elasticity_thresholds(spark):
    df = spark.createDataFrame([(100.0, 100.5), (100.0, 101.0), (100.0, 100.0), (100.0, 90.0),
                                (0.0, 5.0)], "b double, n double")
    got = [r[0] for r in df.select(fn.elasticity_class("b", "n")).collect()]
    assert got == ["inelastic", "elastic", "atypical", "atypical", "atypical"]


def test_price_strategy(spark):
    df = spark.createDataFrame([(-30,), (0,), (5,)], "c int")
    assert [r[0] for r in df.select(fn.price_strategy("c")).collect()] == ["lower", "keep", "raise"]


def test_log_and_errors(spark):
    df = spark.createDataFrame([(0.0, 2.0), (9.0, 4.0)], "y double, p double")
    rows = df.select(fn.log_target("y").alias("l"), fn.inverse_log(fn.log_target("y")).alias("b"),
                     fn.smoothed_ape("y", "p").alias("a"), fn.residual("y", "p").alias("r")).collect()
    assert rows[0].l == 0 and math.isclose(rows[1].l, math.log(10))
    assert math.isclose(rows[1].b, 9.0)
    assert [r.a for r in rows] == [2.0, 0.5] and [r.r for r in rows] == [-2.0, 5.0]


def test_exact_sum_does_not_drift(spark):
    df = spark.range(100_000).select(F.lit(0.1).alias("x"))
    row = df.agg(fn.exact_sum("x").alias("s"), fn.exact_mean("x").alias("m")).first()
    assert row.s == 10_000.0 and row.m == 0.1
