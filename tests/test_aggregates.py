import math

import numpy as np
import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from conftest import values
from salesflow.operators import aggregates as a

PAIRS = [(10.0, 8.0), (0.0, 3.0), (5.0, 5.0), (7.0, 1.5), (20.0, 26.0)]


@pytest.fixture
def pairs(spark):
    return spark.createDataFrame(PAIRS, "y double, p double")


def test_error_metrics_match_the_evaluator(pairs):
    got = a.error_metrics(pairs, "y", "p").first()
    for name in ("rmse", "mae", "r2"):
        expected = RegressionEvaluator(labelCol="y", predictionCol="p", metricName=name).evaluate(pairs)
        assert math.isclose(got[name], expected)
    y, p = np.array(PAIRS).T
    assert math.isclose(got.mape, np.mean(np.abs((y - p) / (y + 1))) * 100)
    assert math.isclose(got.mean_residual, np.mean(y - p)) and not got.biased
    assert a.error_metrics(pairs, "y", "p", tolerance=0.01).first().biased


def test_measures_of_nothing(pairs):
    empty = pairs.limit(0)
    assert tuple(a.error_metrics(empty, "y", "p").first()) == (None,) * 6
    assert a.residual_histogram(empty, "y", "p").count() == 0


def test_bias_factor(pairs):
    assert a.bias_factor(pairs, "y", "p").first().factor == 42 / 43.5
    zero = pairs.selectExpr("y", "0.0D as p")
    assert a.bias_factor(zero, "y", "p").first().factor == 1.0


def test_residual_histogram_matches_numpy(spark):
    rows = [(float((i * 17) % 41), float((i * 5) % 13)) for i in range(400)]
    df = spark.createDataFrame(rows, "y double, p double")
    got = {r.bin: r["rows"] for r in a.residual_histogram(df, "y", "p", 7).collect()}
    counts, edges = np.histogram([y - p for y, p in rows], bins=7)
    assert got == {i + 1: c for i, c in enumerate(counts) if c}
    first = min(a.residual_histogram(df, "y", "p", 7).collect(), key=lambda r: r.bin)
    assert math.isclose(first.bin_from, edges[0]) and math.isclose(first.bin_to, edges[1])


def test_constant_residual_is_one_bin(spark):
    df = spark.createDataFrame([(2.0, 1.0), (5.0, 4.0)], "y double, p double")
    assert values(a.residual_histogram(df, "y", "p").select("bin", "rows")) == [(1, 2)]


def test_null_profile_and_counts(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, `b c` int")
    assert tuple(a.null_profile(df).first()) == (1, 2)
    assert tuple(a.null_profile(df.limit(0), ["x"]).first()) == (0,)
    assert values(a.group_count(df, "x")) == [("a", 1), (None, 1)]


def test_summary(spark):
    df = spark.createDataFrame([("A", 2.0, 10.0, 20.0), ("A", 4.0, 1.0, 4.0), ("B", 1.0, 1.0, 1.0)],
                               "Cliente string, Precio_Caja double, prediction_final double, "
                               "ingreso_estimado double")
    assert values(a.recommendation_summary(df, ["Cliente"])) == [("A", 11.0, 3.0, 24.0),
                                                                 ("B", 1.0, 1.0, 1.0)]
    assert tuple(a.recommendation_summary(df).first())[0] == 12.0
