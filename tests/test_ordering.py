import numpy as np
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from salesflow.operators import ordering as o


def test_running_total_matches_brute_force(spark):
    df = spark.range(1000).select(((F.col("id") * 7919) % 1009).alias("x"), (F.col("id") % 5).alias("w"))
    got = {r.x: r.t for r in o.running_total(df, [F.col("x").desc()], F.col("w"), "t").collect()}
    total, expected = 0, {}
    for r in sorted(df.collect(), key=lambda r: -r.x):
        total += r.w
        expected[r.x] = total
    assert got == expected


def test_exact_quantile_interpolates(spark):
    data = [float((i * 37) % 101) / 4 for i in range(500)] + [3.25] * 300 + [None]
    df = spark.createDataFrame([(v,) for v in data], "x double")
    clean = [v for v in data if v is not None]
    for p in (0.0, 0.25, 0.5, 0.99, 1.0):
        assert np.isclose(o.exact_quantile(df, "x", p).first()[0], np.quantile(clean, p))


def test_category_index_matches_the_indexer(spark):
    rows = [("b", "x"), ("a", "x"), ("a", "y"), ("c", "y"), (None, "z"), ("b", "z"), ("d", "z")]
    df = spark.createDataFrame(rows, "p string, q string")
    got = {(r["column"], r.label): r["index"] for r in o.category_index(df, ["p", "q"]).collect()}
    for c in ("p", "q"):
        model = StringIndexer(inputCol=c, outputCol="i", handleInvalid="keep").fit(df)
        assert {label: got[(c, label)] for label in model.labels} == {
            label: float(i) for i, label in enumerate(model.labels)}
    assert len(got) == 7
