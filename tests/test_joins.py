from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import values
from salesflow.operators import joins as j
from salesflow.session import drop_staged, plan_bytes, stage, staged


@pytest.fixture
def skewed(spark):
    """A third of the facts on one key, some on a null key, the rest spread out; some rows twice."""
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 31 == 0, None).otherwise(
        F.col("id") % 500)
    facts = spark.range(6000).select(key.cast("bigint").alias("k"), (F.col("id") % 5900).alias("v"))
    dims = spark.range(400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("d"))
    return facts, dims


def brute(facts, dims, how):
    names = {r.k: r.d for r in dims.collect()}
    rows = [(r.k, r.v, names.get(r.k)) for r in facts.collect()]
    return [x for x in rows if how == "left" or x[0] in names]


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("left_type, right_type, key", [
    ("bigint", "bigint", "bigint"), ("int", "bigint", "bigint"), ("smallint", "int", "bigint"),
    ("string", "bigint", "string"), ("int", "string", "string"), ("decimal(9,2)", "int", "decimal(38,2)"),
    ("float", "int", "double"), ("string", "string", "string")])
def test_all_ways_and_types_agree(skewed, how, left_type, right_type, key):
    facts, dims = skewed
    expected = Counter((None if k is None else float(k), v, d) for k, v, d in brute(facts, dims, how))
    facts, dims = [df.withColumn("k", F.col("k").cast(t)) for df, t in ((facts, left_type), (dims, right_type))]
    for way in (dict(), dict(limit=0), dict(stage_as="d"), dict(limit=0, stage_as="d")):
        got = j.lookup_join(facts, dims, ["k"], how, **way).select("k", "v", "d")
        assert got.schema["k"].dataType.simpleString() == key, way
        rows = [(None if r.k is None else float(r.k), r.v, r.d) for r in got.collect()]
        assert Counter(rows) == expected, way


def test_keys_without_a_common_type_are_refused(spark):
    left = spark.sql("SELECT date'2020-01-01' AS k")
    with pytest.raises(ValueError, match="no common type"):
        j.lookup_join(left, spark.range(1).withColumnRenamed("id", "k"), ["k"])
    with pytest.raises(ValueError, match="collations"):
        j.lookup_join(spark.sql("SELECT 'a' COLLATE UTF8_LCASE AS k"), spark.sql("SELECT 'a' AS k"), ["k"])
    with pytest.raises(ValueError, match="inner or a left"):
        j.lookup_join(left, left, ["k"], "outer")


def test_adaptive_execution_splits_a_hot_key(spark):
    facts = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"),
                                        F.sha2(F.col("id").cast("string"), 256).alias("v")).repartition(8)
    dims = spark.range(5000).withColumnRenamed("id", "k").withColumn("d", F.col("k"))
    small = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
             "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {key: spark.conf.get(key) for key in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        joined = j.lookup_join(facts, dims, ["k"], "inner")
        assert len(joined.collect()) == 200_000
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_duplicate_lookup_rows_repeat_in_every_way(spark):
    facts = spark.range(300).selectExpr("1 as k", "id as v")
    dims = spark.createDataFrame([(1, "a"), (1, "b")], "k bigint, d string")
    assert [j.lookup_join(facts, dims, ["k"], limit=limit).count() for limit in (None, 0)] == [600, 600]


def test_broadcast_depends_on_the_size(spark, tmp_path):
    path = str(tmp_path / "dim")
    spark.range(1000).withColumnRenamed("id", "k").write.parquet(path)
    dim = spark.read.parquet(path)
    facts = spark.range(10).withColumnRenamed("id", "k")
    assert 0 < plan_bytes(dim) < j.broadcast_limit(dim)
    small = j.lookup_join(facts, dim, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in small
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100b")
        assert j.broadcast_limit(dim) == 100
        large = j.lookup_join(facts, dim, ["k"])._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in large
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert j.broadcast_limit(dim) == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_stage_cuts_the_plan(spark):
    staged = stage(spark.range(10).withColumn("x", F.col("id") * 2), "t")
    assert staged.count() == 10
    assert "FileScan" in staged._jdf.queryExecution().executedPlan().toString()


def test_duplicate_keys_and_audit(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert values(j.duplicate_keys(df, ["k"])) == [(1, 2)]
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    assert tuple(j.join_audit(left, lambda rows: rows.join(df, "k", "left")).first()) == (3, 4, False)
    assert j.join_audit(left, lambda rows: rows).first().preserved
    assert tuple(j.join_audit(left.where("false"), lambda rows: rows).first()) == (0, 0, True)


def test_staged_tables_go_when_asked(spark, tmp_path):
    before = staged(spark)
    table = stage(spark.range(3), "mine")
    own = [path for path in staged(spark) if path not in before]
    drop_staged(spark, [*own, str(tmp_path)])
    assert staged(spark) == before and tmp_path.exists()
    with pytest.raises(Exception):
        table.count()
