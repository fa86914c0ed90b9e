import pytest
from pyspark.sql import functions as F

from conftest import values
from salesflow.operators.colocated import PART, lookup_joins, plan_layout, store_facts, store_lookup
from salesflow.session import stage

BY = ["zone", "month"]


@pytest.fixture(scope="module")
def tables(spark):
    """Sales of which a third lie in one zone and month, some with null keys; two lookups on zone and month."""
    i = F.col("id")
    facts = spark.range(3000).select(
        F.when(i % 3 == 0, "hot").when(i % 50 == 1, None).otherwise(F.concat(F.lit("z"), i % 7)).alias("zone"),
        F.when(i % 3 == 0, 1).otherwise(i % 12 + 1).cast("int").alias("month"),
        F.concat(F.lit("p"), i % 20).alias("product"), F.concat(F.lit("f"), i % 4).alias("family"), i.alias("amount"))
    cells = facts.where("zone <> 'z3'").select("zone", F.col("month").cast("bigint").alias("month"))
    one = cells.join(facts.select("product").distinct()).distinct().withColumn("target", F.xxhash64("zone", "month", "product"))
    two = cells.join(facts.select("family").distinct()).distinct().withColumn("plan", F.xxhash64("zone", "month", "family"))
    return stage(facts, "facts"), [(stage(one, "one"), [*BY, "product"]), (stage(two, "two"), [*BY, "family"])]


def plain(facts, lookups):
    for table, on in lookups:
        facts = facts.join(table, on, "left")
    return facts


def exchanges(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


@pytest.mark.parametrize("limit, rows", [(None, 100), (0, 100), (0, 10), (0, 10_000), (-1, 3000)])
def test_every_way_gives_the_same_rows(spark, tables, limit, rows):
    facts, lookups = tables
    got = lookup_joins(facts, lookups, BY, rows_per_bucket=rows, limit=limit)
    assert got.columns == [*facts.columns, "target", "plan"]
    assert values(got) == values(plain(facts, lookups).select(*got.columns))


def test_only_one_large_table_and_broken_keys(tables):
    facts, lookups = tables
    got = lookup_joins(facts, lookups[:1], BY, limit=0)
    assert values(got) == values(plain(facts, lookups[:1]).select(*got.columns))
    with pytest.raises(ValueError):
        lookup_joins(facts, [(lookups[0][0], ["zone", "product"])], BY)


def test_joins_in_place_exchange_nothing(spark, tables):
    """With broadcasts off, and a threshold that would not allow them: no exchange after the facts are stored."""
    facts, lookups = tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = lookup_joins(facts, lookups, BY, rows_per_bucket=100)
        assert exchanges(got) == 0
        assert exchanges(plain(facts.withColumn("month", F.col("month").cast("bigint")), lookups)) > 2
        assert values(got) == values(plain(facts, lookups).select(*got.columns))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_hot_keys_are_cut_into_parts(tables):
    facts, lookups = tables
    layout = plan_layout(facts, BY, 100)
    assert layout.buckets == 30 and values(layout.hot) == [("hot", 1, 10)]
    stored = store_facts(facts, layout)
    parts = stored.where("zone = 'hot'").groupBy(PART).count().collect()
    assert len(parts) == 10 and max(r["count"] for r in parts) < 200
    assert stored.where("zone IS NULL").select(PART).distinct().count() > 5  # null keys do not gather in one place
    look = store_lookup(lookups[0][0], layout)
    assert look.where("zone = 'hot'").count() == 10 * lookups[0][0].where("zone = 'hot'").count()
    sizes = stored.groupBy(F.input_file_name()).count().collect()
    assert len(sizes) <= layout.buckets  # a file for each bucket


def test_empty_facts(tables):
    facts, lookups = tables
    assert lookup_joins(facts.where("false"), lookups, BY, limit=0).count() == 0
    got = lookup_joins(facts, [(t.where("false"), on) for t, on in lookups], BY, limit=-1)
    assert got.where("target IS NULL AND plan IS NULL").count() == 3000
