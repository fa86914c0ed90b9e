import threading

import pytest
from pyspark.sql import functions as F

from conftest import values
from salesflow.sources import partitions, pointers
from salesflow.sources.partitions import drop_unused, read_partitions, write_partitions


@pytest.fixture
def sales(spark):
    i = F.col("id")
    return spark.range(120).select(i.alias("sale"), (i * 2.5).alias("amount"), F.concat(F.lit("M"), i % 12).alias("Mes"))


def test_a_month_is_written_again_and_the_others_stay(spark, sales, tmp_path):
    path = str(tmp_path / "t")
    assert len(write_partitions(sales, path, "Mes")) == 12
    files = {f for f in tmp_path.rglob("*.parquet")}
    fresh = sales.where("Mes = 'M3'").withColumn("amount", F.lit(-1.0))
    assert write_partitions(fresh, path, "Mes") == ["Mes=M3"]
    assert files < {f for f in tmp_path.rglob("*.parquet")}
    assert values(read_partitions(spark, path)) == values(sales.where("Mes <> 'M3'").unionByName(fresh))
    assert read_partitions(spark, path).schema.simpleString() == sales.schema.simpleString()
    plan = read_partitions(spark, path).where("Mes = 'M3'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Mes" in plan
    dropped = drop_unused(spark, path)
    assert len(dropped) == 1 and dropped[0].endswith("Mes=M3")
    assert values(read_partitions(spark, path)) == values(sales.where("Mes <> 'M3'").unionByName(fresh))


def test_a_job_cut_short_changes_nothing(spark, sales, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_partitions(sales, path, "Mes")
    broken = sales.withColumn("amount", F.when(F.col("sale") > 100, F.raise_error(F.lit("cut short")).cast("double")).otherwise(0.0))
    with pytest.raises(Exception, match="cut short"):
        write_partitions(broken, path, "Mes")
    monkeypatch.setattr(partitions, "publish_state", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):  # everything written, nothing published
        write_partitions(sales.withColumn("amount", F.lit(0.0)), path, "Mes")
    monkeypatch.undo()
    assert values(read_partitions(spark, path)) == values(sales)
    assert len(drop_unused(spark, path)) >= 1
    write_partitions(sales.where("Mes = 'M1'"), path, "Mes")
    assert values(read_partitions(spark, path)) == values(sales)


def test_emptied_null_and_first_writes(spark, sales, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        read_partitions(spark, path)
    odd = sales.withColumn("Mes", F.when(F.col("Mes") != "M0", F.col("Mes")))
    write_partitions(odd, path, "Mes", emptied=["M5"])  # it has rows of M5, so these count
    assert values(read_partitions(spark, path)) == values(odd)
    write_partitions(odd.where("false"), path, "Mes", emptied=["M5", None])
    assert values(read_partitions(spark, path)) == values(odd.where("Mes IS NOT NULL AND Mes <> 'M5'"))
    write_partitions(odd.where("false"), path, "Mes", emptied=[f"M{i}" for i in range(12)])
    assert read_partitions(spark, path).count() == 0
    with pytest.raises(ValueError):
        write_partitions(odd.withColumn("more", F.lit(1)), path, "Mes")
    with pytest.raises(ValueError):
        write_partitions(odd.withColumn("version", F.lit(1)), path, "Mes")


def test_writers_at_the_same_time_lose_nothing(spark, sales, tmp_path):
    path = str(tmp_path / "t")
    write_partitions(sales, path, "Mes")
    jobs = [threading.Thread(target=write_partitions, args=(
        sales.where(f"Mes = 'M{i}'").withColumn("amount", F.lit(float(i))), path, "Mes", (), 50)) for i in range(5)]
    for job in jobs:
        job.start()
    for job in jobs:
        job.join()
    changed = F.when(F.col("Mes").isin([f"M{i}" for i in range(5)]), F.substring("Mes", 2, 2).cast("double"))
    assert values(read_partitions(spark, path)) == values(sales.withColumn("amount", F.coalesce(changed, "amount")))


def test_a_state_is_published_once(spark, tmp_path):
    folder = str(tmp_path / "s")
    assert pointers.current_state(spark, folder) == (0, {})
    pointers.publish_state(spark, folder, {"a": "ñ"}, 0)
    with pytest.raises(pointers.StateChanged):
        pointers.publish_state(spark, folder, {"b": 2}, 0)
    assert pointers.current_state(spark, folder) == (1, {"a": "ñ"})
    pointers.publish_state(spark, folder, {"b": 2}, 1)
    assert pointers.current_state(spark, folder) == (2, {"b": 2})
    assert len(pointers.folder_names(spark, f"{folder}/_states")) in (2, 4)  # with or without checksums
