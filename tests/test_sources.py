from datetime import date

import pytest
from pyspark.sql import functions as F

from conftest import values
from fixtures import block
from salesflow import sources as s
from salesflow.names import block_labels
from salesflow.session import get_session, preview, shared_folder, shuffle_settings
from salesflow.sources.jdbc import jdbc_options


def test_csv_with_schema_and_encoding(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("Nombre;N\nPeñón;3\n".encode("latin-1"))
    got = s.read_csv(spark, str(path), "Nombre string, N int", ";", "ISO-8859-1")
    assert values(got) == [("Peñón", 3)]
    assert s.read_csv(spark, str(path), sep=";", infer=True).schema["N"].dataType.simpleString() == "int"
    assert s.read_csv(spark, str(path), sep=";").schema["N"].dataType.simpleString() == "string"
    with pytest.raises(Exception):
        s.read_csv(spark, str(path), "N int, Nombre string", ";").collect()


def test_headers_keep_their_spaces(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("Zona,Enero _TGT \nx,1\n,\n\n")
    got = s.read_csv(spark, str(path))
    assert got.columns == ["Zona", "Enero _TGT "] and got.count() == 2


def test_block_report_drops_headers_by_value(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text(block([["Producto", "h"], ["a", "1"], ["Producto", "again"], ["", "9"]]))
    got = s.read_block_report(spark, str(path))
    assert got.columns == ["Producto_Familia", *block_labels()]
    assert [r.Producto_Familia for r in got.collect()] == ["a"]
    kept = s.read_block_report(spark, str(path), keep_null_ids=True)
    assert kept.count() == 2
    path.write_text(block([["", "h"], ["a", "1"]]))  # a header without a first cell
    assert s.read_block_report(spark, str(path)).count() == 1


def test_json_pattern(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"city": "Lima"}\n{"city": "Cusco"}\n')
    (tmp_path / "b.txt").write_text("not json\n")
    assert values(s.read_json(spark, str(tmp_path), pattern="*.json")) == [("Cusco",), ("Lima",)]
    assert s.read_json(spark, str(tmp_path / "a.json"), "city string").count() == 2


def test_parquet_overwrites_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(1, "ENE"), (2, "FEB")], "v int, Mes string")
    path = str(tmp_path / "p")
    s.write_parquet(df, path)
    s.write_parquet(df, path, ["Mes"])
    back = s.read_parquet(spark, path)
    assert values(back, "v", "Mes") == [(1, "ENE"), (2, "FEB")]
    plan = back.filter("Mes = 'ENE'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(Mes" in plan
    s.export_dataset(df, path + "2", ["v"])
    assert s.read_parquet(spark, path + "2").columns == ["v"]


def test_partitioned_write_is_rebalanced(spark, tmp_path):
    df = spark.range(3000).repartition(8).selectExpr("id", "if(id % 3 = 0, id % 36, 0) as m")
    s.write_parquet(df, str(tmp_path / "p"), ["m"])
    assert s.read_parquet(spark, str(tmp_path / "p")).count() == 3000
    assert len(list((tmp_path / "p").rglob("*.parquet"))) < 8 * 12


def test_shuffle_settings():
    assert shuffle_settings(1)["spark.sql.shuffle.partitions"] == "200"
    assert shuffle_settings(100 << 40)["spark.sql.shuffle.partitions"] == "819200"
    assert shuffle_settings(1 << 40)["spark.sql.shuffle.partitions"] == "8192"


def test_csv_sink_single_file(spark, tmp_path):
    df = spark.range(100).repartition(4)
    s.write_csv(df, str(tmp_path / "many"))
    s.write_csv(df, str(tmp_path / "one"), single_file=True)
    assert len(list((tmp_path / "many").glob("*.csv"))) == 4
    assert len(list((tmp_path / "one").glob("*.csv"))) == 1


def test_jdbc_options():
    got = jdbc_options("jdbc:x", "t", "id", (0, 100), 8, user="u")
    assert got == {"url": "jdbc:x", "dbtable": "t", "fetchsize": "10000", "partitionColumn": "id",
                   "lowerBound": "0", "upperBound": "100", "numPartitions": "8", "user": "u"}
    assert "numPartitions" not in jdbc_options("jdbc:x", "t")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partitions=4)
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id", (5, 5), 4)


def test_session_and_folder(spark, capsys):
    assert get_session("again") is spark or get_session("again").sparkContext is spark.sparkContext
    assert shared_folder(spark) == shared_folder(spark)
    preview(spark.range(3), 2)
    out = capsys.readouterr().out
    assert "id: long" in out


def test_cluster_needs_a_shared_folder(monkeypatch):
    class Conf:
        def get(self, key, default):
            return default

    class Context:
        master, applicationId = "spark://host:7077", "app"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        shared_folder(Session())
    Session.sparkContext.master = "local[2]"
    assert shared_folder(Session()) == shared_folder(Session())


def test_all_months_come_back_from_their_folders(spark, tmp_path):
    lines = spark.createDataFrame(
        [(i, i % 7, date(2023 + i % 2, i % 12 + 1, i % 28 + 1), i * 1.25) for i in range(600)] + [(600, None, None, 3.0)],
        "l_orderkey long, l_linenumber int, l_shipdate date, l_extendedprice double").withColumn("mes", F.month("l_shipdate"))
    s.write_parquet(lines, str(tmp_path / "months"), ["mes"])
    back = s.read_parquet(spark, str(tmp_path / "months"))
    assert values(back, *lines.columns) == values(lines, *lines.columns)
    assert {r.mes for r in back.select("mes").distinct().collect()} == {None, *range(1, 13)}
    for months, expected in (("mes <= 3", 150), ("mes > 3", 450), ("mes = 12", 50)):
        some = back.where(months)
        assert some.count() == expected
        scan = some._jdf.queryExecution().executedPlan().toString()
        assert "(mes#" in scan.split("PartitionFilters: [")[1].split("]")[0]  # only those folders are read
