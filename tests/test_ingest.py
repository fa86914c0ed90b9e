import pytest

from conftest import values
from salesflow.operators.aggregates import group_count
from salesflow.streaming import ingest
from salesflow.streaming.ingest import ingest_drop, read_landed, read_quarantine

SCHEMA = "id int, name string, age int, city string"


def test_each_dropped_file_lands_once(spark, tmp_path):
    source, target, checkpoint = [tmp_path / n for n in ("in", "out", "cp")]
    source.mkdir()

    def run():
        query = ingest_drop(spark, str(source), str(target), SCHEMA, str(checkpoint))
        query.awaitTermination()

    (source / "a.csv").write_text("id,name,age,city\n1,Juan,25,Lima\n2,Maria,30,Cusco\n")
    (source / "skip.txt").write_text("id,name,age,city\n9,x,9,x\n")
    run()
    run()  # a restart adds nothing
    (source / "b.csv").write_text("id,name,age,city\n3,Carlos,35,Lima\n")
    run()
    landed = read_landed(spark, str(target), SCHEMA)
    assert values(landed.select("id", "city")) == [(1, "Lima"), (2, "Cusco"), (3, "Lima")]
    assert values(group_count(landed, "city")) == [("Cusco", 1), ("Lima", 2)]
    run()
    assert landed.count() == 3
    assert (source / "skip.txt").exists()


def test_source_can_be_kept(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("id,name,age,city\n1,Juan,25,Lima\n")
    for _ in range(2):
        ingest_drop(spark, str(source), str(tmp_path / "out"), SCHEMA, str(tmp_path / "cp"),
                    remove_source=False, files_per_batch=1).awaitTermination()
    assert (source / "a.csv").exists()
    assert read_landed(spark, str(tmp_path / "out"), SCHEMA).count() == 1


def test_watching_query_can_be_stopped(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("id,name,age,city\n1,Juan,25,Lima\n")
    query = ingest_drop(spark, str(source), str(tmp_path / "out"), SCHEMA, str(tmp_path / "cp"),
                        continuous_every="1 second")
    query.processAllAvailable()
    query.stop()
    assert read_landed(spark, str(tmp_path / "out"), SCHEMA).count() == 1


def test_no_source_goes_before_its_rows_have_landed(spark, tmp_path):
    source, target, checkpoint = [tmp_path / n for n in ("in", "out", "cp")]
    source.mkdir()

    def run():
        ingest_drop(spark, str(source), str(target), SCHEMA, str(checkpoint)).awaitTermination()

    (source / "a.csv").write_text('id,name,age,city\n1,"a ""b"", c",veinte,Lima\n2,Maria,30\n3, Ana ,31,Cusco\n')
    run()
    assert values(read_landed(spark, str(target), SCHEMA)) == [(3, " Ana ", 31, "Cusco")]
    assert values(read_quarantine(spark, str(target))) == [('1,"a ""b"", c",veinte,Lima',), ("2,Maria,30",)]
    (source / "b.csv").write_text("id,name,city,age\n4,Eva,Lima,25\n")
    with pytest.raises(Exception):
        run()
    assert (source / "b.csv").exists()
    assert read_landed(spark, str(target), SCHEMA).count() == 1


def test_the_same_content_lands_once(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()

    def drop(name, *lines):
        (tmp_path / "in" / name).write_text("\n".join(["id,name", *lines, ""]))
        ingest.ingest_once(spark, source, target, "id bigint, name string", checkpoint).awaitTermination()
        return sorted((r.id, r.name) for r in ingest.read_landed(spark, target, "id bigint, name string").collect())

    assert drop("a.csv", "1,x", '2,"y, z"') == [(1, "x"), (2, "y, z")]
    assert drop("b.csv", "1,x", '2,"y, z"') == [(1, "x"), (2, "y, z")]  # after a restart, under another name
    assert drop("c.csv", "1,x", "no number,3", "4") == [(1, "x"), (1, "x"), (2, "y, z")]  # other content: its rows count
    assert sorted(r.fila for r in ingest.read_quarantine(spark, target).collect()) == ["4", "no number,3"]
    assert drop("empty.csv") == [(1, "x"), (1, "x"), (2, "y, z")]
    (tmp_path / "in" / "wrong.csv").write_text("name,id\nx,1\n")
    with pytest.raises(Exception, match="header"):
        ingest.ingest_once(spark, source, target, "id bigint, name string", checkpoint).awaitTermination()


def test_content_is_forgotten_in_time(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "state"))
    (tmp_path / "in").mkdir()
    for k in range(4):
        (tmp_path / "in" / f"{k}.csv").write_text("id\n1\n" if k != 1 else "id\n2\n")
        ingest.ingest_once(spark, source, target, "id bigint", checkpoint, remember="0 seconds").awaitTermination()
    landed = sorted(r.id for r in ingest.read_landed(spark, target, "id bigint").collect())
    assert landed[0] == 1 and landed[-1] == 2 and len(landed) >= 3
