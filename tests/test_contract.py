"""Every query against its SQL counterpart, on whole tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
TYPES = {"DOUBLE": "double", "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string",
         "BOOLEAN": "boolean"}

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="test tables are not here")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


def ordered(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    picked = [tuple(None if r[i] is None else str(r[i]) for i in order) for r in rows]
    return sorted(picked, key=lambda r: tuple((v is None, v or "") for v in r))


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(name, spark, duck):
    got = contract.queries()[name](spark, FOLDER)
    cursor = duck.execute(contract.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    types = {c[0]: TYPES[str(c[1])] for c in cursor.description}
    assert {f.name: f.dataType.simpleString() for f in got.schema} == types
    assert ordered(got.collect(), got.columns) == ordered(cursor.fetchall(), columns)


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_model_query_has_rows(name, spark):
    assert contract.queries()[name](spark, FOLDER).count() > 0


def test_every_sql_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
