from __future__ import annotations

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENTS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()),
                        StructField("lang", StringType()), StructField("source", StringType()),
                        StructField("n_chars", LongType())])


@pytest.fixture(scope="session")
def documents(spark):
    """Builds a documents table from (doc_id, text) pairs, other columns null, over several partitions."""

    def build(rows, partitions=3):
        return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCUMENTS).repartition(partitions)

    return build


@pytest.fixture(scope="session")
def given(spark):
    """A table of the small test data."""
    return lambda name, sf="0.001": spark.read.parquet(f"/root/testdata/sf{sf}/{name}.parquet")
