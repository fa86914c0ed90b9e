"""A corpus from raw documents to packed token sequences, in five stages.

A stage takes (spark, docs, folder) and returns a DataFrame. It works on all that its predecessor
kept, read from where that was written; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from salesflow.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from salesflow.session import drop_staged, stage, staged
from salesflow.sources import read_parquet

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Compression ratios and token counts are not in SQL: the stages are tested against brute force.
ORACLE_SQL = None

_tables_of_stages: dict[str, set[str]] = {}


def _after_predecessor(step: Stage) -> Stage:
    """Before a stage begins, the tables that earlier stages had staged for their results go: those
    results are written by then. Tables that others staged stay."""

    def run(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
        earlier = _tables_of_stages.setdefault(spark.sparkContext.applicationId, set())
        drop_staged(spark, earlier)
        before = set(staged(spark))
        out = step(spark, docs, folder)
        earlier.clear()
        earlier.update(set(staged(spark)) - before)
        return out

    return run


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the base rules and the compression bands keep. Null and empty texts go."""
    return quality.keep_quality(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without passages of two or more lines that stand earlier; ``n_chars`` follows the text
    where it was set. A text may become empty; no document goes."""
    out = line_dedup.remove_repeated_lines(docs, passages=True)
    if "n_chars" not in docs.columns:
        return out
    count = F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(docs.schema["n_chars"].dataType)
    return out.withColumn("n_chars", count)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: five-word shingles, similarity 0.8."""
    return jaccard_join.keep_one_each(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.drop_contaminated(docs, read_parquet(spark, f"{folder}/benchmark.parquet"))


def pack_tokens(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens, with their ids."""
    return packing.pack(docs, TOKENIZER, end_id=2, length=4096)


STAGES: list[tuple[str, Stage]] = [
    ("quality", _after_predecessor(quality_rules)),
    ("line_dedup", _after_predecessor(dedup_lines)),
    ("near_duplicates", _after_predecessor(near_duplicates)),
    ("decontaminate", _after_predecessor(decontamination)),
    ("packing", _after_predecessor(pack_tokens)),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    """The packed pieces of ``documents``. Every stage's result is written to the shared folder and read
    again; what it was made from goes then."""
    docs, before = read_parquet(spark, f"{folder}/documents.parquet"), set(staged(spark))
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, folder), name)
        drop_staged(spark, [path for path in staged(spark)[:-1] if path not in before])
    return STAGES[-1][1](spark, docs, folder)
