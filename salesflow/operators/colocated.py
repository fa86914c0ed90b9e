"""Several lookups of the same facts for one exchange of the facts.

Lookups that are too large for a broadcast but share keys (zone and month) are stored next to the facts: all
are bucketed by the shared keys, so every join finds its two sides in the same buckets. The facts are dealt
once, as they are written; the joins that follow exchange nothing.

A shared key with more rows than a bucket should hold is cut into parts: its facts are dealt to them by a hash of
the row, its lookup rows are repeated for each. Facts whose shared keys are null match nothing and go anywhere.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from salesflow.operators.joins import broadcast_limit, lookup_join, same_key_types
from salesflow.session import plan_bytes, stage, staged_path

PART = "_part"
ROWS_PER_BUCKET = 5_000_000


@dataclass(frozen=True)
class Layout:
    """Shared keys, number of buckets, and the parts of every key that has more than one (``by``, ``parts``; stored)."""

    by: tuple[str, ...]
    buckets: int
    hot: DataFrame


def plan_layout(facts: DataFrame, by: list[str], rows_per_bucket: int = ROWS_PER_BUCKET) -> Layout:
    """Count the rows of every key: one pass that reads these columns alone and shuffles a row for each key and task."""
    counts = stage(facts.groupBy(*by).agg(F.count(F.lit(1)).alias("n")), "key_counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    most = int(facts.sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))
    known = F.lit(True)
    for c in by:
        known &= F.col(c).isNotNull()
    hot = counts.where((F.col("n") > rows_per_bucket) & known).select(
        *by, F.ceil(F.col("n") / rows_per_bucket).cast("int").alias("parts"))
    return Layout(tuple(by), min(max(-(-total // rows_per_bucket), 1), most), stage(hot, "hot_keys"))


def _store(df: DataFrame, layout: Layout, name: str) -> DataFrame:
    """A bucketed table in the shared folder; dealt as it is bucketed, so every bucket is one file."""
    keys = [*layout.by, PART]
    table = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(layout.buckets, *keys).write.format("parquet").bucketBy(layout.buckets, *keys).sortBy(*keys)
     .option("path", staged_path(df.sparkSession, name)).saveAsTable(table))
    return df.sparkSession.table(table)


def store_facts(facts: DataFrame, layout: Layout, name: str = "facts") -> DataFrame:
    """The facts and the number of their part, bucketed."""
    hashed = F.xxhash64(*[f"`{c}`" for c in facts.columns])
    unknown = F.lit(False)
    for c in layout.by:
        unknown |= F.col(c).isNull()
    parts = F.when(unknown, F.lit(layout.buckets)).otherwise(F.coalesce("parts", F.lit(1)))
    dealt = lookup_join(facts, layout.hot, list(layout.by)).withColumn(PART, F.pmod(hashed, parts).cast("int"))
    return _store(dealt.drop("parts"), layout, name)


def store_lookup(lookup: DataFrame, layout: Layout, name: str = "lookup") -> DataFrame:
    """A lookup with a row for every part of its key, bucketed like the facts."""
    repeated = F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))
    return _store(lookup_join(lookup, layout.hot, list(layout.by)).withColumn(PART, repeated).drop("parts"), layout, name)


def lookup_joins(facts: DataFrame, lookups: list[tuple[DataFrame, list[str]]], by: list[str],
                 rows_per_bucket: int = ROWS_PER_BUCKET, limit: int | None = None) -> DataFrame:
    """Look several tables up for every row of ``facts``, each on columns that include ``by``.

    ``lookups`` are (stored table with unique keys, its key columns). Tables known to fit the broadcast threshold
    (``limit``) are broadcast. Of the others a single one is a plain shuffled lookup; two or more are stored next to the
    facts and joined in place. Every way gives the same rows and columns: those of ``facts``, then those of the
    lookups in their order.

    In-place joins need ``spark.sql.requireAllClusterKeysForCoPartition`` to be false, as ``get_session`` sets it; it is set
    here for a session from elsewhere.
    """
    if any(not set(by) <= set(on) for _, on in lookups):
        raise ValueError(f"every lookup must be joined on {by}")
    limit = broadcast_limit(facts) if limit is None else limit
    tables = [table for table, _ in lookups]
    for column in dict.fromkeys(c for _, on in lookups for c in on):
        among = [i for i, (_, on) in enumerate(lookups) if column in on]
        facts, *typed = same_key_types([facts, *[tables[i] for i in among]], [column])
        for i, table in zip(among, typed, strict=True):
            tables[i] = table
    sizes = [plan_bytes(table) for table, _ in lookups]
    large = [i for i, size in enumerate(sizes) if size is None or size > limit]
    order = [*facts.columns, *[c for t, (_, on) in zip(tables, lookups, strict=True) for c in t.columns if c not in on]]
    if len(large) > 1:
        facts.sparkSession.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        layout = plan_layout(facts, by, rows_per_bucket)
        facts = store_facts(facts, layout)
        for i in large:
            table, on = store_lookup(tables[i], layout), lookups[i][1]
            facts = facts.join(table, [*by, PART, *[c for c in on if c not in by]], "left")
        facts = facts.drop(PART)
    for i, (_, on) in enumerate(lookups):
        if len(large) < 2 or i not in large:
            facts = lookup_join(facts, tables[i], on, sized_by=[lookups[i][0]], limit=limit)
    return facts.select(*[f"`{c}`" for c in order])
