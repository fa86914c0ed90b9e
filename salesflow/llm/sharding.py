"""Consistent placement of rows on shards through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table. The shards
take turns; each claims the first slot of its order that is still free, until the table is full.
Every shard so owns ``size / n`` slots, give or take one, and when a shard leaves, few slots change
hands. A row's key is hashed to a slot; the table, whose size is a parameter, is broadcast.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Largest table: what is broadcast has this many rows at most, whatever the data.
MAX_SLOTS = 1_000_003
HEX_DIGITS = 15  # 60 bits: fits a bigint


def is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, int(n ** 0.5) + 1))


def hash60(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:HEX_DIGITS], 16)


def fill_table(shards: Sequence[str], size: int) -> list[int]:
    """Index of the owning shard for each slot. ``size`` is prime, so every skip visits all slots."""
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must be distinct names, one at least")
    if not is_prime(size) or not len(shards) <= size <= MAX_SLOTS:
        raise ValueError(f"size must be a prime from the number of shards to {MAX_SLOTS}")
    at = [hash60(f"{name}/offset") % size for name in shards]
    skip = [hash60(f"{name}/skip") % (size - 1) + 1 for name in shards]
    owner = [-1] * size
    for turn in range(size):
        i = turn % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + skip[i]) % size
        owner[at[i]] = i
    return owner


def slot_of(key: Column, size: int) -> Column:
    """Slot of a key: its text form hashed with MD5. A null key counts as the empty text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, HEX_DIGITS), 16, 10).cast("bigint") % size).cast("int")


def lookup_table(spark: SparkSession, shards: Sequence[str], size: int) -> DataFrame:
    """The filled table as rows (``slot``, ``shard``, ``shard_name``)."""
    owners = F.split(F.lit(",".join(map(str, fill_table(shards, size)))), ",")
    names = F.split(F.lit("\n".join(shards)), "\n")
    return (spark.range(1).select(F.posexplode(owners).alias("slot", "owner"))
            .select("slot", F.col("owner").cast("int").alias("shard"),
                    F.get(names, F.col("owner").cast("int")).alias("shard_name")))


def assign_shards(df: DataFrame, key: str, shards: Sequence[str], size: int) -> DataFrame:
    """``df`` with ``slot``, ``shard`` (index) and ``shard_name``; no shuffle, no row lost.

    Rows with equal keys meet on one shard; null keys count as empty text; repeated rows all
    stay. Columns of ``df`` named like the three new ones are replaced. Shard names hold no line
    break. An empty table gives an empty table.
    """
    if any("\n" in name for name in shards):
        raise ValueError("shard names hold no line break")
    table = lookup_table(df.sparkSession, shards, size)
    slots = df.drop("slot", "shard", "shard_name").withColumn("slot", slot_of(F.col(key), size))
    return slots.join(F.broadcast(table), "slot", "left").select(
        *[slots[c] for c in slots.columns if c != "slot"], "slot", "shard", "shard_name")
