"""One query for every operator of this package, over whole tables, and its SQL where SQL has it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from salesflow.llm import (chat, decontaminate, jaccard_join, licenses, line_dedup, negatives, packing, quality, sharding,
                           simhash, substrings, url_filters, whitening)
from salesflow.llm.url_filters import Rule
from salesflow.sources import read_parquet

SHARDS = [f"shard-{i:02d}" for i in range(64)]
SLOTS = 6421  # a prime of about 100 slots a shard

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

CONTROL_CHAT = "</s>[INST] ok [/INST]"

URL_RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"),
             Rule("block", "example.org", "/en/1"), Rule("allow", "com", "/fr/"),
             Rule("block", "com", "/de/")]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{folder}/{name}.parquet")


def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's slot and shard."""
    docs = table(spark, folder, "documents").select("doc_id")
    return sharding.assign_shards(docs, "doc_id", SHARDS, SLOTS)


def op2_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Pieces of all documents in sequences of 4096 tokens."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return packing.pack(docs, TOKENIZER, end_id=2, length=4096).drop("ids")


def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Counts, compression ratios and verdict of every document."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return quality.quality_signals(docs).drop("text")


def op4_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's shingles and the smallest document that near-duplicates lead to."""
    return jaccard_join.near_duplicates(table(spark, folder, "documents"), words=3, percent=90)


def op5_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases, and templates across line ends, in every document."""
    return licenses.scan_licenses(table(spark, folder, "documents"), wrapped=True)


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the passages of two lines or more that stand earlier."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs, removed="n_removed_lines", passages=True)


def op7_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's words and a digest of those that no earlier document repeats."""
    kept = substrings.remove_repeats(table(spark, folder, "documents"), min_words=50)
    return kept.select("doc_id", "n_words", "n_removed",
                       F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and test item that stands in it, at most one word in five edited."""
    docs, items = (table(spark, folder, name) for name in ("documents", "benchmark"))
    return decontaminate.find_matches(docs, items)


def op9_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Digest of every formatted conversation, read back from the examples."""
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_CHAT).alias("text"))
    examples = chat.expand_examples(turns.unionByName(control))
    loss = chat.loss_text(F.col("formatted"), F.col("loss_start"), F.col("loss_chars"))
    read = examples.select(
        "conv_id", "example", F.length("formatted").alias("chars"), loss.alias("loss"),
        F.when(F.col("is_last"), F.col("formatted")).alias("whole"))
    by_conv = read.groupBy("conv_id").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))),
                                 lambda x: x["loss"]), "").alias("loss"),
        F.max("whole").alias("whole"), F.sum("chars").alias("formatted_chars"))
    back = by_conv.withColumn("turns", chat.read_turns(F.col("whole")))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("loss").cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


def op10_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every page's url; the model learns from the pages that a rule decides."""
    pages = table(spark, folder, "pages").select("page_id", "url")
    model = url_filters.train_url_model(url_filters.labels_from_rules(pages, URL_RULES))
    return url_filters.judge_urls(pages, URL_RULES, model).drop("url")


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Ten hard negatives for each positive of every hundredth vector; a seventh of the labels is moved on by one."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_hard_negatives(vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0)


def op12_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's fingerprint and the smallest document that links lead to."""
    return simhash.near_duplicates(table(spark, folder, "documents"), words=3, radius=3)


def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector's first 32 whitened components."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    result = whitening.whiten(vectors, scale=64, offset=1_000_000, components=32)
    return whitening.explode_components(result).withColumn("deviation", F.col("deviation").cast("bigint")).drop("embedding")


QUERIES = {"op1_sharding": op1_sharding, "op2_packing": op2_packing, "op3_quality": op3_quality,
           "op4_jaccard_join": op4_jaccard_join, "op5_licenses": op5_licenses,
           "op6_line_dedup": op6_line_dedup,
           "op7_substring_dedup": op7_substring_dedup, "op8_decontaminate": op8_decontaminate,
           "op9_chat_format": op9_chat_format,
           "op10_url_filter": op10_url_filter, "op11_hard_negatives": op11_hard_negatives,
           "op12_simhash": op12_simhash, "op13_whitening": op13_whitening}
