"""Substring deduplication by seed and extend.

Seeds: of every run of word k-grams that a window of ``min_words`` words spans, the one with the
smallest hash is the window's anchor (winnowing), so equal windows have equal anchors. Documents meet
on anchors. Extension: an anchor is extended to both sides as far as the windows that chose it reach;
occurrences whose extended blocks are equal repeat each other there, and all but those in the smallest
document are covered. Where blocks around one anchor differ, a repeat ends inside the block; there the
windows of each different block are compared one by one. Adjoining pieces make up the maximal repeats.

No pair of documents is formed: groups are reduced to their smallest document and joined back to
that one row, so a passage in a third of all documents costs as much as any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from salesflow.llm.ship import ship_package
from salesflow.llm.words import Words, mix, powers, slices, window_hashes
from salesflow.session import stage

SEED_WORDS = 8

ANCHORS = "anchor bigint, block bigint, doc_id bigint, start int, n int"
WINDOWS = "anchor bigint, window bigint, doc_id bigint, start int"


class RangeHashes:
    """Hashes of any run of words of a word sequence."""

    def __init__(self, hashes: np.ndarray):
        up, self.down = powers(len(hashes) + 1)
        self.sums = np.zeros(len(hashes) + 1, dtype=np.uint64)
        np.cumsum(hashes * up[:len(hashes)], out=self.sums[1:])

    def of(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        value = (self.sums[start + length] - self.sums[start]) * self.down[start]
        return mix(value + length.astype(np.uint64))


def smallest_in_windows(values: np.ndarray, n: int) -> np.ndarray:
    """Index of the smallest of the ``n`` values from each place on, the last of equal ones."""

    def better(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where(values[b] <= values[a], b, a)  # b lies behind a

    at, width = np.arange(len(values)), 1
    while 2 * width <= n:
        at = better(at[:-width], at[width:]) if len(at) > width else at[:0]
        width *= 2
    if rest := n - width:
        at = better(at[:-rest], at[rest:]) if len(at) > rest else at[:0]
    return at


def anchor_blocks(words: Words, min_words: int, seed_words: int) -> tuple[np.ndarray, ...]:
    """Of every anchor: its hash, the hash of its block, its text, the block's first word in all
    words, and how many windows chose it."""
    seeds = window_hashes(words.hashes, seed_words)
    at = smallest_in_windows(seeds, min_words - seed_words + 1)
    starts = np.flatnonzero(words.room() >= min_words)
    chosen = at[starts]
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (chosen[1:] != chosen[:-1]) | (starts[1:] != starts[:-1] + 1)
    runs = np.flatnonzero(fresh)
    n = np.diff(np.append(runs, len(starts)))
    first = starts[runs]
    blocks = RangeHashes(words.hashes).of(first, n + min_words - 1)
    return seeds[chosen[runs]], blocks, words.owner()[first], first, n


def anchor_table(docs: DataFrame, min_words: int, seed_words: int) -> DataFrame:
    """``ANCHORS`` of all documents: block of ``n`` windows from word ``start`` on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                anchor, block, text, first, n = anchor_blocks(words, min_words, seed_words)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(block.view(np.int64)),
                     part.column("doc_id").take(pa.array(text)),
                     pa.array((first - words.offsets[text]).astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["anchor", "block", "doc_id", "start", "n"])

    return docs.mapInArrow(run, ANCHORS)


def window_table(blocks: DataFrame, docs: DataFrame, min_words: int) -> DataFrame:
    """``WINDOWS`` of the given blocks. Rows of ``docs`` that share a ``doc_id`` are told apart by the
    block's hash."""
    by_doc = blocks.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "block", "start", "n")).alias("blocks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                ranges = RangeHashes(words.hashes)
                text, (anchor, block, start, n) = _lists(part.column("blocks"), ("anchor", "block", "start", "n"))
                fits = _fits(words, ranges, text, start, n + min_words - 1, block)
                text, anchor, start, n = text[fits], anchor[fits], start[fits], n[fits]
                each = np.repeat(np.arange(len(n)), n)
                inside = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n)
                at = start[each] + inside
                hashes = ranges.of(words.offsets[text[each]] + at, np.full(len(at), min_words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor[each]), pa.array(hashes.view(np.int64)),
                     part.column("doc_id").take(pa.array(text[each])), pa.array(at.astype(np.int32))],
                    names=["anchor", "window", "doc_id", "start"])

    return docs.join(by_doc, "doc_id").select("doc_id", "text", "blocks").mapInArrow(run, WINDOWS)


def _lists(column: pa.ListArray, names: tuple[str, ...]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row of every element of a list column, and the elements' fields."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    values = column.flatten()
    fields = [values.field(name).to_numpy(zero_copy_only=False).astype(np.int64) for name in names]
    return np.repeat(np.arange(len(column)), sizes), fields


def _fits(words: Words, ranges: RangeHashes, text: np.ndarray, start: np.ndarray, length: np.ndarray,
          value: np.ndarray) -> np.ndarray:
    """Which ranges lie in their text and have the hash ``value`` there."""
    inside = start + length <= words.counts[text]
    first = np.where(inside, words.offsets[text] + start, 0)
    found = ranges.of(first, np.where(inside, length, 0))
    return inside & (found.view(np.int64) == value)


def repeated_ranges(docs: DataFrame, min_words: int = 50, seed_words: int = SEED_WORDS) -> DataFrame:
    """Word ranges (``doc_id``, ``start``, ``length``, ``value``: the range's hash) that windows of
    ``min_words`` words cover which also stand in a document with a smaller ``doc_id``."""
    ship_package(docs.sparkSession)
    docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL AND text IS NOT NULL")
    anchors = stage(anchor_table(docs, min_words, seed_words), "anchors")
    # aggregates are written before they are joined: a join of two plain shuffles is one whose hot keys
    # adaptive execution can split
    shared = stage(anchors.groupBy("anchor").agg(
        F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"),
        (F.min("block") != F.max("block")).alias("mixed")).where("lo < hi").drop("hi"), "shared")
    met = stage(anchors.join(shared, "anchor"), "shared-anchors")

    whole = met.where("NOT mixed AND doc_id > lo").select("doc_id", "start", "n", "block")
    mixed = met.where("mixed")
    smallest = stage(mixed.groupBy("anchor", "block").agg(F.min("doc_id").alias("first_doc")), "smallest")
    by_block = stage(mixed.join(smallest, ["anchor", "block"]), "mixed-anchors")
    again = by_block.where("doc_id > first_doc").select("doc_id", "start", "n", "block")

    windows = stage(window_table(by_block.where("doc_id = first_doc"), docs, min_words), "anchor-windows")
    first = stage(windows.groupBy("anchor", "window").agg(
        F.min("doc_id").alias("first_doc"), F.max("doc_id").alias("last_doc")).where("first_doc < last_doc"), "first")
    single = windows.join(first, ["anchor", "window"]).where("doc_id > first_doc")
    blocks = whole.unionByName(again).select(
        "doc_id", "start", (F.col("n") + (min_words - 1)).alias("length"), F.col("block").alias("value"))
    return blocks.unionByName(single.select("doc_id", "start", F.lit(min_words).alias("length"),
                                            F.col("window").alias("value")))


def remove_repeats(docs: DataFrame, min_words: int = 50, seed_words: int = SEED_WORDS) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept`` (the other words, joined by one space) and
    ``spans`` (``start``, ``length`` of the maximal runs of removed words) of every row of ``docs``.

    A word goes if one of the windows of ``min_words`` words over it also starts in a document with a
    smaller ``doc_id``; windows are judged on the input. A row without ``doc_id`` is neither smaller nor
    larger than another and stays whole; rows that share a ``doc_id`` do not remove each other. A null
    text has no words. Other columns are ignored.
    """
    ranges = repeated_ranges(docs, min_words, seed_words)
    by_doc = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("start", "length", "value")).alias("ranges"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column("text"))
                text, (start, length, value) = _lists(part.column("ranges"), ("start", "length", "value"))
                fits = _fits(words, RangeHashes(words.hashes), text, start, length, value)
                step = np.zeros(len(words.hashes) + 1, dtype=np.int64)
                first = (words.offsets[text] + start)[fits]
                np.add.at(step, first, 1)
                np.add.at(step, first + length[fits], -1)
                yield _kept(part.column("doc_id"), words, np.cumsum(step[:-1]) > 0)

    joined = docs.select("doc_id", "text").join(by_doc, "doc_id", "left").select("doc_id", "text", "ranges")
    schema = StructType.fromDDL("doc_id bigint, n_words bigint, n_removed bigint, kept string, "
                                "spans array<struct<start:int,length:int>>")
    return joined.mapInArrow(run, schema)


def _kept(doc_ids: pa.Array, words: Words, gone: np.ndarray) -> pa.RecordBatch:
    data, at = words.data.tobytes(), words.text_at
    removed = np.bincount(words.owner()[gone], minlength=len(doc_ids))
    texts, stays = [], (~gone).tolist()
    for i in range(len(doc_ids)):
        own = data[at[i]:at[i + 1]].split()
        if removed[i]:
            own = compress(own, stays[words.offsets[i]:words.offsets[i + 1]])
        texts.append(b" ".join(own))
    fresh = np.zeros(len(gone) + 1, dtype=bool)
    fresh[words.offsets] = True
    begins = np.flatnonzero(gone & (fresh[:-1] | ~np.concatenate([[False], gone[:-1]])))
    ends = np.flatnonzero(gone & (fresh[1:] | ~np.concatenate([gone[1:], [False]]))) + 1
    text = words.owner()[begins]
    spans = pa.StructArray.from_arrays(
        [pa.array((begins - words.offsets[text]).astype(np.int32)), pa.array((ends - begins).astype(np.int32))],
        names=["start", "length"])
    lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(text, np.arange(len(doc_ids) + 1)).astype(np.int32)), spans)
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(words.counts, pa.int64()), pa.array(removed, pa.int64()),
         pa.array(texts, pa.binary()).cast(pa.string()), lists],
        names=["doc_id", "n_words", "n_removed", "kept", "spans"])
