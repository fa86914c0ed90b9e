"""Benchmark decontamination by pigeonhole edit matching.

A test item of n words may differ from a passage by ``error_share * n`` word edits (insert, delete,
replace). Cut into one piece more than that, at least one piece stands in the passage unchanged. So
documents are searched for exact pieces, and what surrounds a hit is verified with the bit-parallel
edit distance of Myers. Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased:
punctuation and white space do not count.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from salesflow.llm.ship import ship_package
from salesflow.llm.words import PUNCTUATION, Words, slices, window_hashes

MATCHES = "doc_id bigint, item_id bigint, errors bigint, first_word bigint, last_word bigint"
FILTER_BITS = 18


def search(pattern: Sequence[int], text: Sequence[int]) -> tuple[int, int]:
    """Least edit distance of ``pattern`` to a part of ``text``, and where the first such part ends."""
    m = len(pattern)
    places: dict[int, int] = defaultdict(int)
    for i, symbol in enumerate(pattern):
        places[symbol] |= 1 << i
    mask, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = mask, 0, m
    best, end = m, 0
    for j, symbol in enumerate(text):
        same = places.get(symbol, 0)
        down = same | minus
        across = (((same & plus) + plus) ^ plus) | same
        more = minus | ~(across | plus)
        less = plus & across
        if more & top:
            score += 1
        elif less & top:
            score -= 1
        more, less = (more << 1) & mask, (less << 1) & mask
        plus = (less | ~(down | more)) & mask
        minus = more & down
        if score < best:
            best, end = score, j + 1
    return best, end


@dataclass(frozen=True)
class Item:
    item_id: int
    words: list[int]
    budget: int


class PieceIndex:
    """The pieces of a block of test items, by length and hash."""

    def __init__(self, items: Sequence[tuple[int, str | None]], error_share: float):
        words = Words(pa.array([text for _, text in items], pa.string()), lower=True, breaks=PUNCTUATION)
        self.items: list[Item] = []
        found: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for k, (item_id, _) in enumerate(items):
            own = words.hashes[words.offsets[k]:words.offsets[k + 1]]
            n = len(own)
            if not n:
                continue
            budget = int(error_share * n)
            cuts = [n * i // (budget + 1) for i in range(budget + 2)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                found[b - a][int(window_hashes(own[a:b], b - a)[0])].append((len(self.items), a))
            self.items.append(Item(item_id, own.tolist(), budget))
        self.by_length = {n: dict(pieces) for n, pieces in found.items()}

    def filters(self) -> dict[int, np.ndarray]:
        """For each piece length, which low bits of a hash some piece has."""
        out = {}
        for n, pieces in self.by_length.items():
            out[n] = np.zeros(1 << FILTER_BITS, dtype=bool)
            out[n][np.array(list(pieces), np.uint64) & np.uint64((1 << FILTER_BITS) - 1)] = True
        return out


def _regions(index: PieceIndex, filters: dict[int, np.ndarray], words: Words) -> dict[tuple[int, int], list]:
    """For each text and item, the word ranges around piece hits, joined where they overlap."""
    owner, room = words.owner(), words.room()
    low = np.uint64((1 << FILTER_BITS) - 1)
    out: dict[tuple[int, int], list] = defaultdict(list)
    for n, pieces in index.by_length.items():
        hashes = window_hashes(words.hashes, n)
        for at in np.flatnonzero(filters[n][hashes & low] & (room >= n)).tolist():
            for k, offset in pieces.get(int(hashes[at]), ()):
                item, text = index.items[k], int(owner[at])
                a = max(at - offset - item.budget, int(words.offsets[text]))
                b = min(at - offset + len(item.words) + item.budget, int(words.offsets[text + 1]))
                out[text, k].append((a, b))
    for ranges in out.values():
        ranges.sort()
        joined = [ranges[0]]
        for a, b in ranges[1:]:
            if a <= joined[-1][1]:
                joined[-1] = (joined[-1][0], max(joined[-1][1], b))
            else:
                joined.append((a, b))
        ranges[:] = joined
    return out


def _matches(index: PieceIndex, filters: dict[int, np.ndarray], texts: pa.Array) -> list[tuple[int, int, int, int, int]]:
    """(text, item, errors, first word, last word): the best place of every item in every text."""
    words = Words(texts, lower=True, breaks=PUNCTUATION)
    out = []
    for (text, k), ranges in _regions(index, filters, words).items():
        item, best = index.items[k], None
        for a, b in ranges:
            part = words.hashes[a:b].tolist()
            errors, end = search(item.words, part)
            if errors <= item.budget and (best is None or errors < best[0]):
                _, back = search(item.words[::-1], part[:end][::-1])
                best = (errors, a + end - back, a + end - 1)
        if best:
            first = int(words.offsets[text])
            out.append((text, k, best[0], best[1] - first, best[2] - first))
    return out


def piece_indexes(benchmark: DataFrame, error_share: float, block_bytes: int) -> list[Broadcast]:
    """The test items as broadcast piece indexes of about ``block_bytes`` of text each, the bound of what
    the driver and a task hold at once. Items without words match nothing."""
    spark = benchmark.sparkSession
    ship_package(spark)
    items = benchmark.select("item_id", F.col("text").alias("item_text"))
    total = items.agg(F.sum(F.octet_length("item_text"))).first()[0] or 0
    n = -(-total // block_bytes)
    block = F.pmod(F.xxhash64("item_id", "item_text"), F.lit(max(n, 1)))
    out = []
    for i in range(n):
        rows = items.where(block == i).orderBy("item_id", "item_text").collect()
        index = PieceIndex([(r["item_id"], r["item_text"]) for r in rows], error_share)
        out.append(spark.sparkContext.broadcast(index))
    return out


def find_matches(docs: DataFrame, benchmark: DataFrame, error_share: float = 0.2,
                 block_bytes: int = 8 << 20) -> DataFrame:
    """Where test items (``item_id``, ``text``) stand in documents (``doc_id``, ``text``).

    One row for a document row and an item that it holds: ``errors`` (word edits), ``first_word`` and
    ``last_word`` of the best, first such place. Whole texts are searched in one pass for each block
    of items, without a shuffle. Null and empty texts hold nothing, null ids stay null, repeated
    rows give repeated matches, other columns are ignored.
    """
    docs = docs.select("doc_id", "text")
    parts = []
    for block in piece_indexes(benchmark, error_share, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], block: Broadcast = block) -> Iterator[pa.RecordBatch]:
            index = block.value
            filters = index.filters()
            for batch in batches:
                for part in slices(batch):
                    found = _matches(index, filters, part.column("text"))
                    docs_of = part.column("doc_id").take(pa.array([m[0] for m in found], pa.int64()))
                    rest = [pa.array([m[i] for m in found], pa.int64()) for i in (2, 3, 4)]
                    items = pa.array([index.items[m[1]].item_id for m in found], pa.int64())
                    yield pa.RecordBatch.from_arrays([docs_of, items, *rest], names=[
                        "doc_id", "item_id", "errors", "first_word", "last_word"])

        parts.append(docs.mapInArrow(run, MATCHES))
    nothing = docs.where("false").select("doc_id", *[F.lit(0).cast("bigint").alias(name) for name in (
        "item_id", "errors", "first_word", "last_word")])
    return reduce(DataFrame.unionByName, parts) if parts else nothing


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, error_share: float = 0.2,
                      block_bytes: int = 8 << 20) -> DataFrame:
    """The rows of ``docs`` that hold no test item, with all their columns."""
    for block in piece_indexes(benchmark, error_share, block_bytes):

        def run(batches: Iterator[pa.RecordBatch], block: Broadcast = block) -> Iterator[pa.RecordBatch]:
            index = block.value
            filters = index.filters()
            for batch in batches:
                for part in slices(batch):
                    clean = np.ones(part.num_rows, dtype=bool)
                    clean[[m[0] for m in _matches(index, filters, part.column("text"))]] = False
                    yield part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
