"""SimHash near-duplicates: BK-trees over shards of fingerprints.

A text's fingerprint has bit k set if over half of its shingles' hashes have it set. Documents with
equal fingerprints are one vertex. Two fingerprints at most ``radius`` bits apart agree in one of
``radius + 1`` pieces, whichever way the bits are cut, so a *shard* is all fingerprints that agree in a
piece. Shards that are too large are cut by a piece of the bits that are left, twice more; what is too
large even then is dealt as pairs of parts. So no shard exceeds ``SHARD`` by much, and no link is lost.

Every shard has a BK-tree: a node's children are keyed by their integer Hamming distance to it. A search
follows only the edges whose key is within the radius of the query's own distance to the node. Trees of
many shards are built and searched together, level by level, in numpy.

A shard returns its components as stars (every member with its component's first), never its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from salesflow.llm.components import components
from salesflow.llm.ship import ship_package
from salesflow.llm.words import slices, text_bytes
from salesflow.session import stage

SEED = 42
SEGMENT_BYTES = 1 << 20
SHARD = 1024  # fingerprints of one tree
LEVELS = 3
FRONTIER = 1 << 20  # (query, node) pairs that a search may hold at once
BITS = 64

_space = re.compile(rb"[\x20\x09-\x0D]").search


def _runs(text: bytes) -> Iterator[list[bytes]]:
    """The lower-cased words of a text, about ``SEGMENT_BYTES`` at a time."""
    at = 0
    while at < len(text):
        found = _space(text, at + SEGMENT_BYTES)
        end = found.start() if found else len(text)
        yield text[at:end].lower().split()  # of bytes: A-Z, and exactly these six breaks
        at = end


def _shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """XXH64 of every run of ``n`` words, joined by single spaces."""
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    hash64 = xxhash.xxh64_intdigest
    spans = zip(starts, ends[n - 1:].tolist(), strict=False)
    return np.fromiter((hash64(line[a:b], SEED) for a, b in spans), np.uint64, len(words) - n + 1)


def fingerprint(text: bytes, words: int = 3) -> int:
    """64 bits of a text; without words 0. A text of fewer words is one shingle."""
    counts, total, before = np.zeros(BITS, np.int64), 0, []
    for run in _runs(text):
        own = before + run
        if len(own) >= words:
            hashes = _shingle_hashes(own, words)
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            counts += bits.sum(axis=0, dtype=np.int64)
            total += len(hashes)
        before = own[-(words - 1):] if words > 1 else []
    if not total and before:
        return xxhash.xxh64_intdigest(b" ".join(before), SEED)
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = 3) -> DataFrame:
    """``doc_id`` and ``fingerprint`` (64 bits as a bigint) of every row's whole text."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                data, at = text_bytes(part.column("text"))
                own = [fingerprint(data[a:b].tobytes(), words) for a, b in zip(at[:-1], at[1:], strict=True)]
                prints = pa.array(np.array(own, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), prints], names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, fingerprint bigint")


def shards(prints: DataFrame, radius: int, most: int = SHARD) -> DataFrame:
    """``shard``, ``fingerprint``: any two distinct fingerprints within ``radius`` share a shard, and a shard has
    about ``most`` at most. Shards of one are left out."""
    pieces, out = radius + 1, None
    rows = prints.select("fingerprint", F.lit(0).cast("bigint").alias("shard"), F.col("fingerprint").alias("rest"),
                         F.lit(BITS).alias("width"))
    for level in range(LEVELS):
        cut = rows.withColumn("piece", F.explode(F.sequence(F.lit(0), F.lit(radius)))).withColumns({
            "low": F.expr(f"CAST(width * piece DIV {pieces} AS INT)"),
            "high": F.expr(f"CAST(width * (piece + 1) DIV {pieces} AS INT)")})
        value = F.expr("shiftrightunsigned(rest, low) & (shiftleft(1L, high - low) - 1L)")
        left = F.expr("(rest & (shiftleft(1L, low) - 1L)) | "
                      "shiftleft(shiftrightunsigned(shiftrightunsigned(rest, high - 1), 1), low)")
        rows = stage(cut.select("fingerprint", F.xxhash64("shard", "piece", value).alias("shard"),
                                left.alias("rest"), (F.col("width") - F.col("high") + F.col("low")).alias("width")),
                     f"shards-{level}")
        sizes = stage(rows.groupBy("shard").agg(F.count("*").alias("n")).where("n > 1"), "shard-sizes")
        fit = rows.join(sizes.where(F.col("n") <= most), "shard").select("shard", "fingerprint")
        out = fit if out is None else out.unionByName(fit)
        large = sizes.where(F.col("n") > most)
        if large.isEmpty():
            return out
        rows = rows.join(large, "shard").select("shard", "fingerprint", "rest", "width", "n")
    # any two of a shard's parts meet in one pair of parts
    parts = F.ceil(2 * F.col("n") / most).cast("bigint")
    dealt = rows.select("shard", "fingerprint", parts.alias("parts")).withColumn(
        "own", F.pmod(F.xxhash64("fingerprint"), "parts")).withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1))).where("own <> other")
    return out.unionByName(dealt.select(
        F.xxhash64("shard", F.least("own", "other"), F.greatest("own", "other")).alias("shard"), "fingerprint"))


class Trees:
    """A BK-tree for each run of ``prints`` that begins at ``firsts``; nodes are places in ``prints``."""

    def __init__(self, prints: np.ndarray, firsts: np.ndarray):
        n = len(prints)
        self.prints = prints
        self.root = np.repeat(firsts, np.diff(np.append(firsts, n)))
        slots = np.full(n, -1, np.int64)  # parent and distance to it
        open_ = np.flatnonzero(self.root != np.arange(n))
        at = self.root[open_]
        while len(open_):
            slot = at * (BITS + 1) + self.distance(open_, at)
            _, first, member = np.unique(slot, return_index=True, return_inverse=True)
            child = open_[first]  # the first to come becomes the child, the others go on below it
            slots[child] = slot[first]
            below = child[member] != open_
            open_, at = open_[below], child[member][below]
        self.order = np.argsort(slots, kind="stable")
        self.slots = slots[self.order]

    def distance(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.prints[a] ^ self.prints[b]).astype(np.int64)

    def search(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, node) within ``radius``, for nodes of the query's own tree that came before it."""
        query, node = queries, self.root[queries]
        while True:
            keep = node < query  # what hangs below a node came after it
            query, node = query[keep], node[keep]
            if not len(query):
                return
            d = self.distance(query, node)
            near = d <= radius
            yield query[near], node[near]
            low = np.searchsorted(self.slots, node * (BITS + 1) + np.maximum(d - radius, 0), "left")
            high = np.searchsorted(self.slots, node * (BITS + 1) + np.minimum(d + radius, BITS), "right")
            n = high - low
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            query, node = np.repeat(query, n), self.order[np.repeat(low, n) + step]


def merge_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``labels`` (each place's smallest known companion) after linking places ``a`` and ``b``."""
    while True:
        x, y = labels[a], labels[b]
        apart = x != y
        if not apart.any():
            return labels
        a, b = a[apart], b[apart]
        np.minimum.at(labels, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (labels[labels] != labels).any():
            labels = labels[labels]


def shard_stars(shard: np.ndarray, prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Every fingerprint that has a smaller companion in its shard (rows of a shard lie together), and the
    first one of its component there."""
    firsts = np.flatnonzero(np.append(True, shard[1:] != shard[:-1]))
    trees = Trees(prints, firsts)
    sizes = np.diff(np.append(firsts, len(shard)))
    work = np.cumsum(np.repeat(sizes, sizes))
    labels, at = np.arange(len(shard)), 0
    while at < len(shard):
        upto = max(at + 1, int(np.searchsorted(work, (work[at - 1] if at else 0) + FRONTIER, "right")))
        for query, node in trees.search(np.arange(at, upto), radius):
            labels = merge_labels(labels, query, node)
        at = upto
    found = np.flatnonzero(labels != np.arange(len(labels)))
    return prints[found], prints[labels[found]]


def links(prints: DataFrame, radius: int, most: int = SHARD) -> DataFrame:
    """``a``, ``b``: pairs of distinct fingerprints whose components are those of all pairs within ``radius``."""
    ship_package(prints.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, own = np.empty(0, np.int64), np.empty(0, np.int64)

        def stars(upto: int) -> pa.RecordBatch:
            a, b = shard_stars(shard[:upto], own[:upto].view(np.uint64), radius)
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

        for batch in batches:
            shard = np.concatenate([shard, batch.column("shard").to_numpy(zero_copy_only=False)])
            own = np.concatenate([own, batch.column("fingerprint").to_numpy(zero_copy_only=False)])
            whole = int(np.searchsorted(shard, shard[-1])) if len(shard) else 0  # the last shard may go on
            if whole:
                yield stars(whole)
                shard, own = shard[whole:], own[whole:]
        if len(shard):
            yield stars(len(shard))

    dealt = shards(prints, radius, most).repartition("shard").sortWithinPartitions("shard")
    return dealt.mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = 3, radius: int = 3, most: int = SHARD) -> DataFrame:
    """For every row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``,
    the smallest ``doc_id`` that links lead to.

    Shingles are ``words`` words of the whole text, A-Z lower-cased, repeats included; a text of fewer words
    is one shingle. Fingerprints link at ``radius`` or fewer differing bits (1 to 31). Texts of any
    length are read in pieces. Texts without words, and null, have fingerprint zero and link like any
    other; repeated rows link; a null ``doc_id`` is larger than any other, and a component of such rows
    alone has a null id. An empty table gives no rows; other columns are ignored.
    """
    if not 1 <= radius < BITS // 2:
        raise ValueError("radius must be from 1 to 31")
    prints = stage(fingerprints(docs, words), "fingerprints")
    distinct = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc")), "distinct-fingerprints")
    labels = components(stage(links(distinct, radius, most), "links"))
    named = distinct.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first_doc", F.coalesce("component", "fingerprint").alias("component"))
    named = stage(named, "labelled-fingerprints")
    smallest = stage(named.groupBy("component").agg(F.min("first_doc").alias("component_id")), "smallest")
    ids = stage(named.join(smallest, "component").select("fingerprint", "component_id"), "component-ids")
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return prints.join(ids, "fingerprint").select("doc_id", digits.alias("fingerprint"), "component_id")
