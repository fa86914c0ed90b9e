"""Near-duplicate documents by a grouped prefix join on word shingles.

Documents with equal shingle sets are one *vertex*. All sets are ordered alike, by how often a
shingle's rarest word occurs in all documents, which bounds how many hold it; ties by hash. Two sets with Jaccard similarity t or more share one of
their first ``n - ceil(t n) + 1`` shingles, their prefixes. Vertices with the same prefix and size
are one group; groups are filtered by shared prefix shingles, size and position, then expanded to their
vertices. A vertex also carries the parities of its shingles over 256 places: two sets differ in at least as many
shingles as their parities do in bits, so pairs that differ in too many are no candidates. Candidates are verified on whole sets.

Asked for is who belongs together. So the vertices that share a prefix shingle (or a group) are a
*list*, and only pairs between different components of a list are candidates: first all with the most
central vertices, and once few pairs are left, those. A list that is one component is done. Lists of the same vertices
are one list, and two vertices meet in the first of their common lists, not in each: edited copies of a page share hundreds of
shingles, so hundreds of lists. No link between components is lost, and thousands of copies cost thousands of pairs, not millions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from salesflow.llm.components import merge_components
from salesflow.llm.ship import ship_package
from salesflow.llm.words import Words, mix, slices, window_hashes
from salesflow.session import drop_staged, stage, staged

COUNT_BITS = 18
PAIRS_PER_ROW = 64
BLOCK = 256  # vertices of one block: a task of two blocks has at most about 65 000 pairs
BLOCK_SHINGLES = 1 << 18  # shingles of one block, if no set alone has more: two megabytes of hashes
SALT = np.uint64(0xC2B2AE3D27D4EB4F)
PLACE_SALT = np.uint64(0x165667B19E3779F9)
PLACES = 256
SLOTS = 1 << 24  # of row keys: at most 262 144 numbers of 64 bits
BITS = [f"bits{i}" for i in range(PLACES // 64)]
FIRSTS = 32  # lists that a vertex names: vertices with no common one among these meet in every list they share
LIST_ROW = ["list", "merged", "vertex", "size", "place", *BITS, "firsts"]

ROW_KEY = ["row_key", "row_key2"]
SETS = ("doc_id bigint, row_key bigint, row_key2 bigint, n_shingles bigint, key1 bigint, key2 bigint, grouping bigint, "
        "prefix array<bigint>, " + ", ".join(f"{b} bigint" for b in BITS))


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The distinct hashes of ``n``-word shingles of every text, sorted; a shorter text is one shingle,
    a text without words none."""
    return [own for own, _ in ordered_sets(texts, n, np.zeros(1, np.uint8))]


def ordered_sets(texts: pa.Array, n: int, levels: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Those hashes, and the level of each one's rarest word; ``levels`` goes by a word's hash."""
    words = Words(texts, lower=True)
    hashes = window_hashes(words.hashes, n)
    level = levels[(words.hashes & np.uint64(len(levels) - 1)).astype(np.int64)]
    rarest = level.copy()
    for k in range(1, min(n, len(level))):
        np.minimum(rarest[:-k], level[k:], out=rarest[:-k])
    out = []
    for a, b in zip(words.offsets[:-1].tolist(), words.offsets[1:].tolist(), strict=True):
        if b - a >= n:
            own, first = np.unique(hashes[a:b - n + 1], return_index=True)
            out.append((own, rarest[a:b - n + 1][first]))
        else:
            out.append((window_hashes(words.hashes[a:b], n)[:1], level[a:b].min(keepdims=True) if b > a else level[:0]))
    return out


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set."""
    one, two = mix(shingles).sum(dtype=np.uint64), mix(shingles ^ SALT).sum(dtype=np.uint64)
    return int(np.int64(one.view(np.int64))), int(two.view(np.int64))


def parities(shingles: np.ndarray) -> np.ndarray:
    """How many of the set's shingles fall on each of ``PLACES`` places, modulo two, as 64-bit numbers."""
    places = (mix(shingles ^ PLACE_SALT) & np.uint64(PLACES - 1)).astype(np.int64)
    return np.packbits(np.bincount(places, minlength=PLACES).astype(np.uint8) & 1).view(np.int64)


def row_keys() -> list[Column]:
    """128 bits that stand for a row's id and text."""
    return [F.xxhash64("doc_id", "text").alias("row_key"), F.xxhash64(F.lit(1), "text", "doc_id").alias("row_key2")]


def maybe_held(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` whose ``row_key`` may be one of ``keys``: by a broadcast of the ``SLOTS`` that these fall on, which is bounded
    however many they are. A join on the whole keys must follow."""
    slot = F.col("row_key").bitwiseAND(SLOTS - 1)
    number, place = F.shiftright(slot, 6), slot.bitwiseAND(63).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), place)
    held = keys.groupBy(number.alias("number")).agg(F.bit_or(bit).alias("held"))
    return rows.join(F.broadcast(held), number == F.col("number")).where(F.getbit("held", place) == 1).drop("number", "held")


def needed(n: int, percent: int) -> int:
    """Shingles that a set of ``n`` shares with any set similar to it."""
    return -(-percent * n // 100)


def word_counts(docs: DataFrame) -> np.ndarray:
    """Occurrences of words by the low bits of their hashes: a table of fixed size that the input's
    partitions add up to, counted over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, dtype=np.int64)
        for batch in batches:
            for part in slices(batch):
                low = Words(part.column("text"), lower=True).hashes & np.uint64((1 << COUNT_BITS) - 1)
                counts += np.bincount(low.astype(np.int64), minlength=len(counts))
        held = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(counts[held])], names=["at", "n"])

    parts = docs.select("text").mapInArrow(run, "at int, n bigint")
    rows = parts.groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << COUNT_BITS, dtype=np.int64)
    out[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return out


def commonness(counts: np.ndarray) -> np.ndarray:
    """A level for each count, four for each doubling."""
    return np.floor(4 * np.log2(np.maximum(counts, 1))).astype(np.uint8)


def set_table(docs: DataFrame, levels: np.ndarray, n: int, percent: int) -> DataFrame:
    """``SETS`` of all documents. Every consistent order gives the same result; this one puts common
    shingles last. ``levels`` has one byte for each of a fixed number of counts."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = shared.value
        for batch in batches:
            for part in slices(batch):
                rows, prefixes, bits = [], [], []
                for own, level in ordered_sets(part.column("text"), n, levels):
                    size = len(own)
                    prefix = own[np.argsort(level, kind="stable")][:size - needed(size, percent) + 1 if size else 0]
                    one, two = set_key(own)
                    grouping = int(mix(np.array([set_key(prefix)[0] + size], np.int64).view(np.uint64)).view(np.int64)[0])
                    rows.append((size, one, two, grouping))
                    prefixes.append(prefix.view(np.int64))
                    bits.append(parities(own))
                size, one, two, grouping = zip(*rows, strict=True)
                ends = np.cumsum([0, *map(len, prefixes)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(prefixes)))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", *ROW_KEY)), pa.array(size, pa.int64()), pa.array(one, pa.int64()),
                     pa.array(two, pa.int64()), pa.array(grouping, pa.int64()), lists,
                     *map(pa.array, np.array(bits).T.copy())],
                    names=["doc_id", *ROW_KEY, "n_shingles", "key1", "key2", "grouping", "prefix", *BITS])

    return docs.select("doc_id", *row_keys(), "text").mapInArrow(run, SETS)


def candidate_lists(vertices: DataFrame, percent: int) -> DataFrame:
    """``LIST_ROW``: vertices that share a prefix shingle or a group (``list``), with the shingle's ``place`` in the prefix and
    the vertex's ``firsts``, without rows that are too far into their prefix to link even with the smallest set of their list.

    Of lists with the same vertices only the one with the earliest shingle stays, as many as were ``merged``. Shingles are ordered alike in all prefixes, so
    it is also the earliest for each pair of its vertices."""
    groups = stage(vertices.groupBy("grouping").agg(
        F.min("vertex").alias("vertex"), F.max("size").alias("size"), F.count("*").alias("members")), "groups")
    leaders = vertices.join(groups.select("grouping", "vertex"), ["grouping", "vertex"]).select(
        "grouping", "size", F.posexplode("prefix").alias("place", "list"))
    # written before it is joined, as other aggregates here: a join of two plain shuffles is one whose hot
    # keys adaptive execution can split
    shared = stage(leaders.groupBy("list").agg(F.count("*").alias("n")).where("n > 1").select("list"), "shared")
    by_token = stage(leaders.join(shared, "list"), "shared-shingles")
    held = by_token.groupBy("list").agg(
        F.count("*").alias("n"), F.bit_xor(F.xxhash64("grouping")).alias("one"),
        F.bit_xor(F.xxhash64(F.lit(1), "grouping")).alias("two"), F.min("size").alias("least"),
        F.min_by("place", "grouping").alias("earliest"))  # of one grouping that all equal lists hold
    kept = stage(held.groupBy("n", "one", "two").agg(
        F.min_by("list", "earliest").alias("list"), F.count("*").alias("merged"), F.min("least").alias("least")).select(
        "list", "merged", "least"), "kept-lists")
    size, place = F.col("size"), F.col("place")
    near = by_token.join(kept, "list").where((100 + percent) * (size - place) >= percent * (size + F.col("least")))
    own = groups.where("members > 1").select(
        F.xxhash64("grouping").alias("list"), F.lit(1).cast("bigint").alias("merged"), "grouping", "size", F.lit(0).alias("place"))
    of_groups = stage(near.select("list", "merged", "grouping", "size", "place").unionByName(own), "group-lists")
    ordered = F.array_sort(F.collect_list(F.struct("place", "list")))
    firsts = stage(of_groups.groupBy("grouping").agg(F.slice(ordered, 1, FIRSTS)["list"].alias("firsts")), "first-lists")
    return of_groups.join(firsts, "grouping").join(vertices.select("grouping", "vertex", *BITS), "grouping").select(LIST_ROW)


def may_link(x: str, y: str, percent: int) -> Column:
    """Length and position: enough shingles are left from the shared one on. Parities: not too many differ."""
    of = {c: (F.col(f"{x}.{c}"), F.col(f"{y}.{c}")) for c in ("size", "place", *BITS)}
    both = of["size"][0] + of["size"][1]
    overlap = F.least(of["size"][0] - of["place"][0], of["size"][1] - of["place"][1])
    differ = reduce(Column.__add__, (F.bit_count(a.bitwiseXOR(b)) for a, b in map(of.get, BITS)))
    return ((100 + percent) * overlap >= percent * both) & ((100 + percent) * differ <= (100 - percent) * both)


def linkable(one: DataFrame, rows: DataFrame, once: Column, percent: int) -> DataFrame:
    """Candidate pairs (``a``, ``b``, ``shingles`` of both) of ``one`` and ``rows``, two tables of ``LIST_ROW`` and ``component``,
    for which ``once`` (of ``x`` and ``y``) holds. A pair is made in the first of its common lists: the filter by position is right
    there, and neither vertex leaves that list before they have met. So whatever is left out elsewhere is found there."""
    x, y = one.alias("x"), rows.alias("y")
    first = F.get(F.array_intersect("x.firsts", "y.firsts"), F.lit(0))
    return x.join(y, F.col("x.list") == F.col("y.list")).where(
        (F.col("x.component") != F.col("y.component")) & once & may_link("x", "y", percent)
        & (F.coalesce(first, "x.list") == F.col("x.list"))).select(
        F.least("x.vertex", "y.vertex").alias("a"), F.greatest("x.vertex", "y.vertex").alias("b"),
        (F.col("x.size") + F.col("y.size")).alias("shingles"))


def verifier(docs: DataFrame, vertices: DataFrame, lists: DataFrame, n: int,
             percent: int) -> Callable[[DataFrame], DataFrame]:
    """A function from candidate pairs (``a``, ``b``, ``shingles`` of both) to those whose sets are similar. Each call looks up
    the texts of its own pairs and moves, but for chance, no others."""
    homes = stage(lists.groupBy("list").agg(
        F.count("*").alias("n"), F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)).alias("parts")),
        "list-sizes")
    home = lists.join(homes, "list").groupBy("vertex").agg(F.max(F.struct("n", "list", "parts")).alias("home"))
    block = F.xxhash64("home.list", F.pmod(F.xxhash64("vertex"), F.col("home.parts")))
    blocks = stage(home.select("vertex", block.alias("block")), "blocks")

    def similar(_: tuple, pairs: pa.Table, texts: pa.Table) -> pa.Table:
        sets = dict(zip(texts.column("vertex").to_pylist(),
                        shingle_sets(texts.column("text").combine_chunks(), n), strict=True))
        ok = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist(), strict=True):
            x, y = sets[a], sets[b]
            both = len(np.intersect1d(x, y, assume_unique=True))
            ok.append(100 * both >= percent * (len(x) + len(y) - both))
        return pairs.filter(pa.array(ok, pa.bool_())).select(["a", "b"])

    def verify(pairs: DataFrame) -> DataFrame:
        # texts travel once for each pair of blocks, not once for each pair
        pairs = stage(pairs, "pairs")
        count, shingles = pairs.agg(F.count("*"), F.coalesce(F.sum("shingles"), F.lit(0))).first()
        tasks = max(1, -(-count // BLOCK), -(-shingles // BLOCK_SHINGLES))
        of_a, of_b = (blocks.select(F.col("vertex").alias(c), F.col("block").alias(f"block_{c}")) for c in "ab")
        dealt = stage(pairs.join(of_a, "a").join(of_b, "b").select(
            F.pmod(F.xxhash64("block_a", "block_b"), F.lit(tasks)).alias("task"), "a", "b"), "dealt-pairs")
        ends = stage(dealt.select(F.col("task").alias("at"), F.col("a").alias("vertex")).union(
            dealt.select("task", "b")).distinct(), "pair-ends")
        # written, so that its true size picks the join
        wanted = stage(ends.select("vertex").distinct().join(vertices.select("vertex", *ROW_KEY), "vertex"), "wanted")
        held = stage(maybe_held(docs.select(*row_keys(), "text"), wanted).join(wanted, ROW_KEY).dropDuplicates(
            [*ROW_KEY, "vertex"]).select("vertex", "text"), "candidate-texts")
        texts = ends.join(held, "vertex").select("at", "vertex", "text")
        return dealt.groupBy("task").cogroup(texts.groupBy("at")).applyInArrow(similar, "a bigint, b bigint")

    return verify


def labels_paths(spark: SparkSession, labels: DataFrame) -> list[str]:
    """The staged folders that ``labels`` is read from."""
    files = labels.inputFiles()
    return [path for path in staged(spark) if any(path in f for f in files)]


def link_lists(lists: DataFrame, verify: Callable[[DataFrame], DataFrame], percent: int,
               pairs_per_row: int = PAIRS_PER_ROW) -> DataFrame | None:
    """Components (``node``, ``component``) of the vertices in ``lists``; None if nothing is linked.

    While more than ``pairs_per_row`` pairs a row of all lists are left, the most central vertices of
    every open list are compared with its others and leave it: one at first, then twice as many in every
    round, so rounds grow with the logarithm of a list. Central are those whose open lists are longest for their
    size, as a page's is among its edited copies. With fewer pairs, but more than one a row, there is one such round at
    least, and more as long as they halve what is left: copies cost a pair each, not all their pairs."""
    spark = lists.sparkSession
    labels, centres, before = None, 1, None
    all_rows = lists.agg(F.coalesce(F.sum("merged"), F.lit(0))).first()[0]
    kept, last_round = set(staged(spark)), set()
    while True:
        if labels is None:
            labelled = lists.withColumn("component", F.col("vertex"))
        else:
            labelled = lists.join(labels.withColumnRenamed("node", "vertex"), "vertex", "left").withColumn(
                "component", F.coalesce("component", "vertex"))
        if last_round:  # linked or not, what is left of the lists is made from tables that go below
            labelled = stage(labelled, "lists")
        parts = labelled.groupBy("list", "component").agg(F.count("*").alias("n"))
        sums = stage(parts.groupBy("list").agg(
            F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("largest"),
            ((F.sum("n") * F.sum("n") - F.sum(F.col("n") * F.col("n"))) / 2).alias("pairs")
        ).where("n > largest.n").select("list", "n", "pairs", F.col("largest.component").alias("largest")), "list-sums")
        drop_staged(spark, last_round)  # what the written tables of this round were made from
        left = sums.agg(F.sum("pairs")).first()[0]
        if not left:
            return labels
        last = left <= pairs_per_row * all_rows and (left <= all_rows or before is not None and 2 * left > before)
        before = left
        open_rows = labelled.join(sums.select("list", "n", "largest"), "list")
        if last:  # few pairs are left: all of them, once in a list
            one = open_rows.where("component <> largest").drop("n", "largest")
            once = (F.col("y.component") == F.col("y.largest")) | (F.col("x.vertex") < F.col("y.vertex"))
        else:  # the most central vertices of each list with all others
            central = stage(open_rows.groupBy("vertex").agg((F.sum(F.col("n") * F.col("merged")) / F.max("size")).alias("central")), "central")
            rank = F.row_number().over(Window.partitionBy("list").orderBy(F.desc("central"), "vertex"))
            one = stage(open_rows.drop("n", "largest").join(central, "vertex").withColumn("rank", rank).where(
                F.col("rank") <= centres).drop("rank", "central"), "list-centres")
            centres *= 2
            once = F.lit(True)
        found = stage(verify(linkable(one, open_rows, once, percent).distinct()), "links")
        labels = merge_components(labels, found)
        if labels is not None:
            kept.update(labels_paths(spark, labels))
        last_round = set(staged(spark)) - kept
        if last:
            return labels
        lists = open_rows.select(LIST_ROW).join(
            one.select("list", "vertex"), ["list", "vertex"], "left_anti")


def document_sets(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``SETS`` of every row; written. ``ROW_KEY`` are hashes of id and text."""
    ship_package(docs.sparkSession)
    levels = commonness(word_counts(docs))
    return stage(set_table(docs, levels, words, percent), "shingle-sets")


def document_components(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id``, ``ROW_KEY``, ``n_shingles``, ``component`` (a number, null without shingles) and
    ``first_doc`` (smallest id of the component's vertex) of every row."""
    sets = document_sets(docs, words, percent)
    classes = sets.where("n_shingles > 0").groupBy("key1", "key2").agg(
        F.min("doc_id").alias("doc_id"), F.min(F.struct(*ROW_KEY)).alias("row"), F.max("n_shingles").alias("size"),
        F.max("grouping").alias("grouping"), F.max("prefix").alias("prefix"),
        *[F.max(b).alias(b) for b in BITS]).select("*", "row.*").drop("row")
    vertices = stage(classes.withColumn("vertex", F.monotonically_increasing_id()), "vertices")
    spark, before = docs.sparkSession, set(staged(docs.sparkSession))
    lists = stage(candidate_lists(vertices, percent), "candidates")
    drop_staged(spark, [path for path in staged(spark)[:-1] if path not in before])
    labels = link_lists(lists, verifier(docs, vertices, lists, words, percent), percent)
    keys = vertices.select("key1", "key2", "vertex", F.col("doc_id").alias("first_doc"))
    if labels is None:
        named = keys.withColumnRenamed("vertex", "component")
    else:
        named = keys.join(labels.withColumnRenamed("node", "vertex"), "vertex", "left").withColumn(
            "component", F.coalesce("component", "vertex")).drop("vertex")
    return sets.select("doc_id", *ROW_KEY, "n_shingles", "key1", "key2").join(
        named, ["key1", "key2"], "left").drop("key1", "key2")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """For every row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_shingles`` and ``component_id``, the
    smallest ``doc_id`` that links lead to.

    A row's set are the distinct ``words``-word shingles of its whole text, A-Z lower-cased; a shorter
    text is one shingle. Two rows link when ``100 * intersection >= percent * union``. Texts
    without words, and null, have no shingles and link with nothing: their component is their own id.
    Repeated rows have equal sets and link. A null ``doc_id`` is larger than any other; a component
    of such rows alone has a null id. Other columns are ignored.
    """
    found = stage(document_components(docs, words, percent), "components")
    smallest = stage(found.where("component IS NOT NULL").groupBy("component").agg(
        F.min("first_doc").alias("component_id")), "smallest")
    whole = found.join(smallest, "component", "left")
    return whole.select("doc_id", "n_shingles", F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(
        F.col("component_id")).alias("component_id"))


def keep_one_each(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of every component: the one with the smallest ``doc_id`` (null last), of rows
    that share it the one whose text has the smallest hash, of equal rows any one. Rows without words
    all stay. All columns pass through, whatever their names."""
    found = stage(document_components(docs, words, percent), "components")
    first = found.where("component IS NOT NULL").groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *ROW_KEY)).alias("first"))
    kept = first.select(*[f"first.{c}" for c in ROW_KEY], F.lit(False).alias("wordless")).unionByName(
        found.where("component IS NULL").select(*ROW_KEY, F.lit(True).alias("wordless"))).distinct()
    rows = docs.select(F.struct("*").alias("row"), *row_keys())
    once = F.row_number().over(Window.partitionBy(*ROW_KEY).orderBy("row_key"))
    left = rows.join(kept, ROW_KEY).withColumn("place", once).where("wordless OR place = 1")
    return left.select(*[F.col("row")[c].alias(c) for c in docs.columns])
