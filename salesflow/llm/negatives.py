"""Hard-negative mining with angular triangle bounds.

Components become integers; scores are integer inner products. Every row stores its norm and its angles
to a few reference directions. By the triangle inequality on the sphere two rows' angle lies between
``|a - b|`` and ``a + b`` for each reference, so its cosine lies in the intersection of a few intervals. Times both
norms, and widened by more than rounding can do, that bounds the score. Only rows whose bounds overlap
the window of scores that an anchor still asks for get their integer score.

Anchors are a stated query set. They are worked on in blocks of bounded size, broadcast one at a time,
against all rows where these lie; a task returns the best few of every anchor, and a ranking merges them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from salesflow.llm.ship import ship_package
from salesflow.llm.vectors import list_column, matrix, scaled, usable
from salesflow.operators.ordering import running_total
from salesflow.session import stage, staged

BLOCK_BYTES = 4 << 20  # of the anchors that are broadcast at once
BLOCK_ROWS = 1024
PAIRS = 1 << 18  # anchors x rows of one matrix in a task
SLACK = 1e-6  # of the product of norms; angles are off by 1e-7 at most
NEVER = np.iinfo(np.int64).min

ROWS = ("row bigint, vec_id bigint, label bigint, anchor boolean, x array<bigint>, norm double, "
        "angles array<double>")
FOUND = ("slot bigint, anchor_id bigint, positive_id bigint, positive_score bigint, vec_id bigint, "
         "score bigint, row bigint")
MINED = ("anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, "
         "negative_score bigint")


def reference_directions(sample: np.ndarray, count: int) -> np.ndarray:
    """Unit vectors far from each other: the one nearest to the mean, then always the farthest from those taken."""
    units = sample / np.maximum(np.linalg.norm(sample, axis=1, keepdims=True), 1e-300)
    taken = [int(np.argmax(units @ units.mean(axis=0)))]
    nearest = units @ units[taken[0]]
    while len(taken) < min(count, len(units)):
        taken.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, units @ units[taken[-1]])
    return units[taken]


@dataclass
class Part:
    """Some rows as arrays. ``no_id`` marks null ids."""

    row: np.ndarray
    no_id: np.ndarray
    vec_id: np.ndarray
    label: np.ndarray
    x: np.ndarray
    norm: np.ndarray
    angles: np.ndarray

    @staticmethod
    def of(rows: pa.RecordBatch | pa.Table) -> Part:
        if isinstance(rows, pa.Table):
            rows = rows.combine_chunks().to_batches()[0]
        ids = rows.column("vec_id")
        return Part(rows.column("row").to_numpy(), ids.is_null().to_numpy(zero_copy_only=False),
                    ids.fill_null(0).to_numpy(), rows.column("label").to_numpy(), matrix(rows.column("x"), np.int64),
                    rows.column("norm").to_numpy(), matrix(rows.column("angles"), np.float64))

    def __len__(self) -> int:
        return len(self.row)


def score_bounds(a: Part, b: Part) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that the score of every pair is surely not below and not above."""
    low, high = np.full((len(a), len(b)), -1.0), np.full((len(a), len(b)), 1.0)
    for r in range(a.angles.shape[1]):
        both = np.outer(np.cos(a.angles[:, r]), np.cos(b.angles[:, r]))
        swing = np.outer(np.sin(a.angles[:, r]), np.sin(b.angles[:, r]))
        np.minimum(high, both + swing, out=high)  # cosine of the angles' difference
        np.maximum(low, both - swing, out=low)  # and of their sum
    size = np.outer(a.norm, b.norm)
    slack = SLACK * size + 1
    return low * size - slack, high * size + slack


class Best:
    """The ``k`` best of every slot so far: largest score, then smallest id, null ids last. ``floor`` is what a slot
    that has ``k`` asks of a score."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.floor = np.full(slots, NEVER)
        self.fields = [np.empty(0, np.int64) for _ in range(5)]  # slot, score, no id, id, row

    def add(self, slot: np.ndarray, score: np.ndarray, no_id: np.ndarray, vec_id: np.ndarray, row: np.ndarray) -> None:
        good = score >= self.floor[slot]
        fields = [np.concatenate([old, new[good]]) for old, new in
                  zip(self.fields, (slot, score, no_id.astype(np.int64), vec_id, row), strict=True)]
        slot, score, no_id, vec_id, row = fields
        order = np.lexsort((row, vec_id, no_id, -score, slot))
        ranked = slot[order]
        firsts = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(ranked) else np.empty(0, np.int64)
        rank = np.arange(len(ranked)) - np.repeat(firsts, np.diff(np.append(firsts, len(ranked))))
        self.fields = [f[order[rank < self.k]] for f in fields]
        full = order[rank == self.k - 1]
        self.floor[slot[full]] = score[full]


def _exact(a: Part, b: Part, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Pairs with their integer score, some at a time."""
    step = max(1, PAIRS * 8 // max(1, a.x.shape[1]))
    for at in range(0, len(i), step):
        own, other = i[at:at + step], j[at:at + step]
        yield own, other, np.einsum("ij,ij->i", a.x[own], b.x[other])


def _parts(batches: Iterator[pa.RecordBatch], anchors: int) -> Iterator[Part]:
    step = max(1, PAIRS // anchors)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield Part.of(batch.slice(at, step))


def best_positives(anchors: Part, batches: Iterator[pa.RecordBatch], k: int) -> Best:
    """Of every anchor the ``k`` best other rows with its label."""
    best = Best(len(anchors), k)
    for part in _parts(batches, len(anchors)):
        low, high = score_bounds(anchors, part)
        other = (anchors.label[:, None] == part.label) & (anchors.row[:, None] != part.row)
        least = best.floor.astype(np.float64)
        if len(part) > k:  # the k-th best of these rows is not below the k-th largest lower bound
            least = np.maximum(least, np.partition(np.where(other, low, -np.inf), -k, axis=1)[:, -k])
        for i, j, score in _exact(anchors, part, *np.nonzero(other & (high >= least[:, None]))):
            best.add(i, score, part.no_id[j], part.vec_id[j], part.row[j])
    return best


def best_negatives(anchors: Part, least: np.ndarray, most: np.ndarray, batches: Iterator[pa.RecordBatch], k: int) -> Best:
    """Of every anchor and window (``least`` to ``most``, one column for each positive) the ``k`` best rows of another label."""
    width = least.shape[1]
    best, held = Best(least.size, k), least <= most
    upper = np.where(held, most, -np.inf).max(axis=1)
    for part in _parts(batches, len(anchors)):
        low, high = score_bounds(anchors, part)
        asked = np.maximum(least, best.floor.reshape(least.shape))
        lower = np.where(held & (asked <= most), asked, np.inf).min(axis=1)
        overlap = (anchors.label[:, None] != part.label) & (high >= lower[:, None]) & (low <= upper[:, None])
        for i, j, score in _exact(anchors, part, *np.nonzero(overlap)):
            for p in range(width):
                inside = (score >= asked[i, p]) & (score <= most[i, p])
                row = j[inside]
                best.add(i[inside] * width + p, score[inside], part.no_id[row], part.vec_id[row], part.row[row])
    return best


def vector_table(vectors: DataFrame, is_anchor: Column, scale: int, references: int, sample: int) -> DataFrame:
    """``ROWS`` of all rows that take part; the references come from the ``sample`` rows with the smallest hashes."""
    rows = usable(vectors.where("label IS NOT NULL"), "embedding").select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("bigint"), F.col("label").cast("bigint"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"), scaled(F.col("embedding"), scale).alias("x"))
    rows = stage(rows, "integer-vectors")
    some = rows.orderBy(F.xxhash64("vec_id", "x"), "row").limit(sample).select("x").toArrow()
    if not some.num_rows:
        return rows.withColumns({"norm": F.lit(0.0), "angles": F.array().cast("array<double>")})
    directions = reference_directions(matrix(some.column("x").combine_chunks(), np.float64), references)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = matrix(batch.column("x"), np.float64)
            norm = np.linalg.norm(own, axis=1)
            cosines = own @ directions.T / np.where(norm > 0, norm, 1)[:, None]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norm), list_column(np.arccos(np.clip(cosines, -1, 1)))],
                names=[*batch.schema.names, "norm", "angles"])

    return stage(rows.mapInArrow(run, ROWS), "vector-angles")


def _found(best: Best, slots: dict[str, tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    slot, score, no_id, vec_id, row = best.fields
    own = [pa.array(values[slot], mask=nulls[slot]) for values, nulls in slots.values()]
    return pa.RecordBatch.from_arrays(
        [pa.array(slot), *own, pa.array(vec_id, mask=no_id.astype(bool)), pa.array(score), pa.array(row)],
        names=[c.split()[0] for c in FOUND.split(", ")])


def _best_of_all(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _mine_block(spark: SparkSession, rows: DataFrame, anchors: Part, positives: int, negatives: int,
                low: int, high: int) -> DataFrame:
    shared = spark.sparkContext.broadcast(anchors)
    n = len(anchors)
    none = (np.zeros(n, np.int64), np.ones(n, bool))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = best_positives(shared.value, batches, positives)
        yield _found(best, {"anchor_id": none, "positive_id": none, "positive_score": none})

    ranked = _best_of_all(rows.mapInArrow(first, FOUND), positives).toArrow()  # a few rows for each anchor of the block
    at = ranked.column("slot").to_numpy() * positives + ranked.column("rank").to_numpy() - 1
    size = n * positives
    score, no_id, vec_id = np.zeros(size, np.int64), np.ones(size, bool), np.zeros(size, np.int64)
    score[at] = ranked.column("score").to_numpy()
    no_id[at] = ranked.column("vec_id").is_null().to_numpy()
    vec_id[at] = ranked.column("vec_id").fill_null(0).to_numpy()
    least, most = np.ones(size, np.int64), np.zeros(size, np.int64)  # an empty window where no positive is
    least[at], most[at] = -(-low * score[at] // 100), high * score[at] // 100
    slots = {"anchor_id": (np.repeat(anchors.vec_id, positives), np.repeat(anchors.no_id, positives)),
             "positive_id": (vec_id, no_id), "positive_score": (score, np.zeros(size, bool))}
    windows = spark.sparkContext.broadcast((least.reshape(n, -1), most.reshape(n, -1), slots))

    def second(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, most, slots = windows.value
        yield _found(best_negatives(shared.value, least, most, batches, negatives), slots)

    return _best_of_all(rows.mapInArrow(second, FOUND), negatives).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))


def mine_hard_negatives(vectors: DataFrame, is_anchor: Column, scale: int = 256, positives: int = 5, negatives: int = 10,
                        low: int = 30, high: int = 90, references: int = 8, sample: int = 4096) -> DataFrame:
    """``MINED``: for each anchor and each of its first ``positives`` other rows of the same label, the first ``negatives``
    rows of another label with ``low * positive_score <= 100 * negative_score <= high * positive_score``.

    ``vectors`` has ``vec_id``, ``label`` (a whole number) and ``embedding``. A component becomes ``floor(scale * c)``, a
    score is an integer inner product; higher scores come first, ties by smaller ``vec_id`` (null last), equal rows
    in any order. Rows take no part whose label or vector is null, whose vector holds null or non-finite
    entries or has another length than most. A repeated row is another row: it can be its twin's positive,
    and each of several anchors with one id gets its own lists. A condition that is null makes no anchor. An
    empty table, or no anchor, gives no rows; other columns are ignored.

    ``references`` directions are chosen from ``sample`` rows; they decide what is scored, never the result.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vector_table(vectors, is_anchor, scale, references, sample)
    numbered = stage(running_total(rows.where("anchor"), [F.col("row")], F.lit(1), "number"), "anchors")
    count, dimension = numbered.agg(F.count("*"), F.max(F.size("x"))).first()
    if not count:
        return spark.createDataFrame([], MINED)
    block = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * max(1, dimension))))
    paths = []
    for at in range(0, count, block):
        own = numbered.where(F.col("number").between(at + 1, at + block)).drop("number").toArrow()
        stage(_mine_block(spark, rows, Part.of(own), positives, negatives, low, high), "hard-negatives")
        paths.append(staged(spark)[-1])
    return spark.read.schema(MINED).parquet(*paths)
