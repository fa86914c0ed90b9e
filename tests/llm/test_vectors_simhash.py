"""Hard negatives, SimHash near-duplicates and whitening against plain versions."""

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from llm_fixtures import documents, given  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, LongType, StringType, StructField, StructType

from salesflow.llm import negatives, simhash, whitening

VECTORS = StructType([StructField("vec_id", LongType()), StructField("label", IntegerType()),
                      StructField("embedding", ArrayType(FloatType())), StructField("x", StringType())])


@pytest.fixture(scope="session")
def vectors(spark):
    """An embeddings table from (vec_id, label, vector) rows, with a column whose name clashes."""
    return lambda rows, partitions=3: spark.createDataFrame(
        [(i, k, None if v is None else [None if c is None else float(c) for c in v], "mine") for i, k, v in rows],
        VECTORS).repartition(partitions)


def sample(n, dimension=8, labels=3, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(labels, dimension))
    return [(i, i % labels, (centres[i % labels] + rng.normal(size=dimension)).round(3).tolist()) for i in range(n)]


ODD = [(900, None, [1.0] * 8), (901, 1, None), (902, 1, [float("nan")] * 8), (903, 1, [None] * 8), (904, 1, [float("inf")] * 8),
       (905, 1, [1.0]), (906, 1, []), (None, 1, [.5] * 8), (None, 1, [.5] * 8), (907, 0, [0.0] * 8)]


def usable(rows):
    return [(i, k, np.array(v, np.float32).astype(float)) for i, k, v in rows
            if v is not None and len(v) == 8 and None not in v and np.isfinite(v).all()]


# --- hard negatives ---------------------------------------------------------

def plain_negatives(rows, anchor, scale=256, positives=5, negatives=10, low=30, high=90):
    rows = [(i, k, np.floor(scale * v).astype(int).tolist()) for i, k, v in usable(rows) if k is not None]
    out = []
    for n, (i, k, v) in enumerate(rows):
        if i is None or not anchor(i):
            continue
        scored = sorted(((-sum(a * b for a, b in zip(v, w)), j is None, j or 0, m, label, j)
                         for m, (j, label, w) in enumerate(rows) if m != n))
        for score, *_, j in [s for s in scored if s[4] == k][:positives]:
            good = [s for s in scored if s[4] != k and low * -score <= 100 * -s[0] <= high * -score][:negatives]
            out += [(i, j, rank, s[-1], -score, -s[0]) for rank, s in enumerate(good, 1)]
    return out


def by_value(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("rows, block", [(sample(150), 1024), (sample(150), 4), ([*sample(90), *ODD, *sample(30)], 7),
                                         (sample(12), 1024), (ODD, 1024)])
def test_hard_negatives_equal_plain_version(vectors, rows, block, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(negatives, "PAIRS", 64)
    got = negatives.mine_hard_negatives(vectors(rows), F.col("vec_id") % 10 == 0, sample=50)
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.columns == names
    assert by_value(got.collect()) == by_value(plain_negatives(rows, lambda i: i % 10 == 0))


def test_hard_negatives_without_rows_or_anchors(vectors):
    assert negatives.mine_hard_negatives(vectors([]), F.col("vec_id") % 10 == 0).count() == 0
    assert negatives.mine_hard_negatives(vectors(sample(9)), F.col("vec_id") > 99).count() == 0


def test_bounds_hold_and_leave_pairs_out():
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(4, 16)) * 20
    x = np.vstack([centres[i % 4] + rng.normal(size=16) for i in range(200)] + [np.zeros(16), np.ones(16)]).round().astype(np.int64)
    refs = negatives.reference_directions(x.astype(float), 6)
    norm = np.linalg.norm(x, axis=1)
    angles = np.arccos(np.clip(x @ refs.T / np.maximum(norm, 1)[:, None], -1, 1))
    zero = np.zeros(len(x), np.int64)
    part = negatives.Part(zero, zero, zero, zero, x, norm, angles)
    low, high = negatives.score_bounds(part, part)
    score = x @ x.T
    assert (low <= score).all() and (score <= high).all()
    assert (high < 0.5 * np.outer(norm, norm)).mean() > 0.3  # clusters are told apart without scoring


# --- simhash ----------------------------------------------------------------

def plain_fingerprint(text, n=3):
    words = (text or "").encode().lower().split()
    runs = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(r, seed=42).intdigest() for r in runs]
    return sum(1 << k for k in range(64) if sum(h >> k & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints, ids, radius):
    label = list(range(len(prints)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                label[root(i)] = root(j)
    least = {}
    for i, own in enumerate(ids):
        r = root(i)
        least[r] = own if least.get(r) is None else least[r] if own is None else min(least[r], own)
    return [least[root(i)] for i in range(len(prints))]


def test_simhash_equals_plain_version(spark, documents, monkeypatch):  # noqa: F811
    monkeypatch.setattr(simhash, "SEGMENT_BYTES", 64)  # so that texts of a few words have several pieces
    rng = random.Random(4)
    base = [" ".join(rng.choices("abcdefghij", k=60)) for _ in range(6)]
    rows = []
    for i in range(90):
        words = base[i % 6].split()
        for _ in range(rng.randrange(3)):
            words[rng.randrange(60)] = rng.choice("klm")
        rows.append((i, " ".join(words)))
    rows += [(100, None), (101, ""), (102, " \n\x0b"), (103, "Ünï É"), (104, "ünï é"), (105, "A b"), (106, "a B"), (None, "a b"),
             (None, "alone with no id at all"), (7, base[0]), (7, base[0]), (107, "w x\x1cy z\x85q " * 9), (108, "long " * 500),
             (109, "x" * 1000 + " y z"), (110, "y" * 300)]
    got = simhash.near_duplicates(documents(rows).withColumn("fingerprint", F.lit("mine")), most=8)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    prints = [plain_fingerprint(t) for _, t in rows]
    want = zip([i for i, _ in rows], [f"{p:016x}" for p in prints], plain_components(prints, [i for i, _ in rows], 3))
    assert by_value(got.collect()) == by_value(want)
    assert simhash.near_duplicates(documents([])).count() == 0


def test_spark_and_python_hash_alike(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("né b c")).alias("h")).first().h % 2 ** 64 == xxhash.xxh64("né b c".encode(), 42).intdigest()


@pytest.mark.parametrize("radius, most", [(1, 4), (3, 4), (3, 16), (3, 1024), (5, 16)])
def test_links_join_all_within_radius(spark, radius, most):
    """Dense clusters, larger than a shard at every level."""
    rng = random.Random(radius * most)
    prints = {0, 2 ** 64 - 1}
    for centre in (rng.getrandbits(64) for _ in range(5)):
        prints |= {centre ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(5))) for _ in range(60)}
    prints = sorted(prints)
    df = spark.createDataFrame([(p - 2 ** 64 if p >= 2 ** 63 else p,) for p in prints], "fingerprint bigint")
    got = [(a % 2 ** 64, b % 2 ** 64) for a, b in simhash.links(df, radius, most).collect()]
    place = {p: i for i, p in enumerate(prints)}
    labels = simhash.merge_labels(np.arange(len(prints)), *np.array([(place[a], place[b]) for a, b in got]).reshape(-1, 2).T)
    assert labels.tolist() == plain_components(prints, range(len(prints)), radius)


def test_tree_children_are_keyed_by_distance():
    rng = np.random.default_rng(0)
    prints = np.unique(rng.integers(0, 1 << 12, 300, dtype=np.uint64))
    trees = simhash.Trees(prints, np.array([0, 100]))
    parent, key = trees.slots // 65, trees.slots % 65
    child = trees.order
    inner = trees.slots >= 0
    assert (np.bitwise_count(prints[child[inner]] ^ prints[parent[inner]]) == key[inner]).all()
    assert len(np.unique(trees.slots[inner])) == inner.sum() == len(prints) - 2
    found = {(a, b) for q, n in trees.search(np.arange(len(prints)), 2) for a, b in zip(q.tolist(), n.tolist())}
    assert found == {(a, b) for a in range(len(prints)) for b in range(a) if (a < 100) == (b < 100)
                     and int(prints[a] ^ prints[b]).bit_count() <= 2}


# --- whitening --------------------------------------------------------------

def plain_whitening(rows, weighting, scale=64, offset=1_000_000):
    x = np.array([np.floor(scale * v) + offset for *_, v in usable(rows)]).astype(np.int64)
    fit = np.unique(x, axis=0) if weighting == "distinct" else x
    n, s = len(fit), fit.sum(axis=0)
    d = (n * x - s) / n
    own = (n * fit - s) / n
    cov = own.T @ own / n
    e, axes = np.linalg.eigh(cov)
    return n, [sum(int(v) ** 2 for v in n * row - s) for row in x], d @ (axes[:, ::-1] / np.sqrt(e[::-1])), e[::-1] / e.sum()


@pytest.mark.parametrize("weighting", ["rows", "distinct"])
def test_whitening_equals_plain_version(vectors, weighting):
    rows = [*sample(60), *ODD, *sample(20), *[(300 + i, 0, [1.0, 2, 3, 4, 5, 6, 7, 8]) for i in range(30)]]
    result = whitening.whiten(vectors(rows), scale=64, offset=1_000_000, weighting=weighting, components=5)
    n, deviations, whitened, explained = plain_whitening(rows, weighting)
    got = sorted(result.rows.collect(), key=lambda r: (r.vec_id is None, r.vec_id, r.label, r.deviation))
    order = sorted(range(len(deviations)), key=lambda k: (usable(rows)[k][0] is None, usable(rows)[k][0], usable(rows)[k][1], deviations[k]))
    assert result.n == n and [int(r.deviation) for r in got] == [deviations[k] for k in order]
    mine, plain = np.array([r.whitened for r in got]), whitened[order][:, :5]
    signs = np.sign((mine * plain).sum(axis=0))
    assert np.allclose(mine, plain * signs, rtol=1e-9, atol=1e-9)
    assert np.allclose(result.explained, explained[:5], rtol=1e-9) and result.identity_error < 1e-9
    assert result.rows.columns == ["vec_id", "label", "embedding", "x", "whitened", "deviation"]
    each = whitening.explode_components(result)
    assert each.count() == 5 * len(got) and each.agg(F.min("component"), F.max("component")).first()[:] == (1, 5)


def test_whitening_without_variance_or_rows(vectors):
    assert whitening.whiten(vectors([])).rows.count() == 0
    same = whitening.whiten(vectors([(1, 0, [.5, .5])] * 4))
    assert [r.whitened for r in same.rows.collect()] == [[]] * 4 and whitening.explode_components(same).count() == 0
    flat = whitening.whiten(vectors([(i, 0, [i, 2 * i, 0]) for i in range(9)]), scale=1)
    assert flat.rows.first().whitened is not None and len(flat.rows.first().whitened) == 1 and flat.identity_error < 1e-9
    assert whitening.whiten(vectors([(1, 0, []), (2, 0, None)])).rows.count() == 1


def test_wide_deviations_are_exact():
    gaps = np.array([[3 * 10 ** 9, -(4 * 10 ** 9)], [0, 1]])
    assert [int(v) for v in whitening._deviations(gaps).to_pylist()] == [25 * 10 ** 18, 1]
