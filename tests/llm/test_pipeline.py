"""Every stage of the corpus pipeline, and all of them, against a plain chain of the same rules."""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pytest
from llm_fixtures import DOCUMENTS, documents, given  # noqa: F401
from pyspark.sql import functions as F
from test_text_operators import plain_components, plain_distance, plain_passages, plain_signals
from tokenizers import Tokenizer

import corpus_pipeline

COLUMNS = ("row", "row_key", "vertex", "spans", "kept")  # names that the operators use inside


def plain_chain(rows, items):
    """Rows (id, text, n_chars) after each stage but the last."""
    rows = [r for r in rows if r[1] and plain_signals(r[1])[-1]]
    after = [rows]
    least = min(d for d, _, _ in rows if d is not None) - 1  # null ids are first here
    texts = {d: t for d, (t, _) in plain_passages({(least if d is None else d, t) for d, t, _ in rows}, 2).items()}
    rows = [(d, (t := texts[least if d is None else d]), None if n is None else len(t)) for d, _, n in rows]
    after.append(rows)
    # a component is named by its smallest id; null is last
    most = max(d for d, _, _ in rows if d is not None) + 1
    numbered = sorted(rows, key=lambda r: most if r[0] is None else r[0])
    found = plain_components([(i, t) for i, (_, t, _) in enumerate(numbered)], 5, 80)
    rows = [numbered[i] for i, size, first in found if not size or i == first]
    after.append(rows)
    cut = lambda t: re.findall("[0-9a-z]+", (t or "").lower())
    clean = [r for r in rows if not any(
        (p := cut(own)) and plain_distance(p, cut(r[1])) <= int(0.2 * len(p)) for own in items)]
    return [*after, clean]


def plain_pieces(rows):
    tokenizer, out = Tokenizer.from_file(corpus_pipeline.TOKENIZER), {}
    for doc, text, _ in rows:
        out[doc] = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
    return out


def check_pieces(pieces, rows):
    whole = plain_pieces(rows)
    assert len(whole) == len(rows) and {p.doc_id for p in pieces} == set(whole)
    for doc, own in whole.items():
        mine = sorted((p for p in pieces if p.doc_id == doc), key=lambda p: p.start)
        assert [i for p in mine for i in p.ids] == own.tolist()
        assert all(p.doc_tokens == len(own) and p.ids_crc32 == zlib.crc32(own[p.start:p.start + p.length].tobytes()) for p in mine)
    places = sorted(p.sequence_id * 4096 + p.offset for p in pieces)
    lengths = {p.sequence_id * 4096 + p.offset: p.length for p in pieces}
    assert places == np.cumsum([0, *(lengths[x] for x in places)])[:-1].tolist()


@pytest.fixture(scope="module")
def corpus(spark, given, tmp_path_factory):  # noqa: F811
    prose = [r.text for r in given("documents").join(given("labels"), "doc_id").where("quality = 1")
             .orderBy("doc_id").collect() if 60 <= len(r.text.split()) <= 400][:24]
    assert len(prose) == 24
    rng, item = random.Random(7), [f"question{i}" for i in range(12)]
    shared = "\n".join(prose[0].split("\n")[:1] + ["a second line of the shared passage", "and a third one"])
    rows = [(i, t, len(t)) for i, t in enumerate(prose)]
    rows += [(100 + i, f"{prose[i]}\nown {i}\n{shared}", 1) for i in range(5, 9)]                       # passages
    near = [" ".join(w if k % 100 != 50 else f"n{rng.randrange(99)}" for k, w in enumerate(prose[i].split())) for i in (9, 10)]
    rows += [(200 + i, t, None) for i, t in enumerate(near)]                                            # near copies
    rows += [(300, f"{prose[11]} {' '.join(item)}", 5), (301, f"{' '.join(item[:-1])} edited {prose[12]}", None)]
    rows += [(400, prose[13], 9), (400, None, None), (401, None, 3), (402, "", 0), (403, "too short", 9),
             (None, f"{prose[14]} " * 2, 7), (404, "#### " * 400, 2000)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    df = spark.createDataFrame([(i, t, None, None, n) for i, t, n in rows], DOCUMENTS).repartition(3)
    for name in COLUMNS:
        df = df.withColumn(name, F.lit(name))
    df.write.parquet(f"{folder}/documents.parquet")
    items = [(1, " ".join(item)), (2, None), (3, "")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, [t for _, t in items]


def of(df):
    return sorted(((r.doc_id, r.text, r.n_chars) for r in df.collect()), key=str)


def test_stages_and_run_equal_the_plain_chain(spark, corpus, tmp_path):
    folder, rows, items = corpus
    expected = plain_chain(rows, items)
    sizes = [len(rows), *map(len, expected)]
    assert sizes[0] > sizes[1] == sizes[2] > sizes[3] > sizes[4] > 0  # every stage that drops has something to drop
    assert {r[1] for r in expected[0]} != {r[1] for r in expected[1]}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    for k, (name, step) in enumerate(corpus_pipeline.STAGES):
        out = step(spark, docs, folder)
        if k == len(corpus_pipeline.STAGES) - 1:
            check_pieces(out.collect(), expected[-1])
            break
        assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        assert of(docs) == sorted(expected[k], key=str), name
        assert all(r[c] == c for r in docs.collect() for c in COLUMNS)
    check_pieces(corpus_pipeline.run(spark, folder).collect(), expected[-1])


def test_run_of_an_empty_table(spark, corpus, tmp_path):
    folder, _, _ = corpus
    spark.read.parquet(f"{folder}/documents.parquet").where("false").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
