"""The operators on whole texts against plain versions of the same rules."""

from __future__ import annotations

import hashlib
import random
import re
import textwrap
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given as cases, settings, strategies as st
from llm_fixtures import documents, given  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from salesflow.llm import decontaminate, jaccard_join, licenses, line_dedup, packing, quality, substrings, words
from salesflow.llm.components import components, merge_components
from salesflow.llm.queries import TOKENIZER

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.text(alphabet="aA b\n\t\x0b\x1cé  .😀", max_size=40), max_size=8)


# --- words ------------------------------------------------------------------

@settings(max_examples=150, deadline=None)
@cases(TEXTS, st.integers(3, 50))
def test_words_are_cut_like_the_pattern(texts, segment):
    kept, words.SEGMENT_BYTES = words.SEGMENT_BYTES, segment
    try:
        got = words.Words(pa.array([*texts, None], pa.string()), lower=True)
    finally:
        words.SEGMENT_BYTES = kept
    expected = [[w.encode() for w in WORD.findall(t)] for t in texts] + [[]]
    data = got.data.tobytes()
    cut = [data[a:b] for a, b in zip(got.starts, got.ends)]
    assert [cut[a:b] for a, b in zip(got.offsets[:-1], got.offsets[1:])] == expected
    by_word = {}
    for word, value in zip(cut, got.hashes.tolist()):
        assert by_word.setdefault(word.lower(), value) == value
    assert len(set(by_word.values())) == len(by_word)


# --- quality ----------------------------------------------------------------

def plain_signals(text):
    own = WORD.findall(text or "")
    windows = Counter(tuple(own[i:i + 8]) for i in range(len(own) - 7))
    hit = {j for i in range(len(own) - 7) if windows[tuple(own[i:i + 8])] > 1 for j in range(i, i + 8)}
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    failed = len(own) < 20 or 100 * len(hit) > 30 * len(own)
    raw, pack = (text or "").encode(), zstandard.ZstdCompressor(level=3).compress

    def inside(part):
        band = next(b for b in quality.BANDS if len(part) <= b.max_bytes)
        return band.low <= len(part) / len(pack(part)) <= band.high

    chunks = [raw[i:i + 1024] for i in range(0, len(raw) - 1023, 1024)]
    bad = sum(not inside(c) for c in chunks)
    good = not raw or inside(raw) and 100 * bad <= 30 * len(chunks)
    return (len(own), sum(map(len, own)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit), failed, not failed and good)


def test_quality_equals_plain_rules(documents, given):
    noise = random.Random(3)
    rows = [(r.doc_id, r.text) for r in given("documents").select("doc_id", "text").collect()] + [
        (None, None), (1, ""), (1, ""), (2, "word " * 5000), (3, "".join(chr(noise.randrange(33, 127)) for _ in range(9000))),
        (4, " ".join("".join(chr(noise.randrange(33, 1200)) for _ in range(9)) for _ in range(900))), (5, "é\x0bü\n\n \né\x0bü")]
    df = documents(rows).withColumn("kept", F.lit("mine"))
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    got = quality.quality_signals(df).select("doc_id", "text", *names).collect()
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[2:] == plain_signals(r.text), r.doc_id
    stay = quality.keep_quality(df)
    assert stay.columns == df.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(r.doc_id for r in got if r.kept)
    assert quality.keep_quality(df.where("false")).count() == 0


def test_quality_bands_tell_prose_from_junk(documents, given):
    prose = [r.text for r in given("documents").join(given("labels"), "doc_id").where("quality = 1").collect()]
    long = [t for t in prose if len(t.split()) >= 60]
    noise = random.Random(5)
    junk = ["".join(chr(noise.randrange(33, 0x2FF)) + " " * (noise.random() < .2) for _ in range(3000)) for _ in range(5)]
    junk += [" ".join(f"{long[i].split()[3]} x{j % 7}" for j in range(400)) for i in range(5)]
    got = quality.quality_signals(documents([*enumerate(long), *((-1, t) for t in junk)])).collect()
    assert all(r.kept for r in got if r.doc_id >= 0 and not r.base_failed)
    assert not any(r.kept for r in got if r.doc_id < 0)


# --- packing ----------------------------------------------------------------

def test_packing_covers_every_token_once(documents, given):
    rows = [(r.doc_id, r.text) for r in given("documents").select("doc_id", "text").limit(60).collect()]
    rows += [(1000, None), (1001, ""), (1002, "Ünï'scode 12,3 don't ﬁ J̌ İ</w>  x" * 900), (None, "a"), (None, "a")]
    pieces = packing.pack(documents(rows), TOKENIZER, length=256).toPandas()
    tokenizer = Tokenizer.from_file(TOKENIZER)
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for i, t in rows}
    for doc, own in ids.items():
        mine = pieces[pieces.doc_id.isna() if doc is None else pieces.doc_id == doc].sort_values("start")
        times = 2 if doc is None else 1
        assert mine.length.sum() == times * len(own) and (mine.doc_tokens == len(own)).all()
        for p in mine.itertuples():
            part = own[p.start:p.start + p.length]
            assert p.ids_crc32 == zlib.crc32(part.tobytes()) and list(p.ids) == part.tolist()
            assert p.continued == (p.start > 0) and p.continues == (p.start + p.length < len(own))
    pieces = pieces.sort_values(["sequence_id", "offset"])
    place = pieces.sequence_id * 256 + pieces.offset
    assert (place.to_numpy() == np.cumsum([0, *pieces.length])[:-1]).all()
    assert (pieces.offset + pieces.length <= 256).all()
    assert packing.pack(documents([], 1), TOKENIZER).count() == 0


def test_tokenizer_learns_a_word_once_in_all_its_forms(monkeypatch):
    monkeypatch.setattr(packing, "KNOWN_WORDS", 8)
    coder, learned = packing.TextTokenizer(TOKENIZER), []
    real = coder._learn
    monkeypatch.setattr(coder, "_learn", lambda words: learned.extend(words) or real(words))
    texts = pa.array(["Word word, WORD. word", None, "word.", ""])
    ids, counts = coder.encode(texts)
    assert sorted(w.lower() for w in learned) == [b",", b".", b"word"]
    whole = [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    assert ids.tolist() == sum(whole, []) and counts.tolist() == [len(x) for x in whole]
    rng, parts = random.Random(9), ["a", "B", "É", "É", "Σ", "7", ",", ".", ",.", "'S", "'re", " ", "\n", "\u00a0", "ﬁ", "İ", "ünd", "The"]
    for _ in range(60):  # the words of earlier slices go, come back and stand beside new ones
        some = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(20)]
        ids, counts = coder.encode(pa.array(some))
        whole = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in some]
        assert ids.tolist() == sum(whole, []) and counts.tolist() == [len(x) for x in whole]


# --- line dedup -------------------------------------------------------------

def plain_line_dedup(rows):
    def number(line):
        return int(hashlib.md5(line.encode()).hexdigest()[:7], 16)

    seen, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        lines, chunk, kept = text.split("\n"), [], []
        h = [number(x) for x in lines]
        for i, line in enumerate(lines):
            chunk.append(line)
            if i == len(lines) - 1 or i >= 2 and (h[i - 2] * 1009 ** 2 + h[i - 1] * 1009 + h[i]) % 3 == 0:
                body = "\n".join(chunk)
                if sum(bool(x.strip(" ")) for x in chunk) < 2 or seen.setdefault(body, (doc, i)) == (doc, i):
                    kept += chunk
                chunk = []
        out[doc] = "\n".join(kept)
    return out


def test_line_dedup_equals_plain_version(documents):
    rng = random.Random(1)
    passage = [f"shared line {i} {i * i}" for i in range(12)]
    rows = []
    for doc in range(60):
        lines = [rng.choice(["", " ", "Menu", f"own {doc} {i}", f"own {doc} {i}"]) for i in range(rng.randrange(1, 15))]
        at = rng.randrange(len(lines) + 1)
        rows.append((doc, "\n".join(lines[:at] + passage * (doc % 3) + lines[at:])))
    got = {r.doc_id: r.text for r in line_dedup.remove_repeated_lines(documents(rows)).collect()}
    assert got == plain_line_dedup(rows)
    assert any(got[d] != t for d, t in rows)


def test_line_dedup_cases(documents):
    text = "\n".join(f"line {i}" for i in range(9))
    rows = [(1, text), (1, text), (None, text), (2, None), (3, ""), (4, "one"), (5, "one")]
    df = documents(rows).withColumn("row", F.lit("r")).withColumn("spans", F.lit(1)).withColumn("id", F.lit("i"))
    out = line_dedup.remove_repeated_lines(df, removed="n_removed")
    got = sorted(((r.doc_id or 0), r.text, r.n_removed) for r in out.collect())
    assert out.columns == [*df.columns, "n_removed"] and len(got) == len(rows)
    assert got[0] == (0, text, 0) and [g[2] > 0 for g in got[1:3]] == [True, True] and got[1] == got[2]
    assert got[3:] == [(2, None, 0), (3, "", 0), (4, "one", 0), (5, "one", 0)]
    assert line_dedup.remove_repeated_lines(df.where("false")).count() == 0


def plain_passages(rows, n):
    seen, out = set(), {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        lines = text.split("\n")
        places, gone = [i for i, x in enumerate(lines) if x.strip(" ")], set()
        for a, b in zip(places, places[n - 1:]):
            stretch = "\n".join(lines[a:b + 1])
            gone |= set(range(a, b + 1)) if stretch in seen else set()
            seen.add(stretch)
        out[doc] = "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)
    return out


@pytest.mark.parametrize("n", [1, 2, 3])
def test_repeated_passages_equal_every_stretch(documents, n):
    rng = random.Random(n)
    pool = [[f"shared {k} {i}" for i in range(k)] for k in (2, 3, 4, 5, 8, 12)]
    rows = [(-2, ""), (-1, "one"), (1000, "one"), (1001, "a\n\n \nb\n"), (1002, "\na\n\n \nb"), (1003, "a\n\nb")]
    for doc in range(80):
        lines = [rng.choice(["", " ", "Menu", "Menu", f"own {doc} {i}"]) for i in range(rng.randrange(1, 12))]
        at = rng.randrange(len(lines) + 1)
        rows.append((doc, "\n".join(lines[:at] + rng.choice(pool) * (doc % 3) + lines[at:])))
    df = documents(rows).withColumn("places", F.lit("p"))
    got = {r.doc_id: (r.text, r.n_gone) for r in line_dedup.remove_repeated_lines(
        df, min_lines=n, removed="n_gone", passages=True).collect()}
    assert got == plain_passages(rows, n)


def test_no_passage_of_two_lines_is_missed(documents):
    rows = []
    for k in range(2, 42):
        for copy in range(2):
            own = [f"own {k} {copy} {i}" for i in range(2)]
            rows.append((2 * k + copy, "\n".join(own[:1] + [f"passage {k} {i}" for i in range(k)] + own[1:])))
    out = line_dedup.remove_repeated_lines(documents(rows), removed="n_gone", passages=True)
    assert {r.doc_id: r.n_gone for r in out.collect()} == {d: d // 2 * (d % 2) for d, _ in rows}


def test_runs_of_equal_lines(documents):
    rows = [(1, "\n".join(["head", *["same"] * 92, "tail"])), (2, "\n".join(["same"] * 30)), (3, "\n".join(["same", "other"] * 20)),
            (4, "\n".join(["own", *["same"] * 2, "end"])), (5, "\n".join(["x", *["", "same"] * 40]))]
    out = line_dedup.remove_repeated_lines(documents(rows), removed="n_gone", passages=True)
    got = {r.doc_id: (r.text, r.n_gone) for r in out.collect()}
    assert got == plain_passages(rows, 2)
    assert got == {1: ("head\nsame\ntail", 91), 2: ("", 30), 3: ("same\nother", 38), 4: ("own\nend", 2), 5: ("x\n\nsame\n", 77)}


# --- near duplicates --------------------------------------------------------

def plain_components(rows, n, percent):
    sets = []
    for _, text in rows:
        w = (text or "").encode().lower().split()
        sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[max(top(i), top(j))] = min(top(i), top(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return sorted(((doc, len(sets[i]), least.get(top(i))) for i, (doc, _) in enumerate(rows)), key=str)


def near_copies(rng, n_docs=120):
    base = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(4, 60))] for _ in range(12)]
    rows = []
    for doc in range(n_docs):
        w = list(rng.choice(base))
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(1000)}"
        rows.append((doc, " ".join(w)))
    return rows


@pytest.mark.parametrize("n, percent, per_row", [(3, 90, 4), (5, 80, 4), (2, 60, 0), (3, 70, 0)])
def test_near_duplicates_equal_all_pairs(documents, monkeypatch, n, percent, per_row):
    real = jaccard_join.link_lists
    monkeypatch.setattr(jaccard_join, "link_lists", lambda *a: real(*a, pairs_per_row=per_row))
    rows = near_copies(random.Random(n + percent), 60 if not per_row else 120) + [
        (500, ""), (501, None), (502, "a b"), (503, "A b"), (None, "a  B"), (504, "a"), (None, "zz q r"), (505, "ÀB c d e f"),
        (506, "àB c d e f"), (502, "a b"), (7, "x y z x y z")]
    df = documents(rows).withColumn("vertex", F.lit("v")).withColumn("row_key", F.lit("k"))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                  jaccard_join.near_duplicates(df, n, percent).collect()), key=str)
    assert got == plain_components(rows, n, percent)


def test_parities_differ_in_no_more_bits_than_sets_in_members():
    rng = np.random.default_rng(8)
    for size in (0, 1, 40, 900):
        one = np.unique(rng.integers(0, 1 << 63, size + 50, dtype=np.uint64))
        two = np.union1d(one[:size], rng.integers(0, 1 << 63, size // 3, dtype=np.uint64))
        bits = sum(int(x).bit_count() for x in (jaccard_join.parities(one) ^ jaccard_join.parities(two)).view(np.uint64))
        assert bits <= len(np.setxor1d(one, two))
        assert size != 40 or bits > 30  # and hardly fewer in small sets


def test_similar_texts_longer_than_a_slice(documents):
    rng = random.Random(5)
    page = [f"w{rng.randrange(10 ** 6)}" for _ in range(330_000)]
    near = page[:300_000] + [f"n{i}" for i in range(20_000)]
    far = page[:200_000] + [f"f{i}" for i in range(130_000)]
    rows = [(1, "short one"), (2, " ".join(page)), (3, " ".join(near)), (4, " ".join(far)), (5, None)]
    assert len(rows[1][1]) > words.SLICE_BYTES
    got = {r.doc_id: r.component_id for r in jaccard_join.near_duplicates(documents(rows), 5, 80).collect()}
    assert got == {1: 1, 2: 2, 3: 2, 4: 4, 5: 5}
    empty = jaccard_join.near_duplicates(documents(rows).where("false"), 5, 80)
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id"]


def test_long_lists_without_any_link(documents, monkeypatch):
    real, rounds = jaccard_join.link_lists, []
    monkeypatch.setattr(jaccard_join, "link_lists", lambda lists, verify, percent: real(
        lists, lambda pairs: rounds.append(1) or verify(pairs), percent, pairs_per_row=0))
    rng = random.Random(4)
    page = [f"template{i}" for i in range(60)]
    rows = [(doc, " ".join(page + [f"c{rng.randrange(6)}" for _ in range(24)])) for doc in range(10)]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                  jaccard_join.near_duplicates(documents(rows), 3, 80).collect()), key=str)
    assert got == plain_components(rows, 3, 80)
    assert all(doc == component for doc, _, component in got) and len(rounds) > 2


def test_edited_copies_of_a_page_cost_a_pair_each(documents, monkeypatch):
    real, asked = jaccard_join.verifier, []

    def verifier(*a):
        verify = real(*a)
        return lambda pairs: asked.append(pairs.count()) or verify(pairs)

    monkeypatch.setattr(jaccard_join, "verifier", verifier)
    page, rng = [f"p{i}" for i in range(200)], random.Random(2)
    rows = [(0, " ".join(page))] + [(doc, " ".join(f"e{doc}x{i}" if i in edits else w for i, w in enumerate(page)))
                                    for doc in range(1, 30) for edits in [rng.sample(range(200), 2)]]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                  jaccard_join.near_duplicates(documents(rows), 3, 90).collect()), key=str)
    assert got == plain_components(rows, 3, 90) and {c for _, _, c in got} == {0}
    assert sum(asked) < 60  # all pairs: 435


def test_vertices_that_share_many_lists_meet_once(documents, monkeypatch):
    linkable, link_lists, made, lists = jaccard_join.linkable, jaccard_join.link_lists, [], []

    def counted(*a):
        pairs = linkable(*a)
        made.append((pairs.count(), pairs.distinct().count()))
        return pairs

    monkeypatch.setattr(jaccard_join, "linkable", counted)
    monkeypatch.setattr(jaccard_join, "link_lists", lambda rows, *a: lists.append(
        rows.groupBy("list").agg(F.sort_array(F.collect_list("vertex")).alias("held")).collect()) or link_lists(rows, *a))
    page, rng = [f"p{i}" for i in range(200)], random.Random(3)
    rows = [(doc, " ".join(f"e{doc}x{i}" if i in edits else w for i, w in enumerate(page)))
            for doc in range(24) for edits in [rng.sample(range(200), 4)]]
    rows += [(100 + i, " ".join(page[:i] + page[:i])) for i in range(40, 60, 4)] + [(200, rows[5][1] + " end")]
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                  jaccard_join.near_duplicates(documents(rows), 3, 80).collect()), key=str)
    assert got == plain_components(rows, 3, 80)
    members = [tuple(r.held) for r in lists[0]]
    shared = sum(len(m) * (len(m) - 1) // 2 for m in members)
    assert len({*members}) == len(members)
    assert sum(n for n, _ in made) == sum(n for _, n in made) < 400 < 2000 < shared


def test_vertices_without_a_common_first_list_meet_elsewhere(documents, monkeypatch):
    monkeypatch.setattr(jaccard_join, "FIRSTS", 1)
    rows = near_copies(random.Random(9))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in
                  jaccard_join.near_duplicates(documents(rows), 2, 60).collect()), key=str)
    assert got == plain_components(rows, 2, 60)


def test_maybe_held_loses_no_key(spark):
    rows = spark.range(2000).select(F.xxhash64("id").alias("row_key"), "id")
    keys = rows.where("id % 50 = 0").select("row_key")
    got = [r.id for r in jaccard_join.maybe_held(rows, keys).collect()]
    assert {*range(0, 2000, 50)} <= {*got} and len(got) == len({*got}) < 100
    assert jaccard_join.maybe_held(rows, keys.where("false")).isEmpty()


def test_keep_one_each(documents):
    long = " ".join(f"w{i}" for i in range(50))
    rows = [(3, long), (3, long), (9, long + " x"), (None, long), (4, "other words"), (5, None), (5, None), (6, ""), (None, "lone words")]
    df = documents(rows).withColumn("row", F.lit(1))
    out = jaccard_join.keep_one_each(df)
    assert out.columns == df.columns
    assert sorted((str(r.doc_id), (r.text or "")[:5]) for r in out.collect()) == [
        ("3", "w0 w1"), ("4", "other"), ("5", ""), ("5", ""), ("6", ""), ("None", "lone ")]
    assert jaccard_join.keep_one_each(df.where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, i) for i in range(101, 130)] + [(7, 7), (129, 200)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}, 200: 100}


# --- licenses ---------------------------------------------------------------

def plain_license(text):
    own = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in licenses.PHRASES for i in range(len(own))
              if own[i:i + len(phrase.split())] == phrase.split()]
    score, labels = 0.0, {label for _, label in places}
    for line in (text or "").split("\n"):
        block = set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), line)))
        for label, template in licenses.TEMPLATES:
            words_of = set(template.split())
            share = len(block & words_of) / len(words_of)
            if share >= licenses.THRESHOLD:
                labels.add(label)
                score = max(score, share)
    starts = [i for i, _ in places]
    return (len(own), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({x for _, x in places})), ",".join(sorted(labels)), 1.0 if places else score)


def test_licenses_equal_plain_version(documents):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"
    rows = list(enumerate([
        "under the MIT license under the mit license", "x under the mit\nlicense", "CC BY-NC 4.0; cc-by-nc!", None, "", "\n\n",
        mit, mit.replace("granted", "given").replace("free", "x").replace("charge", "y"), "GNU GENERAL public license, Version 3",
        "Apache License, Version 2.0 under the MIT license cc by nc", "éunder the mit license", "under the mit licenseé",
        "a " * 3000 + "Released under the MIT License." + " b" * 3000, "ccby nc", "license 3 version gnu general public"]))
    got = licenses.scan_licenses(documents(rows + [(None, rows[0][1]), (0, rows[0][1])]).withColumn("words", F.lit(1))).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        assert tuple(r)[1:] == plain_license(dict(rows)[r.doc_id or 0]), r.doc_id
    assert licenses.scan_licenses(documents([], 1)).count() == 0


def plain_wrapped(text):
    """Labels and best containment of every line and the words after it."""
    width = max(len(template.split()) for _, template in licenses.TEMPLATES)
    lines = [re.findall("[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+", line.lower()) for line in (text or "").split("\n")]
    score, labels = 0.0, {label for phrase, label in licenses.PHRASES
                          if f" {phrase} " in f" {' '.join(w for line in lines for w in line)} "}
    for i, line in enumerate(lines):
        block = {*line, *[w for after in lines[i + 1:] for w in after][:width - 1]} if line else set()
        for label, template in licenses.TEMPLATES:
            share = len(block & set(template.split())) / len(set(template.split()))
            if share >= licenses.THRESHOLD:
                labels, score = labels | {label}, max(score, share)
    return ",".join(sorted(labels)), score


def test_wrapped_licenses(documents):
    rng = random.Random(6)
    rows, expected = [], {}
    for label, template in licenses.TEMPLATES:
        for width in (1, 9, 24, 40, 72):
            for mark in ("", "# ", " * "):
                own = [f"own{rng.randrange(99)}" for _ in range(rng.randrange(6))]
                cut = "\n".join(mark + line for line in textwrap.wrap(" ".join(own + template.split() + own), width, break_long_words=False))
                expected[len(rows)] = label
                rows.append((len(rows), f"{mark}\n{cut}\n{mark.strip()}\nelse"))
    far = licenses.TEMPLATES[2][1].split()
    rows += [(900, None), (901, ""), (902, "\n \n"), (903, "one line only"), (904, "gnu general public\n" + "x " * 40 + "\nlicense version 3"),
             (905, "\n".join([" ".join(far[:10]), *["filler words here"] * 9, " ".join(far[10:])]))]
    df = documents(rows).withColumn("license_blocks", F.lit("mine"))
    got = {r.doc_id: r for r in licenses.scan_licenses(df, phrases=(("no such phrase", "none"),), wrapped=True).collect()}
    assert len(got) == len(rows) and all(label in got[d].labels.split(",") for d, label in expected.items())
    assert {d: r.labels for d, r in got.items() if d >= 900} == {d: "" for d in range(900, 906)}
    whole = {r.doc_id: r for r in licenses.scan_licenses(df, wrapped=True).collect()}
    for d, text in rows:
        labels, score = plain_wrapped(text)
        assert whole[d].labels == labels and got[d].score == score, d
    assert licenses.scan_licenses(documents([], 1), wrapped=True).count() == 0


# --- substring dedup --------------------------------------------------------

def plain_substring(rows, n):
    first, out = {}, []
    for doc, text in rows:
        w = WORD.findall(text or "")
        for i in range(len(w) - n + 1):
            if doc is not None:
                key = tuple(w[i:i + n])
                first[key] = min(first.get(key, doc), doc)
    for doc, text in rows:
        w = WORD.findall(text or "")
        gone = {j for i in range(len(w) - n + 1) for j in range(i, i + n) if doc is not None and first[tuple(w[i:i + n])] < doc}
        out.append((doc, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n, seed", [(6, 2), (12, 5), (12, 12)])
def test_substring_dedup_equals_plain_version(documents, n, seed):
    rng = random.Random(n * seed)
    pool = [[f"p{k}_{rng.randrange(9)}" for _ in range(rng.randrange(n - 2, 4 * n))] for k in range(6)] + [["same"] * 3 * n]
    rows = []
    for doc in range(90):
        w = []
        for _ in range(rng.randrange(5)):
            part = rng.choice(pool)
            a = rng.randrange(len(part))
            w += part[a:a + rng.randrange(len(part))] + [f"u{rng.randrange(3)}" for _ in range(rng.randrange(4))]
        rows.append((doc // 2 * 2 if doc % 9 == 0 else doc, "\n ".join(w)))
    rows += [(None, rows[5][1]), (200, None), (201, ""), rows[3], (1, " ".join(["same"] * 40)), (-5, rows[8][1])]
    got = substrings.remove_repeats(documents(rows).withColumn("ranges", F.lit(1)), n, seed).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == plain_substring(rows, n)
    assert all(sum(s.length for s in r.spans) == r.n_removed for r in got)
    assert substrings.remove_repeats(documents([], 1)).count() == 0


# --- decontamination --------------------------------------------------------

def plain_distance(pattern, text):
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for symbol in text:
        last, row[0] = row[0], 0
        for i, p in enumerate(pattern, 1):
            last, row[i] = row[i], min(row[i] + 1, row[i - 1] + 1, last + (p != symbol))
        best = min(best, row[-1])
    return best


@settings(max_examples=200, deadline=None)
@cases(st.lists(st.integers(0, 3), min_size=1, max_size=80), st.lists(st.integers(0, 3), max_size=60))
def test_bit_parallel_distance(pattern, text):
    errors, end = decontaminate.search(pattern, text)
    assert errors == plain_distance(pattern, text) == plain_distance(pattern, text[:end])


def test_matches_equal_search_of_everything(spark, documents):
    rng = random.Random(8)
    items = [(k, " ".join(f"v{rng.randrange(30)}" for _ in range(rng.randrange(1, 30)))) for k in range(20)]
    items += [(90, ""), (91, None), (92, "!!"), (93, items[0][1]), (None, items[1][1])]
    rows = []
    for doc in range(80):
        w = [f"v{rng.randrange(30)}" for _ in range(rng.randrange(30))]
        own = (rng.choice(items[:20])[1]).split()
        for _ in range(rng.randrange(len(own) // 4 + 2)):
            own[rng.randrange(len(own))] = "q"
        at = rng.randrange(len(w) + 1)
        rows.append((doc, ", ".join(w[:at] + own + w[at:]).upper()))
    rows += [(200, None), (201, ""), (None, items[2][1]), rows[0]]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    cut = lambda t: re.findall("[0-9a-z]+", (t or "").lower())
    expected = []
    for doc, text in rows:
        for item, own in items:
            if p := cut(own):
                errors = plain_distance(p, cut(text))
                if errors <= int(0.2 * len(p)):
                    expected.append((doc, item, errors))
    df = documents(rows).withColumn("item_id", F.lit("x"))
    for block_bytes in (1 << 20, 200):
        got = decontaminate.find_matches(df, benchmark, 0.2, block_bytes).collect()
        assert sorted(((r.doc_id, r.item_id, r.errors) for r in got), key=str) == sorted(expected, key=str)
    clean = decontaminate.drop_contaminated(df, benchmark, 0.2, 200)
    dirty = {(d, t) for d, t in rows if any(e[0] == d for e in expected)}
    assert clean.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=str) == sorted((r for r in rows if r not in dirty), key=str)
    assert decontaminate.find_matches(df, benchmark.where("false")).count() == 0
    assert decontaminate.drop_contaminated(df, benchmark.where("false")).count() == len(rows)


def test_components_grow_by_more_edges(spark):
    rng = random.Random(9)
    labels, links = None, []
    for _ in range(4):
        fresh = [(rng.randrange(60), rng.randrange(60)) for _ in range(15)]
        links += fresh
        labels = merge_components(labels, spark.createDataFrame(fresh, "a bigint, b bigint"))
        label = {n: n for pair in links for n in pair}
        for _ in label:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        got = {r.node: r.component for r in labels.collect()}
        alone = {n for pair in links for n in pair} - set(got)
        assert {**got, **{n: n for n in alone}} == label
    assert merge_components(None, spark.createDataFrame([(1, 1)], "a bigint, b bigint")) is None
