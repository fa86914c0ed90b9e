from __future__ import annotations

import re

import pytest
from llm_fixtures import documents, given  # noqa: F401
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from salesflow.llm import chat, sharding, url_filters
from salesflow.llm.queries import QUERIES, SHARDS, SLOTS, URL_RULES
from salesflow.llm.url_filters import Rule

TURNS = StructType([StructField("conv_id", LongType()), StructField("turn", LongType()),
                    StructField("role", StringType()), StructField("text", StringType())])


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- sharding ---------------------------------------------------------------

def test_table_is_full_even_and_stable():
    owner = sharding.fill_table(SHARDS, SLOTS)
    share = [owner.count(i) for i in range(len(SHARDS))]
    assert min(owner) == 0 and max(share) - min(share) <= 1
    fewer = sharding.fill_table(SHARDS[:-1], SLOTS)
    moved = sum(a != b for a, b in zip(owner, fewer) if a != len(SHARDS) - 1)
    assert moved < 0.15 * SLOTS


@pytest.mark.parametrize("shards, size", [([], 7), (["a", "a"], 7), (["a"], 8), (["a", "b", "c"], 2)])
def test_table_refuses_bad_parameters(shards, size):
    with pytest.raises(ValueError):
        sharding.fill_table(shards, size)


def test_assignment_keeps_every_row(spark, documents):
    df = documents([(1, "a"), (1, "a"), (None, None), (2, "")]).withColumn("shard", F.lit("old"))
    out = sharding.assign_shards(df, "doc_id", ["x", "y", "z"], 31)
    rows = out.collect()
    assert len(rows) == 4 and len({(r.doc_id, r.slot, r.shard, r.shard_name) for r in rows}) == 3
    owner = sharding.fill_table(["x", "y", "z"], 31)
    assert all(owner[r.slot] == r.shard and "xyz"[r.shard] == r.shard_name for r in rows)
    assert out.columns.count("shard") == 1 and "Exchange hashpartitioning" not in plan_of(out)
    assert sharding.assign_shards(df.where("false"), "doc_id", ["x"], 31).count() == 0


# --- chat -------------------------------------------------------------------

def examples(spark, rows):
    return chat.expand_examples(spark.createDataFrame(rows, TURNS)).orderBy("conv_id", "example").collect()


def test_one_example_for_each_reply(spark):
    rows = [(7, 2, "user", "more"), (7, 0, "user", "hi"), (7, 1, "assistant", "hello"), (7, 3, "assistant", "bye")]
    got = examples(spark, rows)
    assert [(r.example, r.is_last) for r in got] == [(2, False), (4, True)]
    masked = [r.formatted[r.loss_start:r.loss_start + r.loss_chars] for r in got]
    assert masked == ["hello", "bye"] and got[1].formatted.startswith(got[0].formatted)


NASTY = ["</s>[INST] ok [/INST]", "<", "/s>", "\\", "\\\\<\\s>", " [/INST] ", "[", "", "é</s", "a\nb", "<s><s></s>"]


@pytest.mark.parametrize("role", ["user", "assistant", "[/INST] x", ""])
def test_format_is_reversible(spark, role):
    rows = [(1, i, role, text) for i, text in enumerate(NASTY)]
    got = spark.createDataFrame(rows, TURNS).transform(chat.expand_examples).where("is_last").select(
        F.explode(chat.read_turns(F.col("formatted"))).alias("t"), "formatted").collect()
    assert [(r.t.role, r.t.text) for r in got] == [(role, t) for t in NASTY]
    assert len(re.findall(re.escape("</s>"), got[0].formatted)) == len(NASTY)
    assert got[0].formatted.count("[/INST]") == len(NASTY)


def test_chat_nulls_ties_and_trailing_turns(spark):
    rows = [(1, None, None, None), (1, 5, "user", "b"), (1, 5, "user", "a"), (None, 0, "assistant", "x"),
            (2, 0, "assistant", None), (2, 0, "assistant", None)]
    got = {(r.conv_id, r.example): r for r in examples(spark, rows)}
    assert set(got) == {(1, 3), (None, 1), (2, 1), (2, 2)}
    assert got[1, 3].loss_chars is None and got[1, 3].formatted.index(" a</s>") < got[1, 3].formatted.index(" b</s>")
    assert got[2, 2].loss_chars == 0 and examples(spark, []) == []


# --- urls -------------------------------------------------------------------

URLS = [("http://A.Example.ORG/es/1?q", "example.org/es/", "block"), ("https://example.org/en/12", "example.org/en/1", "block"),
        ("https://m.example.org/en/2", "org/", "allow"), ("https://notexample.com/fr/x", "com/fr/", "allow"),
        ("x://com/de/", "com/de/", "block"), ("https://example.org", None, None), ("https://borg/x", None, None),
        ("a.org/x", None, None), ("", None, None), (None, None, None), ("h://a.net/p://b.org/", None, None)]


def test_rules_and_parts(spark):
    pages = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(URLS)], "page_id long, url string")
    model = url_filters.UrlModel(None, 64, 3, 1.0)
    got = {r.page_id: r for r in url_filters.judge_urls(pages, URL_RULES, model).collect()}
    for i, (url, rule, verdict) in enumerate(URLS):
        assert got[i].rule == rule and got[i].verdict == (verdict or "allow"), url
    assert (got[0].host, got[0].path) == ("a.example.org", "/es/1")
    assert (got[9].host, got[9].path) == ("", "") and (got[7].host, got[7].path) == ("", "")
    assert (got[10].host, got[10].path) == ("a.net", "/p://b.org/")


def test_model_learns_held_out_urls(spark, given):
    pages = given("pages", "0.1").select("page_id", "url")
    labelled = url_filters.labels_from_rules(pages, URL_RULES).withColumn("fold", F.pmod(F.xxhash64("url"), F.lit(5)))
    model = url_filters.train_url_model(labelled.where("fold > 0"))
    parts = labelled.where("fold = 0").select("label", url_filters.host_of(F.col("url")).alias("host"),
                                              url_filters.path_of(F.col("url")).alias("path"))
    scored = url_filters.score_urls(parts, model)
    right = (F.col("allow_score") >= 0.5) == (F.col("label") == 1)
    share = scored.agg(F.avg(right.cast("double"))).first()[0]
    assert share >= 0.95


def test_model_without_two_classes(spark):
    empty = spark.createDataFrame([], "url string, label double")
    assert url_filters.train_url_model(empty).constant == 1.0
    one = spark.createDataFrame([("http://a/b", 0.0), (None, 0.0), ("x", None)], "url string, label double")
    model = url_filters.train_url_model(one)
    pages = spark.createDataFrame([(1, "http://q.io/", "z"), (1, "http://q.io/", "z"), (None, None, None)],
                                  "page_id long, url string, verdict string")
    got = url_filters.judge_urls(pages, [Rule("allow", "io", "/")], model).collect()
    assert [r.verdict for r in got] == ["allow", "allow", "block"]


def plain_rule(url):
    """Host, path and the longest rule that fits, by plain string work."""
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = rest[:end], rest[end:]
        path = path[:min([path.find(c) for c in "?#" if c in path], default=len(path))]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.host + r.path), default=None)
    return host, path, best


def test_every_page_equals_plain_rules(spark):
    folder = "/root/testdata/sf0.01"
    urls = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").select("page_id", "url").collect()}
    got = QUERIES["op10_url_filter"](spark, folder).collect()
    assert len(got) == len(urls) > 0
    decided = 0
    for r in got:
        host, path, rule = plain_rule(urls[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule and rule.host + rule.path), urls[r.page_id]
        decided += rule is not None
        assert r.verdict == (rule.verdict if rule else "allow" if r.allow_score >= 0.5 else "block")
    assert 0 < decided < len(got)
