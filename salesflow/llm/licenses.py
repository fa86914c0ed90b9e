"""License scans: an exact set-similarity join of text blocks with license templates.

A block is a line, or with ``wrapped``, as in op5 and its SQL, a line and the words after it, so that no line end
cuts a notice. A template is a short notice; both are sets of words. A block matches a template
when it holds at least ``threshold`` of the template's words. Template words are ordered by the
number of blocks that hold them, rarest first, counted over all documents. A template of n words
that needs m of them has n - m + 1 words in its prefix; a block with none of these cannot match.
Then a block must have m template words at all (length) and enough of them from its first prefix
word on (position). What passes is counted exactly. The templates, a parameter, travel as literals.

Beside that, fixed phrases are found wherever their words stand in a row.
"""

from __future__ import annotations

import math
import string
from collections import Counter, defaultdict
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Notices of public licenses and the labels they stand for.
TEMPLATES = (
    ("apache-2", "licensed under the apache license version 2 0"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software "
            "and associated documentation files"),
    ("gpl-2", "gnu general public license version 2"),
    ("gpl-3", "gnu general public license version 3"),
    ("lgpl-3", "gnu lesser general public license version 3"),
    ("agpl-3", "gnu affero general public license version 3"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
            "provided that the following conditions are met"),
    ("mpl-2", "subject to the terms of the mozilla public license v 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc0", "cc0 1 0 universal public domain dedication"),
)
PHRASES = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))

THRESHOLD = 0.9
BREAKS_IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"  # ASCII without line break, digits, a-z


def strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)) if values else F.array().cast("array<string>")


def spaced(text: Column) -> Column:
    """A-Z lower-cased, what separates words turned to one space, line breaks kept."""
    lower = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.regexp_replace(lower, BREAKS_IN_LINE, " ")


def wrapped_blocks(docs: DataFrame, width: int) -> DataFrame:
    """``docs`` with ``license_blocks``: every line of ``license_spaced`` that has words, followed by the first
    ``width - 1`` words of the lines after it. Any ``width`` words in a row lie in one of them."""
    trimmed = F.transform(F.split("license_spaced", "\n"), lambda line: F.trim(line))
    lines = docs.withColumn("license_lines", F.filter(trimmed, lambda line: line != ""))
    heads = lines.withColumn("license_heads", F.transform(
        "license_lines", lambda line: F.substring_index(line, " ", width - 1)))

    def block(line: Column, i: Column) -> Column:
        after = F.array_join(F.slice("license_heads", i + 2, width - 1), " ")
        return F.concat_ws(" ", line, F.substring_index(after, " ", width - 1))

    # the heads are asked for twice, which keeps them a column: inside the lambda they would be made for every line
    blocks = F.when(F.size("license_heads") > 1, F.transform("license_lines", block)).otherwise(F.col("license_lines"))
    return heads.withColumn("license_blocks", blocks).drop("license_lines", "license_heads")


def block_words(line: Column, known: Sequence[str]) -> Column:
    """The words of ``known`` that a line holds, in the order of ``known``."""
    return F.array_intersect(strings(known), F.split(line, " "))


def word_order(lines: DataFrame, words: Sequence[str]) -> list[str]:
    """``words`` by the number of blocks of all documents that hold them, rarest first. One count a
    template word comes to the driver."""
    held = lines.select(F.explode(F.flatten(F.transform(F.split("spaced", "\n"),
                                                        lambda line: block_words(line, words)))).alias("word"))
    counts = Counter({r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()})
    return sorted(words, key=lambda w: (counts[w], w))


def needed(n: int, threshold: float) -> int:
    return max(1, math.ceil(threshold * n - 1e-9))


def matches(words: Column, templates: Sequence[tuple[str, str]], order: Sequence[str],
            threshold: float) -> Column:
    """Array of (``label``, ``containment``) for the template words of a block, given in ``order``."""
    rank = {w: i for i, w in enumerate(order)}
    index: dict[str, list[int]] = defaultdict(list)
    table = []
    for k, (label, text) in enumerate(templates):
        own = sorted(set(text.split()), key=rank.__getitem__)
        least = needed(len(own), threshold)
        for word in own[:len(own) - least + 1]:
            index[word].append(k)
        table.append(F.struct(F.lit(label).alias("label"), strings(own).alias("words"),
                              F.lit(least).alias("least"), strings(own[:len(own) - least + 1]).alias("prefix")))
    prefixes = sorted(index, key=rank.__getitem__)
    by_word = F.create_map(*[x for w in prefixes for x in (F.lit(w), F.array(*map(F.lit, index[w])))])
    templates_column = F.array(*table)
    seeds = F.array_intersect(words, strings(prefixes))
    candidates = F.array_distinct(F.flatten(F.transform(seeds, lambda w: F.element_at(by_word, w))))

    def judged(k: Column) -> Column:
        template = F.get(templates_column, k)
        first = F.array_position(words, F.get(F.array_intersect(words, template["prefix"]), F.lit(0)))
        possible = F.size(words) - first + 1
        hits = F.when(possible >= template["least"], F.size(F.array_intersect(words, template["words"])))
        return F.struct(template["label"].alias("label"), (hits / F.size(template["words"])).alias("containment"),
                        (hits >= template["least"]).alias("met"))

    none = F.array().cast("array<struct<label:string,containment:double,met:boolean>>")
    found = F.when(F.size(seeds) > 0, F.transform(candidates, judged)).otherwise(none)
    return F.filter(found, lambda m: m["met"])


def match_blocks(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
                 threshold: float = THRESHOLD, wrapped: bool = False) -> DataFrame:
    """``docs`` (with ``text``) and ``license_spaced``, ``license_matches``: for all blocks of the row in
    order, (``label``, ``containment``) of each template met. ``wrapped`` blocks reach as many words beyond
    their line as the longest template needs; they overlap, so a template may be met in several. No row or block is compared with another
    row; there is no shuffle but that of the counts. Null and empty texts match nothing."""
    words = sorted({w for _, text in templates for w in text.split()})
    order = word_order(docs.select(spaced(F.col("text")).alias("spaced")), words)
    rows, blocks = docs.withColumn("license_spaced", spaced(F.col("text"))), F.split("license_spaced", "\n")
    if wrapped:
        rows = wrapped_blocks(rows, max((len(text.split()) for _, text in templates), default=1))
        blocks = F.col("license_blocks")
    found = F.flatten(F.transform(blocks, lambda line: matches(
        block_words(line, order), templates, order, threshold)))
    return rows.withColumn("license_matches", found).drop("license_blocks")


def _count_words(piece: Column) -> Column:
    return F.size(F.filter(F.split(piece, " "), lambda w: w != ""))


def scan_licenses(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES,
                  phrases: Sequence[tuple[str, str]] = PHRASES, threshold: float = THRESHOLD,
                  wrapped: bool = False) -> DataFrame:
    """One row for every row of ``docs`` (``doc_id``, ``text``).

    ``n_words``; ``n_base``, ``first_word``, ``last_word``: places of phrases, the smallest and the
    largest start (words from 0, null without one); ``base_labels``; ``labels``: those and the labels of
    templates met, distinct, sorted, joined by commas (empty without one); ``score``: the largest
    containment met, 1 with a phrase, else 0. Templates are looked for in single lines, with ``wrapped``
    also across line ends. Null texts count as empty, repeated rows are judged
    alike, other columns are ignored.
    """
    rows = match_blocks(docs.select("doc_id", "text"), templates, threshold, wrapped)
    # two spaces between words: each has its own on either side, so neighbouring phrases do not share one
    trimmed = F.trim(F.regexp_replace("license_spaced", "[ \n]+", "  "))
    rows = rows.select("doc_id", "license_matches", trimmed.alias("words"))
    gaps = F.length("words") - F.length(F.replace("words", F.lit("  "), F.lit(" ")))
    rows = rows.select("doc_id", "license_matches", F.when(F.col("words") == "", 0).otherwise(gaps + 1).alias("n"),
                       F.concat(F.lit("  "), "words", F.lit("  ")).alias("words"))
    places = []
    for phrase, label in phrases:
        size, mark = len(phrase.split()), f" {'  '.join(phrase.split())} "
        pieces = F.split("words", mark, -1)
        first = _count_words(F.get(pieces, F.lit(0)))
        last = F.col("n") - size - _count_words(F.get(pieces, F.size(pieces) - 1))
        places.append(F.when(F.contains("words", F.lit(mark)), F.struct(
            F.lit(label).alias("label"), (F.size(pieces) - 1).alias("places"), first.alias("first"),
            last.alias("last"))))
    found = rows.select("doc_id", "n", "license_matches", F.array_compact(F.array(*places)).alias("found"))
    base = F.transform("found", lambda x: x["label"])
    labels = F.concat(base, F.transform("license_matches", lambda m: m["label"]))
    best = F.array_max(F.transform("license_matches", lambda m: m["containment"]))
    return found.select(
        "doc_id", F.col("n").cast("bigint").alias("n_words"),
        F.aggregate("found", F.lit(0).cast("bigint"), lambda a, x: a + x["places"]).alias("n_base"),
        F.array_min(F.transform("found", lambda x: x["first"])).cast("bigint").alias("first_word"),
        F.array_max(F.transform("found", lambda x: x["last"])).cast("bigint").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(labels)), ",").alias("labels"),
        F.when(F.size("found") > 0, 1.0).otherwise(F.coalesce(best, F.lit(0.0))).alias("score"))
