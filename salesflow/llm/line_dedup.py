"""Line deduplication on content-defined chunks of lines.

Every line is hashed; a polynomial over the hashes of ``WINDOW`` lines rolls along the text, and where
it is divisible by ``divisor`` a chunk ends. Boundaries depend on those lines alone, so inserted or
removed lines shift no boundary but their own. Chunks of several lines that occur more than once in
all documents are compared byte by byte with their first occurrence, and all but that one are
removed. It finds a passage only as far as boundaries fall into it, and
lines of one-line chunks, so most of a run of equal lines, stay.

``passages=True`` compares every stretch of ``min_lines`` lines that are not blank, wherever it
begins, in place of chunks: no passage of so many lines is missed. op6 and the pipeline use this, since
no choice of chunk ends finds enough of the short passages (figures in the README).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesflow.session import stage

WINDOW = 3
MULTIPLIER = 1009
HEX_DIGITS = 7  # 28 bits: the polynomial stays inside a bigint


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, HEX_DIGITS), 16, 10).cast("bigint")


def chunk_ends(hashes: str, divisor: int) -> Column:
    """Positions (from 1) of the last line of every chunk of a text. ``hashes`` is a column of a frame
    of its own: an expression would be computed anew for every line."""
    n = F.size(hashes)

    def at_end(i: Column) -> Column:
        rolled = F.lit(0).cast("bigint")
        for back in range(WINDOW - 1, -1, -1):
            rolled = rolled * MULTIPLIER + F.get(hashes, i - 1 - back)
        return (i == n) | F.coalesce((i >= WINDOW) & (rolled % divisor == 0), F.lit(False))

    return F.filter(F.sequence(F.lit(1), n), at_end)


def _chunks(docs: DataFrame, divisor: int, min_lines: int) -> DataFrame:
    """Chunks with ``min_lines`` lines that are not blank: ``id``, ``version``, ``first`` line, ``n``
    lines, ``key``."""
    lines = docs.select("id", "version", F.split("body", "\n").alias("lines"))
    hashed = lines.select("id", "version", "lines", F.transform("lines", line_hash).alias("hashes"))
    ends = hashed.select("id", "version", "lines", chunk_ends("hashes", divisor).alias("ends"))
    firsts = F.concat(F.array(F.lit(1)), F.transform(F.slice("ends", F.lit(1), F.size("ends") - 1), lambda e: e + 1))
    spans = F.filter(F.arrays_zip(firsts.alias("first"), F.col("ends").alias("last")),
                     lambda c: c["last"] - c["first"] + 1 >= min_lines)
    each = ends.select("id", "version", "lines", F.explode(spans).alias("span")).select(
        "id", "version", F.col("span.first").alias("first"), (F.col("span.last") - F.col("span.first") + 1).alias("n"),
        F.slice("lines", F.col("span.first"), F.col("span.last") - F.col("span.first") + 1).alias("chunk"))
    worded = F.filter("chunk", lambda line: F.trim(line) != "")
    return each.where(F.size(worded) >= min_lines).select(
        "id", "version", "first", "n", F.md5(F.array_join("chunk", "\n").cast("binary")).alias("key"))


def _stretches(docs: DataFrame, min_lines: int) -> DataFrame:
    """Every stretch of ``min_lines`` lines that are not blank, with the blank ones between them; columns
    as of ``_chunks``. A text of n such lines has n - min_lines + 1, which overlap."""
    lines = docs.select("id", "version", F.split("body", "\n").alias("lines"))
    places = lines.select("id", "version", "lines", F.filter(
        F.sequence(F.lit(1), F.size("lines")), lambda i: F.trim(F.get("lines", i - 1)) != "").alias("places"))
    last = F.slice("places", F.lit(min_lines), F.size("places"))
    spans = F.filter(F.arrays_zip(F.col("places").alias("first"), last.alias("last")), lambda c: c["last"].isNotNull())
    each = places.select("id", "version", "lines", F.explode(spans).alias("span")).select(
        "id", "version", F.col("span.first").alias("first"), (F.col("span.last") - F.col("span.first") + 1).alias("n"),
        F.slice("lines", F.col("span.first"), F.col("span.last") - F.col("span.first") + 1).alias("stretch"))
    return each.select("id", "version", "first", "n",
                       F.unhex(F.md5(F.array_join("stretch", "\n").cast("binary"))).alias("key"))


def _same(left: DataFrame, right: DataFrame) -> Column:
    return left["id"].eqNullSafe(right["id"]) & (left["version"] == right["version"])


def repeated_chunks(docs: DataFrame, divisor: int = 3, min_lines: int = 2, passages: bool = False) -> DataFrame:
    """Occurrences to remove: ``id`` (``doc_id``), ``version`` (hash of the text), ``first`` line and
    ``n`` lines. See ``remove_repeated_lines``; written to the shared folder."""
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("version"), F.col("text").alias("body")
                       ).where("body IS NOT NULL")
    chunks = stage(_stretches(rows, min_lines) if passages else _chunks(rows, divisor, min_lines), "line-chunks")
    # written before it is joined: a join of two plain shuffles is one whose hot keys adaptive execution splits
    keys = stage(chunks.groupBy("key").agg(
        F.count("*").alias("times"), F.min(F.struct("id", "version", "first")).alias("kept")).where("times > 1"),
        "repeated-keys")
    held = chunks.join(keys, "key").withColumn(
        "is_kept", F.col("kept").eqNullSafe(F.struct("id", "version", "first")))
    by_doc = held.groupBy("id", "version").agg(
        F.collect_set(F.struct("first", "n", "key", "is_kept")).alias("spans")).alias("s")
    # both sides grow with the documents: a merge join at every size
    texts = rows.alias("r").join(by_doc.hint("merge"), F.col("r.id").eqNullSafe(F.col("s.id")) & (
        F.col("r.version") == F.col("s.version"))).select(
        "r.id", "r.version", F.split("body", "\n").alias("lines"), "spans")
    texts = texts.select("id", "version", "lines", F.explode("spans").alias("span"))  # split once a text, not once a span
    bodies = stage(texts.select("id", "version", "span.*", F.array_join(
        F.slice("lines", F.col("span.first"), F.col("span.n")), "\n").alias("chunk")), "line-bodies")
    kept = bodies.where("is_kept").select("key", F.col("chunk").alias("kept_chunk")).dropDuplicates(["key"])
    again = bodies.where("NOT is_kept").join(kept, "key").where(F.col("chunk") == F.col("kept_chunk"))
    return stage(again.select("id", "version", "first", "n").distinct(), "line-repeats")


def remove_repeated_lines(docs: DataFrame, divisor: int = 3, min_lines: int = 2,
                          removed: str | None = None, passages: bool = False) -> DataFrame:
    """``docs`` (``doc_id``, ``text`` and any others) with repeated chunks cut out of ``text``.

    A chunk counts if it has ``min_lines`` lines that are not blank. Its first occurrence, by
    ``doc_id`` (nulls first), hash of the text and line, stays; a chunk repeated inside a text goes too.
    Lines that stay are joined as they were; a text may become empty, but no row goes.
    ``removed`` names a column for the number of lines removed.

    With ``passages`` a line goes if it lies in a stretch of ``min_lines`` lines that are not blank, blank
    ones between them included, that stands earlier in the same or another document; ``divisor`` is
    not used. So the shortest passage that is surely found has ``min_lines`` such lines, and longer ones go
    whole. The first occurrence of every line stays: of a run of equal lines one line. Blank lines
    at the ends of a passage stay.

    Null texts stay null. Rows equal in ``doc_id`` and text are one document and fare alike. An empty
    table gives an empty table; other columns pass through under any name.
    """
    repeats = repeated_chunks(docs, divisor, min_lines, passages)
    spans = repeats.groupBy("id", "version").agg(F.collect_list(F.struct("first", "n")).alias("spans"))
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("version"))
    joined = rows.join(spans.hint("merge"), _same(rows, spans), "left").select("row", "spans")
    gone = F.array_distinct(F.flatten(F.transform(
        "spans", lambda s: F.sequence(s["first"], s["first"] + s["n"] - 1))))  # stretches overlap
    cut = joined.select("row", F.when(F.col("spans").isNotNull(), F.split("row.text", "\n")).alias("lines"),
                        gone.alias("gone"))
    places = F.array_except(F.sequence(F.lit(1), F.size("lines")), F.col("gone"))
    left = cut.select("row", "lines", "gone", F.when(F.col("lines").isNotNull(), places).alias("places"))
    text = F.when(F.col("places").isNull(), F.col("row.text")).otherwise(
        F.array_join(F.transform("places", lambda i: F.get("lines", i - 1)), "\n"))
    out = [text.alias(c) if c == "text" else F.col("row")[c].alias(c) for c in docs.columns]
    if removed:
        out.append(F.coalesce(F.size("gone"), F.lit(0)).cast("bigint").alias(removed))
    return left.select(*out)
