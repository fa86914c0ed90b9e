"""Chat formatting by prefix-target expansion: one training example for every assistant turn.

An example is the text of all turns up to and including one assistant turn; only that last reply
is trainable. A turn is written ``<s>[INST] role [/INST] text</s>``. Control strings inside roles
and texts are broken by a backslash after their first character, and backslashes are doubled, so
the format can be read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

START, END, OPEN, CLOSE = "<s>", "</s>", "[INST]", "[/INST]"
CONTROL = [START, END, OPEN, CLOSE]
HEAD = f"{START}{OPEN} "
MIDDLE = f" {CLOSE} "


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}\\{mark[1:]}"))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(HEAD), escape(role), F.lit(MIDDLE), escape(text), F.lit(END))


def expand_examples(turns: DataFrame) -> DataFrame:
    """Examples of a table (``conv_id``, ``turn``, ``role``, ``text``).

    Returns ``conv_id``, ``example`` (position of its last turn, from 1), ``formatted``,
    ``loss_start`` (code points before the trainable text), ``loss_chars`` (its code points, still
    escaped; null where nothing is trainable) and ``is_last``. A conversation whose last turn is
    no reply gets one more example without trainable text, so every turn is in the last example.

    Null roles and texts count as empty, null turns come first, rows with equal turn are ordered by
    role and text, repeated rows are repeated turns, rows without ``conv_id`` form one
    conversation. Other columns are ignored. A conversation has to fit a row, as it has to fit a
    training example; the expansion repeats each turn once per later reply.
    """
    row = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("rows"))
    n = F.size("rows")
    replies = F.filter(F.sequence(F.lit(1), n), lambda i: F.get("rows", i - 1)["role"] == "assistant")
    ends = F.array_distinct(F.concat(replies, F.array(n)))
    texts = whole.select(
        "conv_id", ends.alias("ends"), n.alias("n"), replies.alias("replies"),
        F.transform("rows", lambda r: format_turn(r["role"], r["text"])).alias("parts"),
        F.transform("rows", lambda r: F.length(escape(r["text"]))).alias("chars"))
    each = texts.select("conv_id", "n", "replies", "parts", "chars", F.explode("ends").alias("example"))
    formatted = F.array_join(F.slice("parts", F.lit(1), F.col("example")), "")
    is_reply = F.array_contains(F.col("replies"), F.col("example"))
    loss = F.when(is_reply, F.get("chars", F.col("example") - 1))
    out = each.select("conv_id", "example", formatted.alias("formatted"), loss.alias("loss_chars"),
                      (F.col("example") == F.col("n")).alias("is_last"))
    return out.select("conv_id", "example", "formatted",
                      (F.length("formatted") - len(END) - F.col("loss_chars")).alias("loss_start"),
                      "loss_chars", "is_last")


def loss_text(formatted: Column, start: Column, chars: Column) -> Column:
    """The trainable text of an example, unescaped; null where there is none."""
    return unescape(F.substring(formatted, start + 1, chars))


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.split(formatted, END)
    pieces = F.slice(pieces, F.lit(1), F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        cut = F.instr(piece, F.lit(MIDDLE))
        role = F.substring(piece, F.lit(len(HEAD) + 1), cut - len(HEAD) - 1)
        text = F.substring(piece, cut + len(MIDDLE), F.length(piece))
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(pieces, turn)
