"""Text expressions: normalisation and the keys cut out of labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from salesflow.names import ACCENTED, MONTH_CODES, UNACCENTED


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_text(c: Column | str) -> Column:
    """Plain, trimmed, upper-case text. Only the Spanish accents and ñ are folded.

    Text of single-byte characters has nothing to fold and skips the translation.
    """
    text = _col(c)
    plain = F.octet_length(text) == F.char_length(text)
    return F.upper(F.trim(F.when(plain, text).otherwise(F.translate(text, ACCENTED, UNACCENTED))))


def clean_key(c: Column | str) -> Column:
    return F.upper(F.trim(_col(c)))


def zone_code(seller: Column | str) -> Column:
    """``Pharma - Z1`` -> ``Z1``: the second part, null when there is no dash."""
    return F.trim(F.get(F.split(_col(seller), "-"), F.lit(1)))


def family_key(name: Column | str) -> Column:
    """First word of a product or family name."""
    return F.trim(F.get(F.split(_col(name), " "), F.lit(0)))


def month_number(code: Column | str) -> Column:
    """Three-letter month code -> 1..12; null for anything else."""
    position = F.array_position(F.array(*[F.lit(m) for m in MONTH_CODES]), clean_key(code))
    return F.nullif(position, F.lit(0).cast("bigint")).cast("int")


def month_code(number: Column | str) -> Column:
    codes = F.array(*[F.lit(m) for m in MONTH_CODES])
    return F.get(codes, _col(number).cast("int") - 1)
