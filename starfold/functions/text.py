"""Column expressions for dirty text, codes and dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their replacements, aligned one to one.
ACCENTED = "ãâäöüẞáäçčďéěíĺľňóôõŕšťúůýžÄÖÜẞÁÃÂÄÇČĎÉĚÍĹĽŇÓÔÕŔŠŤÚŮÝŽṔ"
PLAIN = "aaaousaaccdeeillnooorstuuyzAOUSAAAACCDEEILLNOOORSTUUYZP"

# Letters the default map leaves alone; folded with ``fold="full"``.
ACCENTED_MORE = "àèìòùêîûëïñÀÈÌÒÙÊÎÛËÏÑß"
PLAIN_MORE = "aeioueiueinAEIOUEIUEINs"

# Texts that mean "no value", compared after trimming and folding.
NULL_TOKENS = ("None", "", "N/A", "Pendente Identificacao")


def fold_accents(text: Column, fold: str = "default") -> Column:
    """Replace accented letters.

    Every mapped letter is outside ASCII, so a text with one byte per character
    cannot change and skips the letter-by-letter ``translate``.
    """
    source, target = ACCENTED, PLAIN
    if fold == "full":
        source, target = source + ACCENTED_MORE, target + PLAIN_MORE
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, text).otherwise(F.translate(text, source, target))


def null_token(text: Column) -> Column:
    """Null for the texts that mean "no value"."""
    return F.when(~text.isin(*NULL_TOKENS), text)


def digits_to_date(text: Column) -> Column:
    """The first eight digits of a text read as yyyyMMdd; null if that is no date."""
    digits = F.substring(F.regexp_replace(text, "[^0-9]", ""), 1, 8)
    return F.try_to_date(digits, "yyyyMMdd")


def canonical_code(code: Column) -> Column:
    """One spelling per numeric code ('0355' and 355 become '355'); other texts stay."""
    text = code.cast("string")
    return F.coalesce(text.try_cast("bigint").cast("string"), text)
