"""Text and number clean-up."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(text: Column, strip: str = ",$%") -> Column:
    """Number in a formatted text ("$1,234.50", "12.5%"); NULL when there is none."""
    kept = F.translate(text.cast("string"), strip, "")
    return F.nullif(F.trim(kept), F.lit("")).try_cast("double")


def clean_text(text: Column, unicode: bool = False) -> Column:
    """Drop punctuation. Without ``unicode`` accented letters go too, as ASCII ``\\w`` has it."""
    return F.regexp_replace(text, r"(?U)[^\w\s]" if unicode else r"[^\w\s]", "")


def clean_symbol(symbol: Column) -> Column:
    return F.upper(F.trim(symbol))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def word_count(*texts: Column, rules: str = "warehouse") -> Column:
    """Words between single blanks, over all texts.

    ``stream``: an empty text counts one word and a NULL makes the count NULL.
    ``warehouse``: empty and NULL texts count nothing.
    """
    if rules not in ("stream", "warehouse"):
        raise ValueError(f"unknown word count rules: {rules}")

    def words(text: Column) -> Column:
        spaces = F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))
        if rules == "stream":
            return spaces + 1
        return F.when(text.isNull() | (text == ""), 0).otherwise(spaces + 1)

    return reduce(lambda a, b: a + b, [words(text) for text in texts])


def to_time(text: Column) -> Column:
    """Timestamp from ISO text or from epoch seconds written as text; else NULL.

    The digits are tested first: a failing number cast costs an exception per row.
    """
    seconds = F.timestamp_seconds(text.try_cast("bigint"))
    return F.when(text.rlike(r"^-?\d{1,11}$"), seconds).otherwise(text.try_cast("timestamp"))


def to_long(text: Column) -> Column:
    """Whole number from text; "5.0E7" counts, its fraction is cut."""
    whole = text.try_cast("bigint")
    return F.when(text.rlike(r"^-?\d{1,18}$"), whole).otherwise(
        text.try_cast("double").try_cast("bigint"))
