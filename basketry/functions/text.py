"""Rules text: normalisation and copy caps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode white space class, typographic quotes and their plain twins,
# the three phrases that change a copy cap, and the default cap.
SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]"
CURLY_QUOTES = "‘’“”"
PLAIN_QUOTES = "''\"\""
ANY_NUMBER = r"(?i)you may have any number of cards named"
UP_TO = r"(?i)you may have up to (\d+) copies of"
ONLY = r"(?i)you may only have (\d+) cop(?:y|ies) of"
DEFAULT_CAP = 4


def normalise_whitespace(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, SPACE + "+", " "))


def strip_reminder(text: Column) -> Column:
    """Drop every parenthesised reminder with the space before it."""
    return normalise_whitespace(F.regexp_replace(text, SPACE + r"*\([^)]*\)", ""))


def normalise_quotes(text: Column) -> Column:
    return F.translate(text, CURLY_QUOTES, PLAIN_QUOTES)


def normalise_text(text: Column) -> Column:
    return normalise_whitespace(normalise_quotes(strip_reminder(text)))


def max_copies(text: Column, default: int = DEFAULT_CAP) -> Column:
    """Copy cap of an item as double; infinity where any number is allowed."""
    raw = F.coalesce(text, F.lit(""))
    return (
        F.when(raw.rlike(ANY_NUMBER), F.lit(float("inf")))
        .when(raw.rlike(UP_TO), F.regexp_extract(raw, UP_TO, 1).try_cast("double"))
        .when(raw.rlike(ONLY), F.regexp_extract(raw, ONLY, 1).try_cast("double"))
        .otherwise(F.lit(float(default)))
    )


def has_text(text: Column) -> Column:
    """Corpus filter: not empty before and after normalising."""
    return (F.length(text) > 0) & (F.length(normalise_text(text)) > 0)
