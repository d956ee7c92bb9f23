"""Text primitives shared by every extractor."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsignals.fixed_values import EXCERPT_CHARS, WHITESPACE

# \s only covers ASCII blanks in Java; this class matches what strip() strips.
SPACE = (r"[\s\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def strip(text: Column) -> Column:
    """Both-ends trim of every Unicode blank, newlines included."""
    return F.trim(text, F.lit(WHITESPACE))


def clean(text: Column) -> Column:
    return F.coalesce(strip(text), F.lit(""))


def excerpt(text: Column, chars: int = EXCERPT_CHARS) -> Column:
    return F.substring(text, 1, chars)


def literal(text: str) -> str:
    """`text` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def literals(words: Iterable[str]) -> str:
    return ", ".join(map(literal, words))


def any_sql(low: str, words: Iterable[str]) -> str:
    return "(" + " OR ".join(f"contains({low}, {literal(w)})" for w in words) + ")"


def has_any(low: str, words: Iterable[str]) -> Column:
    """True when any of `words` occurs anywhere in the lower-cased column.

    Word lists are spelled as one SQL expression: parsing it once is far
    cheaper for the driver than a call per word.
    """
    return F.expr(any_sql(low, words))


def word_sql(low: str, words: Iterable[str]) -> str:
    """True when one of `words` occurs between word boundaries.

    The plain substring test goes first: it is a byte scan that rejects most
    rows before the regex engine is entered.
    """
    either = "|".join(map(re.escape, words))
    pattern = literal(rf"(?U)\b(?:{either})\b")
    return f"({any_sql(low, words)} AND {low} RLIKE {pattern})"


def month_key(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")


def first_group(text: Column, pattern: str, group: int = 1) -> Column:
    """First match's group, or null (not '') when nothing matches."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))
