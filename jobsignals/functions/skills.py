"""Skill mentions against a dictionary of spellings."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignals.fixed_values import SKILLS
from jobsignals.functions.text import literal, literals, word_sql


def plain_words(dictionary: Mapping[str, Iterable[str]]) -> dict[str, list[str]]:
    """Spelling -> skills, for spellings of word characters only."""
    words: dict[str, list[str]] = {}
    for skill, spellings in dictionary.items():
        for s in spellings:
            if re.fullmatch(r"\w+", s):
                words.setdefault(s, []).append(skill)
    return words


def phrases(spellings: Iterable[str]) -> list[str]:
    """Spellings with a blank, dot, sign or hyphen in them."""
    return [s for s in spellings if not re.fullmatch(r"\w+", s)]


def known_tokens(low: Column, words: Iterable[str]) -> Column:
    """Those of `words` that occur as a whole word, found in one pass.

    A spelling of word characters stands between word boundaries exactly when
    it is a maximal run of them, so one split and one hash intersection replace
    a regex search per spelling.
    """
    return F.array_intersect(F.split(low, r"(?U)\W+"), F.expr(f"array({literals(words)})"))


def with_skills(df: DataFrame, low: str = "low", name: str = "tech_stack",
                dictionary: Mapping[str, Sequence[str]] = SKILLS) -> DataFrame:
    """Add the sorted array of skills mentioned; empty when there are none."""
    words, parts = plain_words(dictionary), []
    if words:
        skills_of = F.expr("map(" + ", ".join(
            f"{literal(word)}, array({literals(skills)})" for word, skills in words.items()) + ")")
        df = df.withColumn("_tokens", known_tokens(F.col(low), sorted(words)))
        parts.append(F.flatten(F.transform("_tokens", lambda w: F.element_at(skills_of, w))))
    by_phrase = [f"CASE WHEN {word_sql(low, p)} THEN {literal(skill)} ELSE '' END"
                 for skill, spellings in dictionary.items() if (p := phrases(spellings))]
    if by_phrase:
        parts.append(F.expr(f"array({', '.join(by_phrase)})"))
    # array_except drops misses and repeats in compiled code; a filter with a
    # lambda would have all its inputs interpreted.
    found = F.array_except(F.concat(*parts), F.expr("array('')"))
    return df.withColumn(name, F.sort_array(found)).drop("_tokens")
