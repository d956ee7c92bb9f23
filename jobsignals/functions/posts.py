"""Role, company, title, seniority and the boolean signals of a post."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobsignals.fixed_values import (
    AI_MODEL_WORDS, COMPANY_MAX_CHARS, FLAG_GROUPS, REMOTE_WORD, ROLE_FALLBACK, ROLES,
)
from jobsignals.functions.text import SPACE, any_sql, has_any, literal, strip


def role(low: str) -> Column:
    """First role class, in priority order, with a keyword in the text."""
    cases = " ".join(f"WHEN {any_sql(low, words)} THEN {literal(name)}"
                     for name, words in ROLES.items())
    return F.expr(f"CASE {cases} ELSE {literal(ROLE_FALLBACK)} END")


def _parts(clean: Column) -> Column:
    # Three pieces are enough to tell the first two apart from the rest.
    return F.split(clean, r"\|", 3)


def company(clean: Column) -> Column:
    """Text before the first '|' when short; may be '', null without a '|'."""
    first = strip(F.get(_parts(clean), F.lit(0)))
    return F.when(clean.contains("|") & (F.length(first) < COMPANY_MAX_CHARS), first)


def role_title(clean: Column) -> Column:
    return F.when(clean.contains("|"), strip(F.get(_parts(clean), F.lit(1))))


def years_experience(low: str) -> Column:
    """First '<n> year(s)' in the text, ASCII digits."""
    found = F.regexp_extract(low, rf"(\d+)\+?{SPACE}*years?", 1)
    return F.when(has_any(low, ["year"]), found.try_cast("bigint"))


def is_remote(low: str) -> Column:
    return has_any(low, [REMOTE_WORD])


def flags(low: str, *groups: str) -> dict[str, Column]:
    """Flag name -> expression, for the named groups or all of them."""
    return {name: has_any(low, words)
            for group in (groups or FLAG_GROUPS)
            for name, words in FLAG_GROUPS[group].items()}


def combos(low: str, tech_stack: Column, is_crypto: Column) -> dict[str, Column]:
    return {
        "tech_combo_ai": F.array_contains(tech_stack, "Python") & has_any(low, AI_MODEL_WORDS),
        "tech_combo_blockchain": F.array_contains(tech_stack, "Rust") & is_crypto,
    }
