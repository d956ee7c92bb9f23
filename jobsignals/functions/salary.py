"""Pay range read from free text, tried in three tiers.

1. range        "$100k - $140k", "100-140k"
2. starting at  "from $95k", "$80k+"
3. single       "$150k"

The first tier that gives a non-zero amount wins. Amounts are taken exactly as
the patterns cut them, which includes their known traps: "$100,000 - $140,000"
gives 100000 and 140, and "2020-2025" reads as pay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from jobsignals.fixed_values import (
    EUR_MARKS, GBP_MARKS, HOURLY_BELOW, HOURS_PER_YEAR, PAY_AMOUNT, PAY_RANGE_AMOUNT,
    PAY_SYMBOL, PAY_SYMBOLS, THOUSANDS_BELOW, WHITESPACE,
)
from jobsignals.functions.text import SPACE, any_sql, literal

# A symbol before the first amount is optional and not captured, so searching
# without it finds the same amounts and spares a test at every position.
RANGE = rf"({PAY_RANGE_AMOUNT}){SPACE}*-{SPACE}*{PAY_SYMBOL}?({PAY_RANGE_AMOUNT})"
FROM = rf"(?:from|starting at|\+){SPACE}*{PAY_SYMBOL}?({PAY_AMOUNT})\+?"
PLUS = rf"({PAY_AMOUNT})\+"
SINGLE = rf"{PAY_SYMBOL}({PAY_AMOUNT})"


def currency(text: str) -> str:
    return (f"CASE WHEN {any_sql(text, GBP_MARKS)} THEN 'GBP'"
            f" WHEN {any_sql(text, EUR_MARKS)} THEN 'EUR' ELSE 'USD' END")


def amount(token: str) -> str:
    """'140k' -> 140000; an empty token -> 0, which every tier passes over.

    The leading zero keeps the cast from ever failing: a failed one, even a
    tolerant one, builds and drops an exception per row.
    """
    return f"CAST(concat('0', replace({token}, 'k', '000')) AS BIGINT)"


def range_end(found: str, side: int) -> str:
    """Amount before (1) or after (-1) the dash of a matched range."""
    token = f"substring_index({found}, '-', {side})"
    return amount(f"translate({token}, {literal(PAY_SYMBOLS + WHITESPACE)}, '')")


def yearly(value: str, looked_at: str) -> str:
    """`value`, times the hours of a year when `looked_at` is an hourly rate."""
    return f"{value} * IF({looked_at} < {HOURLY_BELOW}, {HOURS_PER_YEAR}, 1)"


def first_amount(text: str, pattern: str) -> str:
    return f"regexp_extract({text}, {literal(pattern)}, 1)"


def with_salary(df: DataFrame, low: str = "low") -> DataFrame:
    """Add salary_min, salary_max, salary_avg, currency and pay_tier.

    Written as stacked projections so that each regex result is computed once
    and reused. Every regex sits behind a substring test, and a later tier is
    only looked at where the earlier ones gave nothing.
    """
    kept = df.columns
    steps = [
        {"_t": f"replace({low}, ',', '')"},
        # A matched range holds one dash, two amounts and otherwise only symbols
        # and blanks, so its ends are cut out without another regex.
        {"_range": f"IF(contains(_t, '-'), regexp_extract(_t, {literal(RANGE)}, 0), '')"},
        {"_lo": range_end("_range", 1), "_hi": range_end("_range", -1)},
        # "100-140k": the first amount is meant in thousands too.
        {"_lo": f"IF(_lo < {THOUSANDS_BELOW} AND _hi > {THOUSANDS_BELOW},"
                f" _lo * {THOUSANDS_BELOW}, _lo)",
         "_is_range": "_lo <> 0 AND _hi <> 0"},
        {"_from": f"IF(NOT _is_range AND {any_sql('_t', ['from', 'starting at', '+'])},"
                  f" {first_amount('_t', FROM)}, '')"},
        {"_start": amount(f"CASE WHEN _from <> '' THEN _from WHEN NOT _is_range AND"
                          f" contains(_t, '+') THEN {first_amount('_t', PLUS)} ELSE '' END")},
        {"_one": amount(f"IF(NOT _is_range AND _start = 0 AND {any_sql('_t', PAY_SYMBOLS)},"
                        f" {first_amount('_t', SINGLE)}, '')")},
        {"pay_tier": "CASE WHEN _is_range THEN 'range' WHEN _start <> 0 THEN 'starting_at'"
                     " WHEN _one <> 0 THEN 'single' ELSE 'none' END",
         # At most one of the two is non-zero.
         "_flat": "_start + _one"},
        # The hourly test looks at the lower end of a range only.
        {"salary_min": f"CASE WHEN _is_range THEN {yearly('_lo', '_lo')}"
                       f" WHEN _flat <> 0 THEN {yearly('_flat', '_flat')} END",
         "salary_max": f"CASE WHEN _is_range THEN {yearly('_hi', '_lo')}"
                       f" WHEN _flat <> 0 THEN {yearly('_flat', '_flat')} END",
         "currency": f"IF(pay_tier <> 'none', {currency('_t')}, NULL)"},
        # Whole-number midpoint; a midpoint of 0 would count as no salary.
        {"salary_avg": "nullif((salary_min + salary_max) DIV 2, 0)"},
    ]
    for step in steps:
        others = [c for c in df.columns if c not in step]
        df = df.selectExpr(*[f"`{c}`" for c in others],
                           *[f"{sql} AS {name}" for name, sql in step.items()])
    return df.select(*kept, "salary_min", "salary_max", "salary_avg", "currency", "pay_tier")
