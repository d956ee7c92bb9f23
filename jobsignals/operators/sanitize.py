"""From raw posts to the posts worth reading."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignals.fixed_values import MIN_POST_CHARS, QUOTE_MARK
from jobsignals.functions.text import month_key, strip
from jobsignals.operators.dedupe import dedupe_ids, dedupe_month_text
from jobsignals.schemas import ALIASES, REQUIRED


class MissingColumn(ValueError):
    """A column without which the transform has no meaning is absent."""


def normalise(df: DataFrame, bad_dates: str = "raise") -> DataFrame:
    """Apply column aliases, require the key columns, type id and date.

    `bad_dates='null'` turns unreadable dates into nulls instead of failing.
    """
    for old, new in ALIASES.items():
        if new not in df.columns and old in df.columns:
            df = df.withColumnRenamed(old, new)
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise MissingColumn(f"required column(s) not found: {', '.join(missing)}")
    df = df.withColumn("id", F.col("id").cast("string"))
    if "date" in df.columns:
        date = F.col("date")
        df = df.withColumn("date", date.try_cast("date") if bad_dates == "null"
                           else date.cast("date"))
    return df


def long_enough(text: Column) -> Column:
    """At least 50 characters, counted before trimming; null fails."""
    return F.length(text) >= MIN_POST_CHARS


def is_quote(text: Column) -> Column:
    return strip(text).startswith(QUOTE_MARK)


def sanitize(df: DataFrame) -> DataFrame:
    """First row per id, then per month and text, minus short posts and quotes.

    The text filters run before the second de-duplication: all rows of one of
    its groups share their text, so the outcome is the same and the rows that
    go never reach that shuffle. They must not move before the first one, which
    may keep a short row for its id.
    """
    text = F.col("raw_text")
    df = dedupe_ids(df).filter(long_enough(text) & ~is_quote(text))
    return dedupe_month_text(df) if "date" in df.columns else df


def row_audit(df: DataFrame) -> DataFrame:
    """Rows left after each sanitation step, as (step_no, step, n_rows).

    Undated posts have no second de-duplication, so it drops none of them.
    """
    text, unique = F.col("raw_text"), dedupe_ids(df)
    # One row per surviving group of the second de-duplication; counts only.
    groups = (unique.groupBy(F.xxhash64(text).alias("_h"), month_key(F.col("date")).alias("_m"),
                             text).agg(F.count("*").alias("_n"))
              if "date" in df.columns else unique.withColumn("_n", F.lit(1)))
    kept = long_enough(text)
    after = groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("id_dedupe"),
        F.count("*").alias("text_dedupe"),
        F.count_if(kept).alias("length_filter"),
        F.count_if(kept & ~is_quote(text)).alias("quote_filter"),
    )
    steps = after.select(F.expr(
        "stack(4, 1, 'id_dedupe', id_dedupe, 2, 'text_dedupe', text_dedupe,"
        " 3, 'length_filter', length_filter, 4, 'quote_filter', quote_filter)"
        " AS (step_no, step, n_rows)"))
    first = df.agg(F.count("*").alias("n_rows")).select(
        F.lit(0).alias("step_no"), F.lit("input").alias("step"), "n_rows")
    return first.unionByName(steps)
