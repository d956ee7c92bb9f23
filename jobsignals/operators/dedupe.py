"""Keep-first de-duplication that stays even under hot keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignals.functions.text import month_key


def keep_first(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first in `order`. Null keys form one group.

    `row_number() == 1` is planned as a window group limit, which drops all but
    one row per key inside every map task. However hot a key is, at most one of
    its rows per map task crosses the shuffle, and the reducer streams them.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_nth", first).filter("_nth = 1").drop("_nth")


def dedupe_ids(df: DataFrame, date: str | None = "date", text: str = "raw_text") -> DataFrame:
    """First row per id, by date, then text, user and url."""
    order = [F.col(c) for c in (date, text, "user", "url") if c and c in df.columns]
    return keep_first(df, [F.col("id")], order or [F.col("id")])


def dedupe_month_text(df: DataFrame, date: str = "date", text: str = "raw_text",
                      id: str = "id") -> DataFrame:
    """First row, by id, per calendar month and exact text.

    The hash leads the key so that rows are sorted by an 8-byte prefix; the text
    itself stays in the key, so two texts with one hash are still kept apart.
    """
    keys = [F.xxhash64(text), month_key(F.col(date)), F.col(text)]
    return keep_first(df, keys, [F.col(id)])


def distinct_ids(df: DataFrame, id: str = "id") -> DataFrame:
    return df.select(F.col(id).cast("string").alias("id")).distinct()
