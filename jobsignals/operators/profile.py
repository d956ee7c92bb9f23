"""Descriptive statistics and data-quality views."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsignals.fixed_values import SEED
from jobsignals.functions.text import excerpt
from jobsignals.operators.pay import weighted_quartiles


def numeric_summary(df: DataFrame, column: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles.

    Meant for whole-number columns with a bounded domain, such as salaries and
    years: rows are first combined to one per value, on the map side, and every
    figure is an exact weighted aggregate over those.
    """
    v, n = F.col("_v"), F.col("_n")
    counts = (df.select(F.col(column).cast("bigint").alias("_v")).filter("_v IS NOT NULL")
              .groupBy("_v").agg(F.count("*").alias("_n")))
    wide, total = v.cast("decimal(19,0)"), F.col("_count").cast("double")
    sums = counts.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("_count"),
        F.sum(wide * n.cast("decimal(18,0)")).cast("double").alias("_s1"),
        F.sum((v * v).cast("decimal(19,0)") * n.cast("decimal(18,0)")).cast("double").alias("_s2"),
        F.min(v).alias("min"), weighted_quartiles(v, n).alias("_q"), F.max(v).alias("max"))
    mean = F.try_divide(F.col("_s1"), total)
    variance = F.try_divide(F.col("_s2") - F.col("_s1") * mean, total - 1)
    return sums.select(
        F.lit(column).alias("column"), F.col("_count").alias("count"), mean.alias("mean"),
        F.sqrt(variance).alias("std"), "min", F.col("_q")[0].alias("q25"),
        F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"), "max")


def value_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value; null is a value."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, k: int) -> DataFrame:
    """The k most frequent non-null values; ties by value."""
    return (value_counts(df.filter(F.col(column).isNotNull()), column)
            .orderBy(F.desc("n"), column).limit(k))


def non_null_counts(df: DataFrame) -> DataFrame:
    """Rows, non-null and null count of every column, from one pass."""
    one = df.agg(F.count("*").alias("_rows"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col("_rows").alias("n_rows"),
                 F.col(c).alias("non_null"), (F.col("_rows") - F.col(c)).alias("nulls"))
        for c in df.columns])))


def schema_table(df: DataFrame) -> list[tuple[str, str, bool]]:
    return [(f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields]


def head(df: DataFrame, n: int, key: str = "id") -> DataFrame:
    """First n rows by key: a top-n per task, not a global sort."""
    return df.orderBy(key).limit(n)


def sample_rows(df: DataFrame, n: int, key: str = "id", seed: int = SEED) -> DataFrame:
    """n rows picked by a seeded hash of their key.

    Reruns, retried tasks and any partitioning give the same rows, which a
    random number per row would not.
    """
    ticket = F.md5(F.concat_ws("|", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(ticket, key).limit(n)


def flag_listing(df: DataFrame, flags: Sequence[str], *, text: str = "raw_text") -> DataFrame:
    """Text excerpt next to the names of the flags that are set, for review."""
    names = F.array_compact(F.array(*[F.when(F.col(f), F.lit(f)) for f in flags]))
    kept = [c for c in ("id", "role_title", "salary_avg") if c in df.columns]
    return df.select(*kept, excerpt(F.col(text)).alias("excerpt"), names.alias("flags"))


def integer_histogram(df: DataFrame, column: str) -> DataFrame:
    """One bin per whole number; nulls are left out."""
    return value_counts(df.filter(F.col(column).isNotNull()), column)


def equal_width_histogram(df: DataFrame, column: str, low: float, high: float,
                          bins: int) -> DataFrame:
    """Bins 1..n over [low, high); 0 and n+1 hold what lies outside."""
    bucket = F.width_bucket(F.col(column).cast("double"), F.lit(float(low)),
                            F.lit(float(high)), F.lit(bins))
    return (df.filter(F.col(column).isNotNull()).groupBy(bucket.alias("bin"))
            .agg(F.count("*").alias("n")))
