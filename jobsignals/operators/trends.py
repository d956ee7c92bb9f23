"""Monthly technology and remote shares."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobsignals.fixed_values import COMBO_FLAGS, COMPETITORS, FLAG_GROUPS
from jobsignals.functions.text import month_key


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double")) * 100


def explode_tech(df: DataFrame, stack: str = "tech_stack") -> DataFrame:
    """One row per (post, tech); posts without any tech vanish."""
    others = [c for c in df.columns if c != stack]
    return df.select(*others, F.explode(stack).alias("tech")).dropna(subset=["tech"])


def posts_per_month(df: DataFrame) -> DataFrame:
    return (df.groupBy(month_key(F.col("date")).alias("month"))
            .agg(F.count("id").alias("total_jobs")))


def mentions_per_month(exploded: DataFrame) -> DataFrame:
    return (exploded.groupBy(month_key(F.col("date")).alias("month"), "tech")
            .agg(F.count("id").alias("tech_count")))


def merge_share(tech_counts: DataFrame, month_totals: DataFrame) -> DataFrame:
    """Tech counts joined with month totals; undated posts are a month too.

    Both sides are aggregates. No hint: the optimizer broadcasts the totals
    only if their measured size allows it.
    """
    totals = month_totals.withColumnRenamed("month", "_month")
    return (tech_counts.join(totals, F.col("month").eqNullSafe(F.col("_month")))
            .select("month", "tech", "tech_count", "total_jobs",
                    percent(F.col("tech_count"), F.col("total_jobs")).alias("percentage")))


def tech_trend(df: DataFrame, stack: str = "tech_stack",
               only: Sequence[str] | None = None) -> DataFrame:
    """Share of each month's posts that mention each tech, in one scan.

    Every post contributes its techs plus one null entry that stands for the
    post itself, so a single map-side combined aggregation yields both the
    mention counts and the month totals. Equal to `merge_share` over the two
    separate counts, without reading the posts twice.
    """
    kind = df.schema[stack].dataType
    techs = F.col(stack)
    if isinstance(kind, T.ArrayType) and kind.containsNull:
        techs = F.array_compact(techs)
    techs = F.coalesce(techs, F.array().cast(kind))
    counts = (df.select(month_key(F.col("date")).alias("month"), "id",
                        F.explode(F.concat(techs, F.array(F.lit(None).cast("string"))))
                        .alias("tech"))
              .groupBy("month", "tech").agg(F.count("id").alias("tech_count")))
    if only is not None:
        counts = counts.filter(F.col("tech").isNull() | F.col("tech").isin(list(only)))
    total = (F.max(F.when(F.col("tech").isNull(), F.col("tech_count")))
             .over(Window.partitionBy("month")))
    return (counts.withColumn("total_jobs", total)
            .filter(F.col("tech").isNotNull())
            .withColumn("percentage", percent(F.col("tech_count"), F.col("total_jobs"))))


def competitor_trend(df: DataFrame, names: Sequence[str] = tuple(COMPETITORS)) -> DataFrame:
    return tech_trend(df, only=names)


def remote_share(df: DataFrame) -> DataFrame:
    """Remote and on-site counts per month, with their share of the month."""
    counts = (df.groupBy(month_key(F.col("date")).alias("month"), "is_remote")
              .agg(F.count("*").alias("count")))
    total = F.sum("count").over(Window.partitionBy("month"))
    return counts.withColumn("percentage", percent(F.col("count"), total))


def feature_prevalence(df: DataFrame) -> DataFrame:
    """Count and share of posts per signal, from one aggregation row."""
    groups = {**{g: list(f) for g, f in FLAG_GROUPS.items()}, **COMBO_FLAGS}
    present = [(g, f) for g, names in groups.items() for f in names if f in df.columns]
    one = df.agg(F.count("*").alias("_n"), *[F.count_if(F.col(f)).alias(f) for _, f in present])
    entries = F.array(*[
        F.struct(F.lit(g).alias("feature_group"), F.lit(f).alias("feature"),
                 F.col(f).alias("n"), percent(F.col(f), F.col("_n")).alias("percentage"))
        for g, f in present])
    return one.select(F.inline(entries))


def ranked_prevalence(df: DataFrame) -> DataFrame:
    return feature_prevalence(df).orderBy("feature_group", F.desc("percentage"), "feature")
