"""Salary by technology.

Everything here starts from one small frame: how often each salary occurs per
tech. It is built with map-side combining, so a tech that holds a third of all
posts is no hot spot, and its size is bounded by the pay patterns (whole
amounts up to the plausible maximum), not by the number of posts. Medians and
quartiles are then exact weighted percentiles over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobsignals.fixed_values import TOP_TECH

QUARTILES = (0.25, 0.5, 0.75)


def weighted_quartiles(value: Column, weight: Column) -> Column:
    return F.percentile(value, F.array(*map(F.lit, QUARTILES)), weight)


def salary_counts(df: DataFrame, stack: str = "tech_stack") -> DataFrame:
    return (df.filter(F.col("salary_avg").isNotNull())
            .select(F.explode(stack).alias("tech"), "salary_avg")
            .filter(F.col("tech").isNotNull())
            .groupBy("tech", "salary_avg").agg(F.count("*").alias("n")))


def top_tech(df: DataFrame, k: int = TOP_TECH) -> DataFrame:
    """The k techs named by most salaried posts; ties by name."""
    return (salary_counts(df).groupBy("tech").agg(F.sum("n").alias("n_posts"))
            .orderBy(F.desc("n_posts"), "tech").limit(k))


def keep_top(exploded: DataFrame, top: DataFrame, k: int = TOP_TECH) -> DataFrame:
    """Rows whose tech is in the top list. The limit bounds what is broadcast."""
    return exploded.join(F.broadcast(top.select("tech").limit(k)), "tech", "left_semi")


def median_salary_by_tech(df: DataFrame, k: int = TOP_TECH) -> DataFrame:
    """Exact median salary of the k most named techs, highest first."""
    q = F.percentile(F.col("salary_avg"), F.lit(0.5), F.col("n"))
    return (salary_counts(df).groupBy("tech")
            .agg(F.sum("n").alias("n_posts"), q.alias("median_salary"))
            .orderBy(F.desc("n_posts"), "tech").limit(k)
            .orderBy(F.desc("median_salary"), "tech"))


def box_stats_by_tech(df: DataFrame, k: int = TOP_TECH) -> DataFrame:
    """Quartiles, extremes and 1.5 IQR whiskers for the k most named techs."""
    s, n = F.col("salary_avg"), F.col("n")
    spread = (F.col("_q")[2] - F.col("_q")[0]) * 1.5
    counts = salary_counts(df).withColumn(
        "_q", weighted_quartiles(s, n).over(Window.partitionBy("tech")))
    return (counts.groupBy("tech").agg(
                F.sum("n").alias("n_posts"),
                F.min(s).alias("min_salary"),
                F.min(F.when(s >= F.col("_q")[0] - spread, s)).alias("lower_whisker"),
                F.first(F.col("_q")).alias("_q"),
                F.max(F.when(s <= F.col("_q")[2] + spread, s)).alias("upper_whisker"),
                F.max(s).alias("max_salary"))
            .orderBy(F.desc("n_posts"), "tech").limit(k)
            .select("tech", "n_posts", "min_salary", "lower_whisker",
                    F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median_salary"),
                    F.col("_q")[2].alias("q3"), "upper_whisker", "max_salary"))
