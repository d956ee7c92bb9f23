"""Salary and experience cleaning for the market reports.

Kept apart from model training, which reads the structured table as it is and
applies its own range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobsignals.fixed_values import MAX_YEARS, MONTHLY_PAY, MONTHS_PER_YEAR, PLAUSIBLE_PAY


def annual(salary: Column) -> Column:
    """Amounts that look like a month's pay become a year's."""
    return F.when(salary.between(*MONTHLY_PAY), salary * MONTHS_PER_YEAR).otherwise(salary)


def plausible(salary: Column) -> Column:
    """In range, or not stated at all."""
    return salary.isNull() | salary.between(*PLAUSIBLE_PAY)


def clean_salaries(df: DataFrame, salary: str = "salary_avg") -> DataFrame:
    """Monthly fix first, then the outlier cut; rows without salary stay."""
    return df.withColumn(salary, annual(F.col(salary))).filter(plausible(F.col(salary)))


def cap_years(df: DataFrame, years: str = "years_experience") -> DataFrame:
    y = F.col(years)
    return df.withColumn(years, F.when(y > MAX_YEARS, F.lit(MAX_YEARS).cast("bigint")).otherwise(y))


def cleaning_audit(df: DataFrame, salary: str = "salary_avg",
                   years: str = "years_experience") -> DataFrame:
    """How many rows each cleaning rule touches, in one pass."""
    s, fixed, y = F.col(salary), annual(F.col(salary)), F.col(years)
    low, high = fixed < PLAUSIBLE_PAY[0], fixed > PLAUSIBLE_PAY[1]
    stays = plausible(fixed)
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(s.between(*MONTHLY_PAY)).alias("monthly_fixed"),
        F.count_if(low).alias("dropped_low"),
        F.count_if(high).alias("dropped_high"),
        F.count_if(stays & (y > MAX_YEARS)).alias("years_capped"),
    )
