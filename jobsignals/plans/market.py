"""Raw posts to the structured table, and the market reports over it."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession

from jobsignals.operators import pay, profile, trends
from jobsignals.operators.cleaning import cap_years, clean_salaries
from jobsignals.operators.sanitize import normalise, sanitize
from jobsignals.operators.structure import structure
from jobsignals.sources.tables import read_raw, read_structured, write_structured


def transform(raw: DataFrame, rows: Observation | None = None,
              bad_dates: str = "raise") -> DataFrame:
    """Raw posts to structured posts: two shuffles, then one narrow stage."""
    return structure(sanitize(normalise(raw, bad_dates)), rows)


def run_transform(spark: SparkSession, input_path: str, output_path: str,
                  sample_size: int | None = None, bad_dates: str = "raise") -> DataFrame:
    """Read, transform and store; the stored table is returned, so nothing runs twice.

    A sample is returned and not stored. With `bad_dates='null'`, posts whose date
    cannot be read are kept in the null month instead of stopping the run.
    """
    raw = read_raw(spark, input_path)
    if sample_size:
        return structure(profile.head(sanitize(normalise(raw, bad_dates)), sample_size))
    write_structured(transform(raw, bad_dates=bad_dates), output_path)
    return read_structured(spark, output_path)


def market_reports(structured: DataFrame) -> dict[str, DataFrame]:
    """Every report over the cleaned posts, as lazy frames.

    Meant for the stored structured table. Nothing is cached: cleaning is two
    cheap expressions, and each report scans only the two to five columns it
    needs, where a cached frame would hold the texts as well.
    """
    cleaned = cap_years(clean_salaries(structured))
    return {
        "salary_before": profile.numeric_summary(structured, "salary_avg"),
        "salary_after": profile.numeric_summary(cleaned, "salary_avg"),
        "years": profile.numeric_summary(cleaned, "years_experience"),
        "years_histogram": profile.integer_histogram(cleaned, "years_experience"),
        "feature_prevalence": trends.ranked_prevalence(cleaned),
        "tech_trend": trends.tech_trend(cleaned),
        "competitors": trends.competitor_trend(cleaned),
        "median_salary": pay.median_salary_by_tech(cleaned),
        "salary_boxes": pay.box_stats_by_tech(cleaned),
        "remote_share": trends.remote_share(cleaned),
        "remote_values": profile.value_counts(cleaned, "is_remote"),
    }
