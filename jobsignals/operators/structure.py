"""Free-text posts to the typed 26-column table, all as native expressions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from jobsignals.functions import posts
from jobsignals.functions.salary import with_salary
from jobsignals.functions.skills import with_skills
from jobsignals.functions.text import clean
from jobsignals.schemas import STRUCTURED


def prepared(df: DataFrame, text: str = "raw_text") -> DataFrame:
    """Add `clean` and `low`, each computed once and read by every extractor."""
    return (df.withColumn("clean", clean(F.col(text)))
            .withColumn("low", F.lower("clean")))


def evaluate_once(df: DataFrame, rows: Observation | None = None) -> DataFrame:
    """Keep later filters above `df`'s expressions; count its rows on the way.

    A filter on a derived column would otherwise be rewritten in terms of the
    raw text and pushed below the projections and even below the text
    de-duplication, evaluating every extractor again there, many times over. An
    observed row count is a node that filters do not pass, while unused columns
    are still pruned through it.
    """
    n = F.count(F.lit(1)).alias("n_rows")
    return df.observe(rows if rows is not None else f"rows-{uuid.uuid4().hex}", n)


def salaries(df: DataFrame) -> DataFrame:
    """id and the pay columns alone, with the tier that produced them."""
    return evaluate_once(with_salary(prepared(df)).select(
        "id", "salary_min", "salary_max", "salary_avg", "currency", "pay_tier"))


def structure(df: DataFrame, rows: Observation | None = None) -> DataFrame:
    """Narrow transform: no shuffle, no Python on the workers.

    `rows`, if given, receives the number of structured posts once an action
    has run, at no extra pass.
    """
    low, cleaned = "low", F.col("clean")
    df = (prepared(df)
          .transform(with_salary)
          .transform(with_skills)
          .withColumns({
              "company_name": posts.company(cleaned),
              "role_title": posts.role_title(cleaned),
              "job_category": posts.role(low),
              "is_remote": posts.is_remote(low),
              "years_experience": posts.years_experience(low),
              **posts.flags(low),
          })
          .withColumns(posts.combos(low, F.col("tech_stack"), F.col("is_crypto"))))
    present = set(df.columns)
    return evaluate_once(df.select(*[n for n in STRUCTURED.names if n in present]), rows)
