"""Table schemas, declared up front so no read ever infers."""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


THREADS = _strings("id", "title", "thread_date", "url")
COMMENTS = _strings("id", "thread_date", "raw_text", "user", "url")
PAGES = T.StructType([
    T.StructField("page_key", T.StringType()),
    T.StructField("page_no", T.IntegerType()),
    T.StructField("thread_date", T.StringType()),
    T.StructField("html", T.StringType()),
])
PROCESSED = T.StructType([
    T.StructField("processed_threads", T.ArrayType(T.StringType())),
])

# Incoming name -> name used here; applied only while the target is missing.
ALIASES = {"text": "raw_text", "thread_date": "date"}
REQUIRED = ("id", "raw_text")

STRUCTURED = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("date", T.DateType()),
    T.StructField("raw_text", T.StringType()),
    T.StructField("company_name", T.StringType()),
    T.StructField("role_title", T.StringType()),
    T.StructField("salary_min", T.LongType()),
    T.StructField("salary_max", T.LongType()),
    T.StructField("salary_avg", T.LongType()),
    T.StructField("currency", T.StringType()),
    T.StructField("is_remote", T.BooleanType()),
    T.StructField("tech_stack", T.ArrayType(T.StringType(), False)),
    T.StructField("job_category", T.StringType()),
    T.StructField("is_senior", T.BooleanType()),
    T.StructField("is_junior", T.BooleanType()),
    T.StructField("is_manager", T.BooleanType()),
    T.StructField("years_experience", T.LongType()),
    T.StructField("is_tier_1_city", T.BooleanType()),
    T.StructField("is_europe", T.BooleanType()),
    T.StructField("is_global_remote", T.BooleanType()),
    T.StructField("is_yc", T.BooleanType()),
    T.StructField("is_funded", T.BooleanType()),
    T.StructField("is_crypto", T.BooleanType()),
    T.StructField("has_equity", T.BooleanType()),
    T.StructField("offers_visa", T.BooleanType()),
    T.StructField("tech_combo_ai", T.BooleanType()),
    T.StructField("tech_combo_blockchain", T.BooleanType()),
])
