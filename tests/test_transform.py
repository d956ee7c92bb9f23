"""Sanitation, structure and cleaning."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobsignals.fixed_values import SKILLS
from jobsignals.operators import cleaning, sanitize
from jobsignals.operators.dedupe import dedupe_ids, dedupe_month_text
from jobsignals.operators.structure import structure
from jobsignals.plans import derived
from jobsignals.plans.market import run_transform, transform
from jobsignals.schemas import STRUCTURED
from jobsignals.sources.tables import read_structured

A = "Tidewater Labs | Senior Data Plumber | Remote | $120k - $150k | some Python on AWS"
B = "Hazel & Co | Junior Tinkerer | NYC office | pays $80k+ | Javascript with React"
QUOTE = "\n\n > " + "a quoted reply that is long enough to pass the length filter"
JAN, FEB = dt.datetime(2023, 1, 1), dt.datetime(2023, 2, 1)


@pytest.fixture
def mock(spark):
    return spark.createDataFrame([
        ("1", JAN, A), ("2", JAN, B), ("3", FEB, "> This is a reply"), ("4", FEB, "Short"),
        ("5", FEB, QUOTE), ("6", FEB, None), ("2", FEB, B + " again"), ("7", JAN, A), ("8", FEB, A),
        (None, JAN, "x" * 60), (None, JAN, "y" * 60), ("9", None, "z" * 60), ("91", None, "z" * 60),
    ], "id string, date timestamp, raw_text string")


def test_mock_posts(mock):
    rows = {r.id: r for r in transform(mock).collect()}
    assert set(rows) == {"1", "2", "8", None, "9"}
    a, b = rows["1"], rows["2"]
    assert (a.salary_min, a.salary_max, a.salary_avg, a.currency) == (120000, 150000, 135000, "USD")
    assert a.tech_stack == ["AWS", "Python"] and a.is_senior and a.is_remote
    assert a.company_name == "Tidewater Labs" and a.role_title == "Senior Data Plumber"
    assert (b.salary_min, b.salary_max, b.salary_avg) == (80000, 80000, 80000)
    assert b.tech_stack == ["JavaScript", "React"] and b.is_junior and b.is_tier_1_city
    assert b.raw_text == B and b.date == dt.date(2023, 1, 1)
    assert rows[None].raw_text == "x" * 60      # null ids are one group


def test_output_schema(mock):
    df = transform(mock)
    assert df.columns == STRUCTURED.fieldNames()
    assert [f.dataType for f in df.schema] == [f.dataType for f in STRUCTURED]


def test_aliases_and_required_columns(spark):
    df = spark.createDataFrame([(1, "2023-01-01", A)], "id int, thread_date string, text string")
    assert transform(df).select("id", "date").collect() == [("1", dt.date(2023, 1, 1))]
    with pytest.raises(sanitize.MissingColumn, match="raw_text"):
        transform(spark.createDataFrame([("1",)], "id string"))
    undated = spark.createDataFrame([("1", A), ("2", A)], "id string, raw_text string")
    assert transform(undated).count() == 2
    assert "date" not in transform(undated).columns


def test_bad_dates(spark):
    df = spark.createDataFrame([("1", "not a date", A)], "id string, date string, raw_text string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        sanitize.normalise(df).collect()
    assert sanitize.normalise(df, bad_dates="null").first().date is None


def test_dedupes_are_idempotent_and_order_free(spark, sf_dir):
    raw = sanitize.normalise(derived.postings(spark, sf_dir))
    once = sanitize.sanitize(raw)
    twice = sanitize.sanitize(once)
    shuffled = sanitize.sanitize(raw.orderBy(F.rand(7)).repartition(13))
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()
    assert once.exceptAll(shuffled).isEmpty() and shuffled.exceptAll(once).isEmpty()


def test_dedupe_against_pandas(spark, sf_dir):
    raw = sanitize.normalise(derived.postings(spark, sf_dir))
    pdf = raw.toPandas().sort_values(["date", "raw_text"], kind="stable")
    pdf = pdf.drop_duplicates("id").sort_values("id", kind="stable")
    assert dedupe_ids(raw).count() == len(pdf)
    pdf["month"] = pdf["date"].map(lambda d: d.strftime("%Y-%m"))
    ids = set(pdf.drop_duplicates(["month", "raw_text"])["id"])
    assert {r.id for r in dedupe_month_text(dedupe_ids(raw)).collect()} == ids


def test_one_hot_key_leaves_one_row_per_task(spark):
    hot = spark.range(0, 60000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("id"),
        F.lit("2023-01-01").cast("date").alias("date"), F.lit(A).alias("raw_text"))
    df = dedupe_ids(hot)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit [id" in plan and "Partial" in plan
    assert df.count() == 40001


def test_row_audit_equals_stepwise_counts(mock):
    steps = {r.step: r.n_rows for r in sanitize.row_audit(sanitize.normalise(mock)).collect()}
    assert steps == {"input": 13, "id_dedupe": 11, "text_dedupe": 9, "length_filter": 6,
                     "quote_filter": 5}


def test_row_audit_of_nothing(mock):
    empty = sanitize.normalise(mock.limit(0))
    assert {r.n_rows for r in sanitize.row_audit(empty).collect()} == {0}


def test_structured_properties(structured):
    bad = structured.filter(
        (F.col("currency").isNull() != F.col("salary_min").isNull())
        | (F.size(F.array_except("tech_stack", F.lit(list(SKILLS)))) > 0)
        | (F.array_sort("tech_stack") != F.col("tech_stack"))
        | (F.length("raw_text") < 50) | F.col("raw_text").startswith(">"))
    assert bad.isEmpty()


def test_structure_counts_its_rows(spark, mock):
    from pyspark.sql import Observation
    seen = Observation("kept")
    transform(mock, seen).collect()
    assert seen.get == {"n_rows": 5}


def test_run_transform_writes_and_samples(spark, sf_dir, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    derived.postings(spark, sf_dir).write.parquet(raw)
    sample = run_transform(spark, raw, out, sample_size=7)
    assert sample.count() == 7
    assert not (tmp_path / "out").exists()
    run_transform(spark, raw, out)
    stored = read_structured(spark, out)
    assert stored.columns == STRUCTURED.fieldNames() + ["month"]
    fresh = transform(spark.read.parquet(raw))
    assert stored.drop("month").exceptAll(fresh).isEmpty()
    assert stored.count() == fresh.count()
    with pytest.raises(FileNotFoundError):
        run_transform(spark, str(tmp_path / "nothing"), out)


def test_salary_cleaning(spark):
    values = [None, 1999, 2000, 11000, 15000, 15001, 500000, 500001, 1249, 1250]
    df = spark.createDataFrame([(v,) for v in values], "salary_avg long")
    got = [r.salary_avg for r in cleaning.clean_salaries(df).collect()]
    # The lower bound acts after the monthly fix: 1250 is not monthly, and goes.
    assert sorted(got, key=lambda v: v or 0) == [None, 15001, 24000, 132000, 180000, 500000]
    audit = cleaning.cleaning_audit(df.withColumn("years_experience", F.lit(31))).first()
    assert (audit.n_rows, audit.monthly_fixed, audit.dropped_low, audit.dropped_high) == (10, 3, 3, 1)
    assert audit.years_capped == 6


def test_years_cap_keeps_nulls(spark):
    df = spark.createDataFrame([(None,), (30,), (31,)], "years_experience long")
    assert [r[0] for r in cleaning.cap_years(df).collect()] == [None, 30, 30]


def test_undated_posts_end_to_end(spark, tmp_path):
    undated = spark.createDataFrame([("1", A), ("2", A), ("2", B), ("3", "short")],
                                    "id string, raw_text string")
    undated.write.parquet(str(tmp_path / "raw"))
    got = run_transform(spark, str(tmp_path / "raw"), str(tmp_path / "out"))
    assert sorted((r.id, r.date, r.month) for r in got.collect()) == [
        ("1", None, None), ("2", None, None)]
    audit = {r.step: r.n_rows for r in sanitize.row_audit(sanitize.normalise(undated)).collect()}
    assert audit == {"input": 4, "id_dedupe": 3, "text_dedupe": 3, "length_filter": 2,
                     "quote_filter": 2}


def test_unreadable_dates_can_be_kept(spark, tmp_path):
    posts = spark.createDataFrame([("1", "2023-01-05", A), ("2", "some day", B)],
                                  "id string, thread_date string, raw_text string")
    posts.write.parquet(str(tmp_path / "raw"))
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_transform(spark, str(tmp_path / "raw"), str(tmp_path / "fails"))
    got = run_transform(spark, str(tmp_path / "raw"), str(tmp_path / "out"), bad_dates="null")
    assert sorted((r.id, r.month) for r in got.collect()) == [("1", "2023-01"), ("2", None)]
