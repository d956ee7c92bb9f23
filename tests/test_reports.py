"""Trends, pay, profile and metrics against brute force in pandas."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from jobsignals.fixed_values import COMBO_FLAGS, FLAG_GROUPS
from jobsignals.operators import metrics, pay, profile, trends
from jobsignals.operators.cleaning import cap_years, clean_salaries
from jobsignals.plans.market import market_reports


@pytest.fixture(scope="module")
def cleaned(structured):
    return cap_years(clean_salaries(structured)).cache()


@pytest.fixture(scope="module")
def pdf(cleaned):
    df = cleaned.toPandas()
    df["month"] = df["date"].map(lambda d: d.strftime("%Y-%m"))
    return df


@pytest.fixture(scope="module")
def paid(pdf):
    exploded = pdf.explode("tech_stack").rename(columns={"tech_stack": "tech"})
    exploded = exploded.dropna(subset=["tech"])
    return exploded[exploded["salary_avg"].notna()]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_trend_in_one_scan_equals_join_and_pandas(cleaned, pdf):
    one = trends.tech_trend(cleaned)
    two = trends.merge_share(trends.mentions_per_month(trends.explode_tech(cleaned)),
                             trends.posts_per_month(cleaned))
    assert rows(one) == rows(two)
    exploded = pdf.explode("tech_stack").dropna(subset=["tech_stack"])
    counts = exploded.groupby(["month", "tech_stack"])["id"].count()
    totals = pdf.groupby("month")["id"].count()
    expected = sorted([(m, t, n, totals[m], n / totals[m] * 100)
                       for (m, t), n in counts.items()], key=str)
    assert rows(one) == expected


def test_trend_reads_its_input_once(spark, structured, tmp_path):
    structured.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    plan = trends.tech_trend(stored)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<id:string,date:date,tech_stack:array<string>>" in plan


def test_trend_edge_cases(spark):
    df = spark.createDataFrame([
        ("1", None, ["A"]), ("2", None, []), (None, None, ["A", None]), ("4", None, None)],
        "id string, d string, tech_stack array<string>").withColumn("date", F.col("d").cast("date"))
    assert rows(trends.tech_trend(df)) == [(None, "A", 1, 3, 1 / 3 * 100)]
    no_ids = df.filter("id IS NULL")
    assert rows(trends.tech_trend(no_ids)) == [(None, "A", 0, 0, None)]


def test_competitors_without_rows_stay_away(cleaned):
    got = {r.tech for r in trends.competitor_trend(cleaned).collect()}
    assert got == {"Python", "JavaScript", "Rust", "Go", "Java", "C++"}


def test_remote_shares_sum_to_100(cleaned):
    sums = trends.remote_share(cleaned).groupBy("month").agg(F.sum("percentage").alias("s"))
    assert sums.filter(F.abs(F.col("s") - 100) > 1e-9).isEmpty()


def test_prevalence(cleaned, pdf):
    got = trends.ranked_prevalence(cleaned).collect()
    flags = {f: g for g, names in [*((g, list(f)) for g, f in FLAG_GROUPS.items()),
                                   *COMBO_FLAGS.items()] for f in names}
    assert {r.feature: (r.feature_group, r.n, r.percentage) for r in got} == {
        f: (g, int(pdf[f].sum()), pdf[f].sum() / len(pdf) * 100) for f, g in flags.items()}
    order = [(r.feature_group, -r.percentage, r.feature) for r in got]
    assert order == sorted(order)


def test_pay_by_tech(cleaned, paid):
    counts = paid["tech"].value_counts()
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:10]
    assert [tuple(r) for r in pay.top_tech(cleaned).collect()] == top
    names = [t for t, _ in top]
    median = paid[paid["tech"].isin(names)].groupby("tech")["salary_avg"].median()
    got = pay.median_salary_by_tech(cleaned).collect()
    assert {r.tech: r.median_salary for r in got} == median.to_dict()
    assert [r.median_salary for r in got] == sorted(median, reverse=True)
    for r in pay.box_stats_by_tech(cleaned).collect():
        s = paid[paid["tech"] == r.tech]["salary_avg"].astype(float)
        q1, q2, q3 = np.percentile(s, [25, 50, 75])
        inside = s[(s >= q1 - 1.5 * (q3 - q1)) & (s <= q3 + 1.5 * (q3 - q1))]
        assert (r.n_posts, r.q1, r.median_salary, r.q3) == (len(s), q1, q2, q3)
        assert (r.min_salary, r.max_salary) == (s.min(), s.max())
        assert (r.lower_whisker, r.upper_whisker) == (inside.min(), inside.max())


def test_keep_top_keeps_every_row_of_the_top(cleaned, paid):
    exploded = trends.explode_tech(cleaned.filter("salary_avg IS NOT NULL"))
    names = [r.tech for r in pay.top_tech(cleaned, 3).collect()]
    kept = pay.keep_top(exploded, pay.top_tech(cleaned, 3), 3)
    assert kept.count() == paid["tech"].isin(names).sum()


@pytest.mark.parametrize("column", ["salary_avg", "years_experience", "salary_max"])
def test_numeric_summary(cleaned, pdf, column):
    got = profile.numeric_summary(cleaned, column).first()
    want = pdf[column].dropna().astype(float).describe()
    assert got["count"] == want["count"]
    for ours, theirs in [("mean", "mean"), ("std", "std"), ("min", "min"), ("q25", "25%"),
                         ("q50", "50%"), ("q75", "75%"), ("max", "max")]:
        assert got[ours] == pytest.approx(want[theirs], rel=1e-12)


def test_numeric_summary_of_few(spark):
    none = profile.numeric_summary(spark.createDataFrame([(None,)], "x long"), "x").first()
    assert (none["count"], none["mean"], none["std"], none["min"]) == (0, None, None, None)
    one = profile.numeric_summary(spark.createDataFrame([(7,)], "x long"), "x").first()
    assert (one["count"], one["mean"], one["std"], one["q50"]) == (1, 7.0, None, 7.0)


def test_value_counts_and_nulls(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    assert set(
        rows(profile.value_counts(df, "c"))) == {("a", 2), ("b", 1), (None, 1)}
    assert rows(profile.top_values(df, "c", 1)) == [("a", 2)]
    assert rows(profile.non_null_counts(df)) == [("c", 4, 3, 1)]
    assert profile.schema_table(df) == [("c", "string", True)]


def test_histograms(spark):
    df = spark.createDataFrame([(-1,), (0,), (4,), (5,), (9,), (10,), (None,)], "x int")
    assert rows(profile.equal_width_histogram(df, "x", 0, 10, 2)) == [(0, 1), (1, 2), (2, 2), (3, 1)]
    assert sum(r.n for r in profile.integer_histogram(df, "x").collect()) == 6


def test_sample_is_the_same_under_any_partitioning(structured):
    a = {r.id for r in profile.sample_rows(structured, 5).collect()}
    b = {r.id for r in profile.sample_rows(structured.repartition(7), 5).collect()}
    assert a == b and len(a) == 5
    assert a != {r.id for r in profile.sample_rows(structured, 5, seed=1).collect()}


def test_flag_listing(spark):
    df = spark.createDataFrame([("1", "t" * 300, True, False, None)],
                               "id string, raw_text string, a boolean, b boolean, c boolean")
    row = profile.flag_listing(df, ["a", "b", "c"]).first()
    assert row.flags == ["a"] and row.excerpt == "t" * 200


def test_class_report_against_hand_counts(spark):
    pairs = [("a", "a")] * 3 + [("a", "b")] * 2 + [("b", "b")] * 4 + [("c", "a")] + [("b", "d")]
    df = spark.createDataFrame(pairs, "y string, p string")
    report = {r.label: r for r in metrics.class_report(df, "y", "p").collect()}
    a, c, d = report["a"], report["c"], report["d"]
    assert (a.precision, a.recall, a.support) == (0.75, 0.6, 5)
    assert a.f1 == pytest.approx(2 * 0.75 * 0.6 / 1.35)
    assert (c.precision, c.recall, c.f1, c.support) == (0.0, 0.0, 0.0, 1)
    assert (d.precision, d.recall, d.f1, d.support) == (0.0, 0.0, 0.0, 0)
    averages = metrics.report_averages(metrics.class_report(df, "y", "p")).first()
    assert averages.accuracy == 7 / 11 and averages.support == 11
    f1 = {k: v.f1 for k, v in report.items()}
    assert averages.macro_f1 == pytest.approx(sum(f1.values()) / 4)
    assert averages.weighted_f1 == pytest.approx((5 * f1["a"] + 5 * f1["b"]) / 11)
    matrix = metrics.confusion_matrix(df, "y", "p", ["a", "b", "c", "d"])
    assert rows(matrix) == [("a", 3, 2, 0, 0), ("b", 0, 4, 0, 1), ("c", 1, 0, 0, 0)]


def test_regression_metrics(spark):
    y, p = np.array([1.0, 2, 4, 8]), np.array([1.5, 2, 3, 9])
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    got = metrics.regression_metrics(df, "y", "p").first()
    assert got.mae == pytest.approx(np.abs(y - p).mean())
    assert got.r2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_market_reports_run(structured):
    reports = market_reports(structured)
    assert all(not df.isEmpty() for df in reports.values())
