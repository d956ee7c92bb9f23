"""Plans that must keep their shape to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

from jobsignals.operators import cleaning, pay, trends
from jobsignals.plans import derived
from jobsignals.plans.market import transform
from jobsignals.plans.queries import QUERIES
from jobsignals.sources.tables import read_structured, write_structured


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def lazy(spark, sf_dir):
    return transform(derived.postings(spark, sf_dir))


def test_transform_has_two_shuffles_and_no_python(lazy):
    text = plan(lazy)
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2
    assert len(re.findall(r"WindowGroupLimit .*Partial", text)) == 2
    assert "EvalPython" not in text and "MapInPandas" not in text


def test_filters_on_derived_columns_stay_above_the_extractors(lazy):
    text = plan(cleaning.clean_salaries(lazy))
    assert text.index("CollectMetrics") < text.index("regexp_extract")
    before_window = text[text.index("Window "):]
    assert "regexp_extract" not in before_window


def test_unused_extractors_are_pruned(lazy):
    text = plan(trends.remote_share(lazy))
    assert "regexp_extract" not in text and "_tokens" not in text


def test_text_filters_reach_below_the_second_shuffle(lazy):
    text = plan(lazy)
    first = [m.start() for m in re.finditer("Exchange hashpartitioning", text)]
    # Plans print top down: the later exchange in the text runs first.
    assert first[0] < text.index("length(raw_text") < first[1]


def test_no_cross_joins_anywhere(spark, sf_dir):
    eager = {"salary_model_metrics", "salary_importances", "salary_residuals",
             "role_model_metrics", "role_confusion", "incremental_ingest", "batch_ingest"}
    for name, query in QUERIES.items():
        if name not in eager:
            text = plan(query(spark, sf_dir))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_month_pruning_and_pushdown_on_the_stored_table(spark, lazy, tmp_path):
    path = str(tmp_path / "structured")
    write_structured(lazy, path)
    one = (read_structured(spark, path)
           .filter((F.col("month") == "1996-03") & (F.col("salary_avg") > 100000)).select("id"))
    text = plan(one)
    assert "PartitionFilters: [isnotnull(month" in text
    assert "GreaterThan(salary_avg,100000)" in text
    assert "ReadSchema: struct<id:string,salary_avg:bigint>" in text


def test_pay_statistics_aggregate_before_they_gather(spark, lazy, tmp_path):
    path = str(tmp_path / "structured")
    write_structured(lazy, path)
    text = plan(pay.median_salary_by_tech(read_structured(spark, path)))
    assert text.count("FileScan") == 1
    assert re.search(r"HashAggregate\(keys=\[tech#\d+, salary_avg#\d+L\], functions=\[partial_count",
                     text)


def test_numeric_group_of_one_hot_tech(spark):
    hot = spark.range(30000).select(
        F.array(F.lit("Hot")).alias("tech_stack"), (F.col("id") % 7 * 1000 + 50000).alias("salary_avg"))
    row = pay.median_salary_by_tech(hot).first()
    assert (row.tech, row.n_posts, row.median_salary) == ("Hot", 30000, 53000.0)
