"""Every registered query runs; those with SQL must agree with it."""

import datetime as dt
import decimal
import os

import duckdb
import pytest

import __spark_entry__ as contract
from jobsignals.plans.check_sql import CHECKS
from jobsignals.plans.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{file}'")
    return con


def plain(value):
    if isinstance(value, dt.datetime):
        return value.date().isoformat()
    if isinstance(value, decimal.Decimal):
        return str(int(value)) if value == int(value) else repr(float(value))
    return repr(value) if isinstance(value, float) else str(value)


def test_all_are_registered():
    assert set(QUERIES) <= set(contract.queries()) and set(CHECKS) <= set(contract.oracle_sql())


def test_only_models_lack_sql():
    assert set(CHECKS) <= set(QUERIES)
    assert set(QUERIES) - set(CHECKS) == {
        "salary_model_metrics", "salary_importances", "salary_residuals", "role_model_metrics",
        "role_confusion"}


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(plain(r[c]) for c in columns) for r in df.collect())
    result = duck.execute(CHECKS[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(plain(row[i]) for i in order) for row in result.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(CHECKS)))
def test_model_query_gives_rows(spark, sf_dir, name):
    assert not QUERIES[name](spark, sf_dir).isEmpty()


def test_entry(spark):
    assert contract.entry(spark).columns == [
        "month", "tech", "tech_count", "total_jobs", "percentage"]
