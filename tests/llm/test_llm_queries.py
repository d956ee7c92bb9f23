"""Every query of the subpackage runs on the small tables; those with SQL agree with it."""

import os

import duckdb
import pytest

from jobsignals.llm.queries import QUERIES
from jobsignals.llm.queries_sql import ORACLES


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS "
                    f"SELECT * FROM '{sf_dir}/{file}'")
    return con


def test_all_thirteen_and_the_pipeline():
    numbers = {n.split("_")[0] for n in QUERIES}
    assert numbers == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = sorted(tuple(map(repr, (r[c] for c in columns))) for r in df.collect())
    result = duck.execute(ORACLES[name])
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    assert got == sorted(tuple(repr(row[i]) for i in order) for row in result.fetchall())
