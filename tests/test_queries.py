"""Every query with SQL agrees with it on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from tools.check_oracle import canonical


@pytest.fixture(scope="module")
def db(tiny):
    connection = duckdb.connect()
    for path in glob.glob(f"{tiny}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_agrees_with_sql(spark, db, tiny, name):
    got = contract.queries()[name](spark, tiny).toPandas()
    want = db.execute(contract.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_entry(spark):
    made = contract.entry(spark)
    assert made.count() > 0 and made.columns[:3] == ["user_id", "event_type", "window_id"]
    assert set(contract.oracle_sql()) <= set(contract.queries())
