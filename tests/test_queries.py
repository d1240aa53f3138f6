import os

import duckdb
import pytest

import __spark_entry__ as entries
import check_queries

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")
ORACLES = entries.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    made = duckdb.connect()
    for table in check_queries.TABLES:
        made.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return made


def test_entry(spark):
    assert entries.entry(spark).count() == 50


def test_every_statement_has_a_query():
    assert set(ORACLES) <= set(entries.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_statement(spark, connection, name):
    message, fine = check_queries.compare(spark, connection, FOLDER, name)
    assert fine, message


@pytest.mark.parametrize(
    "name", sorted(n for n in entries.queries() if n not in ORACLES and not n.startswith(("lda_", "run_", "model_")))
)
def test_query_without_statement_runs(spark, name):
    assert entries.queries()[name](spark, FOLDER).count() > 0
