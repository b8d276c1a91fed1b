"""Every registered query against its SQL twin, on the smallest tables."""

import os

import pytest

from lexiflow.queries import ORACLES, QUERIES

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations clicks sales sale_lines clients client_changes vendors items stamps".split()
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return connection


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_its_sql(spark, db, name):
    df = QUERIES[name](spark, DATA)
    columns = sorted(df.columns)
    rows = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    expected = db.sql(ORACLES[name])
    assert sorted(expected.columns) == columns
    place = [expected.columns.index(c) for c in columns]
    assert rows == sorted(repr(tuple(r[p] for p in place)) for r in expected.fetchall())


def test_entry_point(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries()) and set(ORACLES) <= set(__spark_entry__.oracle_sql())
    assert not set(__spark_entry__.oracle_sql()) - set(__spark_entry__.queries())
