"""Times between whole seconds: queries round them as their SQL does."""

import datetime as dt

import pytest

from lexiflow.queries import ORACLES, QUERIES

duckdb = pytest.importorskip("duckdb")


@pytest.mark.parametrize("name", ["progress_rate", "stall_detect"])
def test_parts_of_seconds_are_rounded_as_in_sql(spark, tmp_path, name):
    start = dt.datetime(2024, 1, 1)
    times = [(1, 0.2, 5.0), (1, 3600.6, 3.0), (1, 3601.4, 9.0), (2, 0.5, 4.0), (2, 3600.5, 4.0), (2, 3601.5, 1.0), (3, 0.6, 2.0), (3, 3600.5, 1.0), (3, 20.4, 2.0), (3, 3.6, 2.0)]
    rows = [(n, start + dt.timedelta(seconds=at), user, value) for n, (user, at, value) in enumerate(times)]
    # the stored type has no zone, as in the given tables
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, value double").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    db = duckdb.connect()
    db.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    expected = db.sql(ORACLES[name])
    df = QUERIES[name](spark, str(tmp_path)).select(*expected.columns)
    assert sorted(map(tuple, df.collect())) == sorted(expected.fetchall())
