"""Shared values: ids, the way back, and ids that stand for nothing or for another kind."""

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import shared

KINDS = ["origin", "proof"]


@pytest.fixture(params=[1000, 2], ids=["all hot", "few hot"])
def rows(spark, request, monkeypatch):
    monkeypatch.setattr(shared, "HOT", request.param)
    given = [(i, None if i % 7 == 0 else "hot" if i % 3 else f"o{i % 40}", "" if i % 11 == 0 else "hot" if i % 2 else f"p{i}" * (2000 if i % 50 == 4 else 1)) for i in range(600)]
    return spark.createDataFrame(given, "ord bigint, origin string, proof string").repartition(5)


def test_ids_are_dense_and_lead_back(rows):
    values = shared.shared_values(rows, KINDS)
    held = sorted(map(tuple, values.collect()))
    own = [tuple(r) for r in rows.select("origin", "proof").collect()]
    expected = sorted({("origin", o) for o, _ in own if o is not None} | {("proof", p) for _, p in own})
    assert [(i, k, v) for i, k, v, _ in held] == [(n, *kv) for n, kv in enumerate(expected, 1)]
    assert all(n == sum((o if k == "origin" else p) == v for o, p in own) for _, k, v, n in held)
    coded = shared.with_ids(rows, values, KINDS)
    assert coded.columns == rows.columns and dict(coded.dtypes)["origin"] == "bigint"
    assert sorted(map(tuple, shared.with_values(coded, values, KINDS).collect())) == sorted(map(tuple, rows.collect()))
    assert shared.faults(coded, values, KINDS, "ord").count() == 0


def test_faults_are_told_and_end_a_job(rows):
    values = shared.shared_values(rows, KINDS)
    coded = shared.with_ids(rows, values, KINDS)
    last = values.agg(F.max("id")).first()[0]
    torn = coded.withColumn("origin", F.when(F.col("ord") == 5, F.lit(last)).when(F.col("ord") == 8, F.lit(-1)).otherwise(F.col("origin")))
    assert sorted(map(tuple, shared.faults(torn, values, KINDS, "ord").collect())) == [(5, "origin", last, "kind"), (8, "origin", -1, "unknown")]
    with pytest.raises(Exception, match="no shared origin under id"):
        shared.with_values(torn, values, KINDS).collect()


def test_empty_tables(spark, rows):
    none = rows.where("false")
    values = shared.shared_values(none, KINDS)
    assert values.count() == 0 and shared.with_ids(none, values, KINDS).count() == 0
    assert {r["origin"] for r in shared.with_ids(rows, values, KINDS).collect()} == {None}


def test_hot_rows_are_dealt(spark):
    """Rows of a value that all share do not meet in one task of the join."""
    df = spark.range(20000, numPartitions=4).select("id", F.lit("same").alias("kind_a"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        values = shared.shared_values(df, ["kind_a"])
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sizes = [r["n"] for r in shared.with_ids(df, values, ["kind_a"]).groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) == 4 and max(sizes) < 7000
