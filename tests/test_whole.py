"""Queries over whole tables leave no row out."""

import os

import pytest
from pyspark.sql import functions as F

from lexiflow.queries import QUERIES, native_rows

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


def test_all_events_take_part(spark):
    events = spark.read.parquet(f"{DATA}/events.parquet")
    back = QUERIES["raw_deflate_roundtrip"](spark, DATA)
    assert sorted(back.collect()) == sorted(events.select("event_id", "user_id", "event_type").collect())
    assert QUERIES["json_payload"](spark, DATA).count() == events.where("event_id % 2 = 0").select("user_id").distinct().count()
    assert QUERIES["explode_parts"](spark, DATA).select("event_id").distinct().count() == events.count()


def test_every_order_is_a_sense(spark):
    orders = spark.read.parquet(f"{DATA}/orders.parquet").count()
    assert native_rows(spark, DATA).agg(F.sum(F.size("senses"))).first()[0] == orders
    assert QUERIES["common_map"](spark, DATA).agg(F.sum("n_senses")).first()[0] == orders
    assert QUERIES["provenance_dim"](spark, DATA).agg(F.sum("n")).first()[0] == orders
