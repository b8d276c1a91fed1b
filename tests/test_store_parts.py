"""Stores in parts: written and read by many tasks."""

import json

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.operators import common_format
from lexiflow.queries import QUERIES, native_rows
from lexiflow.sinks import store

DATA = "/root/testdata/sf0.001"


@pytest.fixture
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_parts_hold_all_entries_in_order(spark, tmp_path, uncoalesced):
    common = common_format.to_common(native_rows(spark, DATA)).cache()
    store.write_parts(common, f"{tmp_path}/parts", {"format": "common"}, part_bytes=20_000)
    stores = spark.read.schema(store.PARTS).parquet(f"{tmp_path}/parts")
    assert stores.count() > 4 and stores.select("part").distinct().count() > 1
    got = [(r.ordinal, r.value) for r in store.parts_frame(spark, f"{tmp_path}/parts").orderBy("ordinal").collect()]
    entries = [json.loads(r.v) for r in store.texts_of(common.orderBy("ord")).collect()]
    assert got == list(enumerate(map(store.canonical, entries)))
    twice = common.unionByName(common.where("ord = 1").withColumn("ord", F.lit(10**9).cast("bigint")))
    with pytest.raises(ValueError, match="an id stands twice"):
        store.write_parts(twice, f"{tmp_path}/twice", {}, part_bytes=20_000)
    store.write_parts(common.where("false"), f"{tmp_path}/none", {})
    assert store.parts_frame(spark, f"{tmp_path}/none").count() == 0


def test_no_entry_passes_the_driver(spark, monkeypatch):
    def refused(*_, **__):
        raise AssertionError("rows pass the driver")

    monkeypatch.setattr(DataFrame, "toLocalIterator", refused)
    assert QUERIES["shared_deref"](spark, DATA).count() > 0
