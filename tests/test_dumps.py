"""Files of ordered lines, whose rows do not pass the driver."""

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.queries import QUERIES
from lexiflow.sinks import artifacts


@pytest.fixture
def no_rows_here(monkeypatch):
    def refused(*_, **__):
        raise AssertionError("rows pass the driver")

    monkeypatch.setattr(DataFrame, "toLocalIterator", refused)


@pytest.mark.parametrize("name", ["ordered_dump", "order_table"])
def test_no_row_passes_the_driver(spark, no_rows_here, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_lines_of_many_tasks_are_in_order(spark, no_rows_here, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rows = spark.range(1000).repartition(5).withColumn("ord", -F.col("id"))
    line = F.concat(F.lit("zeile ü "), F.col("id").cast("string"))
    assert artifacts.write_rows(tmp_path / "lines.txt", rows, "ord", line, ["# head"]) == 1000
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert (tmp_path / "lines.txt").read_text(encoding="utf-8") == "# head\n" + "".join(f"zeile ü {n}\n" for n in range(999, -1, -1))
    with pytest.raises(Exception, match="a row without a line"):
        artifacts.write_rows(tmp_path / "lines.txt", rows, "ord", F.lit(None).cast("string"))
    assert artifacts.write_rows(tmp_path / "none.txt", rows.where("false"), "ord", line) == 0 and (tmp_path / "none.txt").read_bytes() == b""
    assert [p.name for p in sorted(tmp_path.iterdir())] == ["lines.txt", "none.txt"]
