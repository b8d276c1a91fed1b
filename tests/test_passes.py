"""What queries compute once, however often it is read, and without searches for each element."""

import pytest
from pyspark.sql import functions as F

from lexiflow import queries
from lexiflow.plans import inference

DATA = "/root/testdata/sf0.001"


def test_texts_are_put_in_by_place(spark):
    base = spark.createDataFrame([("a", [("x", "")] * 5), ("b", [("y", "old")] * 2), ("c", [])], "id string, senses array<struct<en: string, ja: string>>")
    texts = spark.createDataFrame([("a", 4, "four"), ("a", 2, "two"), ("b", 1, None), ("nobody", 9, "none")], "id string, sense int, ja string")
    merged = inference.merge_glosses(base, texts)
    assert "element_at" not in merged._jdf.queryExecution().toString()
    assert {r.id: [s.ja for s in r.senses] for r in merged.collect()} == {"a": ["", "two", "", "four", ""], "b": ["old", "old"], "c": []}
    for sense in (0, 6, None, 2_000_000_000):
        with pytest.raises(Exception, match="a sense that the entry does not have"):
            inference.merge_glosses(base, spark.createDataFrame([("a", sense, "t")], texts.schema)).collect()


@pytest.mark.parametrize("name, made", [("patch_applied", "order_rows"), ("inference_run", "event_base"), ("repaired_log", "event_base")])
def test_rows_are_made_once(spark, monkeypatch, name, made):
    make, one_pass, once = getattr(queries, made), [], spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(_):
        once.add(1)
        return 1

    def watched(*args):
        rows = make(*args)
        seen = rows.withColumn("__seen", counted(F.col(rows.columns[0]))).where("__seen = 1").drop("__seen")
        seen.write.format("noop").mode("overwrite").save()
        one_pass.append(once.value)
        return seen

    monkeypatch.setattr(queries, made, watched)
    assert queries.QUERIES[name](spark, DATA).count() > 0
    assert once.value == 2 * one_pass[0]  # one by watched(), one by the query
