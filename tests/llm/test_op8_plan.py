"""The plan of op8 does not grow with the cluster."""

import time

from lexiflow.llm import order_minhash


def test_the_plan_has_a_size_of_its_own(spark):
    df = spark.createDataFrame([(i, f"text number {i}") for i in range(50)], "doc_id bigint, text string")
    was, sizes = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for n in (200, 2000):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            began = time.time()
            report = order_minhash.edit_report(df)
            sizes.append((time.time() - began, len(report._jdf.queryExecution().logical().toString())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    assert sizes[1][1] < 2 * sizes[0][1] and sizes[1][0] < 20
