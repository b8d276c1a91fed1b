"""Digests, differences of states, closures, and results that are renewed where something changed."""

import random

import pytest
from pyspark.sql import functions as F

from lexiflow.operators import changes

SCHEMA = "g string, x int, y string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def differences(spark, a, b):
    return {r["g"]: r["change"] for r in changes.touched(changes.state_of({"t": frame(spark, a)}, "g"), changes.state_of({"t": frame(spark, b)}, "g"), "g").collect()}


def test_states_tell_what_differs(spark):
    a = [("p", 1, "u"), ("p", 2, None), ("q", 1, "u"), ("r", 1, "u"), ("r", 1, "u"), (None, 1, "n"), ("s", None, "1")]
    assert differences(spark, a, a[::-1]) == {}
    b = [("p", 1, "u"), ("p", 2, "v"), ("r", 1, "u"), (None, 2, "n"), ("t", 1, ""), ("s", None, "1")]
    assert differences(spark, a, b) == {"p": "changed", "q": "removed", "r": "changed", None: "changed", "t": "added"}
    assert differences(spark, [], a[:1]) == {"p": "added"} and differences(spark, [], []) == {}
    swapped = frame(spark, a).select("y", "g", "x")
    assert changes.touched(changes.state_of({"t": frame(spark, a)}, "g"), changes.state_of({"t": swapped}, "g"), "g").count() == 0
    assert changes.touched(changes.state_of({"t": frame(spark, a)}, "g"), changes.state_of({"other": swapped}, "g"), "g").count() == 5


@pytest.mark.parametrize("seed", [1, 2])
def test_renewed_results_equal_a_full_run(spark, seed):
    rng = random.Random(seed)
    rows = [(None if (k := rng.randrange(60)) == 7 else f"g{k}", rng.randrange(5), rng.choice("uvw")) for _ in range(500)]
    derive = lambda tables: tables["t"].groupBy("g").agg(F.sum("x").alias("s"), F.count_distinct("y").alias("k"))
    kept, state = derive({"t": frame(spark, rows)}), changes.state_of({"t": frame(spark, rows)}, "g")
    for _ in range(2):
        rows = [r if rng.random() > 0.02 else (r[0], r[1] + 1, r[2]) for r in rows if r[0] != f"g{rng.randrange(60)}"] + [(f"h{rng.randrange(3)}", 1, "u"), (None, 1, "z")]
        now, looked = frame(spark, rows), []

        def watched(tables):
            looked.append(tables["t"].count())
            return derive(tables)

        kept, state = changes.step(kept, state, "g", {"t": now}, {"t": now}, watched)
        order = lambda r: str(r)
        assert sorted(map(tuple, kept.collect()), key=order) == sorted(map(tuple, derive({"t": now}).collect()), key=order)
        assert 0 < looked[0] < len(rows)


def test_closures_take_whole_groups_of_both_times(spark):
    before = spark.createDataFrame([(1, "a"), (2, "a"), (3, "b"), (4, "c")], "id int, word string")
    after = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b"), (5, None)], "id int, word string")
    words = lambda *ids: {r["word"] for r in changes.closure(spark.createDataFrame([(i,) for i in ids], "id int"), [before, after], "id", "word").collect()}
    assert words(2) == {"a", "b"} and words(4) == {"c"} and words(5) == {None} and words(9) == set()
