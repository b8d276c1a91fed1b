"""Running values and as-of lookups against loops over all rows, with groups over many tasks."""

import random

import pytest

from lexiflow.operators import running


@pytest.fixture(autouse=True)
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def table(groups, seed, n=1500):
    rng = random.Random(seed)
    return [(None if (g := rng.randrange(groups)) == 1 else g, rng.randrange(400), i, rng.choice([None, 0, 1, 5, -3])) for i in range(n)]


@pytest.mark.parametrize("groups", [1, 3, 600])
@pytest.mark.parametrize("last", [False, True])
def test_running_values_equal_a_loop(spark, groups, last):
    rows = table(groups, groups)
    df = spark.createDataFrame(rows, "g int, at int, id int, v int").repartition(6)
    found = running.running(df, ["g"], ["at", "id"], "v", "x", last)
    got, state = {r["id"]: r["x"] for r in found.collect()}, {}
    for g, _at, i, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        state[g] = (v if v is not None else state.get(g)) if last else state.get(g, 0) + (v or 0)
        assert got[i] == state[g]
    assert spark.read.parquet(found._written_to).select("__part").distinct().count() > 1


@pytest.mark.parametrize("groups", [1, 4])
def test_stalled_equals_a_search_of_all_rows(spark, groups):
    rows = table(groups, 9, 400)
    df = spark.createDataFrame(rows, "g int, at int, id int, v int").repartition(3)
    found = running.stalled(df, ["g"], "at", "v", 30, ["v", "id"])
    assert found.columns == ["g", "at", "id", "v", "stalled"]
    got = {r["id"]: (r["at"], r["stalled"]) for r in found.collect()}
    for g, at, i, v in rows:
        old = max(((t, w, k) for h, t, k, w in rows if h == g and t <= at - 30 and w is not None), default=None)
        assert got[i] == (at, old is not None and v is not None and v <= old[1])


def test_budgets_of_groups_and_of_nothing(spark):
    df = spark.createDataFrame([(n % 2, n, 3) for n in range(20)], "g int, at int, cost int")
    assert sorted((r["at"], r["spent_before"]) for r in running.token_budget(df, ["g"], ["at"], "cost", 7).collect()) == [(n, n // 2 * 3) for n in range(6)]
    assert running.token_budget(df.where("false"), [], ["at"], "cost", 7).count() == 0


@pytest.mark.parametrize("groups", [1, 300])
@pytest.mark.parametrize("last", [False, True])
def test_a_task_holds_a_block_of_its_rows(spark, monkeypatch, groups, last):
    monkeypatch.setattr(running.chunking, "BLOCK", 70)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    rows = table(groups, 5)
    found = running.running(spark.createDataFrame(rows, "g int, at int, id int, v int"), ["g"], ["at", "id"], "v", "x", last)
    got, state = {r["id"]: r["x"] for r in found.collect()}, {}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for g, _at, i, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])):
        state[g] = (v if v is not None else state.get(g)) if last else state.get(g, 0) + (v or 0)
        assert got[i] == state[g]
    assert spark.read.parquet(found._written_to).groupBy("__part").count().agg({"count": "max"}).first()[0] < 100
