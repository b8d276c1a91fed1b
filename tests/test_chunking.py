"""Chunks by many tasks against the fold over one row after another."""

import random

import numpy as np
import pytest

from lexiflow.operators import chunking


def fold(rows, budget, most_rows):
    key, chunk, held, count, out = object(), 0, 0, 0, []
    for own, cost in rows:
        if own != key:
            key, chunk, held, count = own, 0, 0, 0
        if count and (held + cost > budget or count >= most_rows):
            chunk, held, count = chunk + 1, 0, 0
        held, count = held + cost, count + 1
        out.append(chunk)
    return out


def by_parts(rows, sizes, budget, most_rows):
    """The same by partitions of these sizes, without Spark."""
    parts, at, maps = [], 0, []
    for n, size in enumerate(sizes):
        own = rows[at : at + size]
        at += size
        keys = np.unique([k for k, _ in own], return_inverse=True)[1]
        parts.append(chunking.solve(keys, np.array([c for _, c in own], float), budget, most_rows))
        maps.append({"part": n, "first": own[0][0], "last": own[-1][0], **parts[-1].map})
    out = []
    for p, (_, before, first) in zip(parts, chunking.compose(iter(maps), budget, most_rows)):
        out += [int(before + n - (first > t) if i < p.head else n - 1) for i, (n, t) in enumerate(zip(p.n, p.t))]
    return out


@pytest.mark.parametrize("seed", range(40))
def test_partitions_equal_the_fold(seed):
    rng = random.Random(seed)
    budget, most_rows = rng.choice([0, 1, 5, 20, 100]), rng.choice([1, 2, 3, 7, 1000])
    groups = rng.choice([["a"], ["a", "b", "c"], [str(n).zfill(3) for n in range(60)]])
    for _ in range(12):
        total = rng.randint(1, 150)
        rows = sorted(((rng.choice(groups), 0) for _ in range(total)), key=lambda r: r[0])
        rows = [(k, rng.choice([0, 0, 1, 2, 3, 6, 25, 130])) for k, _ in rows]
        cuts = sorted(rng.sample(range(1, total), min(total - 1, rng.randint(0, 12)))) if total > 1 else []
        sizes = [b - a for a, b in zip([0, *cuts], [*cuts, total])]
        assert by_parts(rows, sizes, budget, most_rows) == fold(rows, budget, most_rows)


@pytest.fixture
def uncoalesced(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize("groups", [1, 3, 400])
def test_one_group_is_the_work_of_many_tasks(spark, groups, uncoalesced):
    rng = random.Random(groups)
    rows = [(None if (g := rng.randrange(groups)) == 1 else g, i, rng.choice([None, 0, 1, 4, 9, 70]), "x" * (i % 5)) for i in range(5000)]
    df = spark.createDataFrame(rows, "g int, at int, cost int, other string").repartition(7)
    found = chunking.budget_chunks(df, ["g"], ["at"], "cost", 60, 11)
    assert found.columns == ["g", "at", "cost", "other", "chunk"]
    got = {r["at"]: r["chunk"] for r in found.collect()}
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert [got[r[1]] for r in ordered] == fold([(r[0], r[2] or 0) for r in ordered], 60, 11)
    written = spark.read.parquet(found._written_to)
    assert written.select("__part").distinct().count() > 1
    assert written.groupBy("__part").count().agg({"count": "max"}).first()[0] < 4000


def test_chunks_without_groups_and_of_nothing(spark):
    df = spark.createDataFrame([(n, 1) for n in range(100)], "at int, cost int")
    assert {r["at"]: r["chunk"] for r in chunking.budget_chunks(df, [], ["at"], "cost", 10, 4).collect()} == {n: n // 4 for n in range(100)}
    assert chunking.budget_chunks(df.where("false"), [], ["at"], "cost", 10, 4).count() == 0


@pytest.mark.parametrize("groups", [1, 300])
def test_a_task_holds_a_block_of_its_rows(spark, monkeypatch, groups):
    monkeypatch.setattr(chunking, "BLOCK", 70)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30)
    rng = random.Random(groups)
    rows = [(rng.randrange(groups), n, rng.choice([0, 1, 3, 9])) for n in range(2000)]
    found = chunking.budget_chunks(spark.createDataFrame(rows, "g int, n int, cost int").coalesce(2), ["g"], ["n"], "cost", 25, 12)
    got = {r.n: r.chunk for r in found.collect()}
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    rows.sort()
    assert [got[n] for _, n, _ in rows] == fold([(g, c) for g, _, c in rows], 25, 12)
    sizes = spark.read.parquet(found._written_to).groupBy("__part").count()
    assert sizes.agg({"count": "max"}).first()[0] < 100
