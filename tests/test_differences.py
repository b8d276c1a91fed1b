"""Differences by hash trees against comparing everything."""

import random

import pytest

from lexiflow.operators import differences


def plain(left, right):
    a, b = dict(left), dict(right)
    return sorted((o, a.get(o), b.get(o)) for o in a.keys() | b.keys() if a.get(o) != b.get(o) or (o in a) != (o in b))


@pytest.mark.parametrize("seed", range(5))
def test_only_ranges_that_differ_are_joined(spark, monkeypatch, seed):
    monkeypatch.setattr(differences, "LEAF", 8)
    monkeypatch.setattr(differences, "FANOUT", 3)
    rng = random.Random(seed)
    left = [(n, rng.choice(["a", "b", None])) for n in range(1, 500)]
    right = [(n, "x" if rng.random() < (0, 0.002, 0.1)[seed % 3] else v) for n, v in left][: rng.choice([400, 499])] + [(n, "new") for n in range(600, 600 + seed)]
    frames = [spark.createDataFrame(rows, "ordinal int, v string") for rows in (left, right)]
    found = differences.positional_difference(*frames, "ordinal", ["v"]).collect()
    assert sorted((r["ordinal"], r["l"] and r["l"]["v"], r["r"] and r["r"]["v"]) for r in found) == plain(left, right)
    leaves = {r["node"] for r in differences.differing_leaves(*frames, "ordinal", ["v"]).collect()}
    assert leaves == {o // 8 for o, _, _ in plain(left, right)}


def test_nothing_on_either_side(spark):
    none, one = spark.createDataFrame([], "ordinal int, v string"), spark.createDataFrame([(1, "a")], "ordinal int, v string")
    assert differences.positional_difference(none, none, "ordinal", ["v"]).count() == 0
    assert [tuple(r) for r in differences.positional_difference(none, one, "ordinal", ["v"]).select("ordinal", "r.v").collect()] == [(1, "a")]
    assert [tuple(r) for r in differences.row_changes(one, none, "ordinal", ["v"]).collect()] == [("removed", 1, "a")]


@pytest.mark.parametrize("seed", range(3))
def test_insertions_are_found_though_places_move(spark, seed):
    rng = random.Random(seed)
    left = [f"row {n}" for n in range(400)]
    removed = set(rng.sample(range(400), 3 * seed))
    kept = [t for n, t in enumerate(left) if n not in removed]
    for n in range(5 * (seed > 0)):
        kept.insert(rng.randrange(len(kept)), f"inserted {n}")
    frames = [spark.createDataFrame(list(enumerate(rows, 1)), "ordinal int, v string") for rows in (left, kept)]
    found = {tuple(r) for r in differences.row_changes(*frames, "ordinal", ["v"], 8).collect()}
    expected = {("removed", n + 1, left[n]) for n in removed} | {("inserted", n, t) for n, t in enumerate(kept, 1) if t.startswith("inserted")}
    assert found == expected
