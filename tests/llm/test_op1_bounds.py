"""Nearest neighbours of vectors at the ends of the range of doubles, and of repeated ids."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexiflow.llm import ann


def by_loops(rows, k):
    """(query id, [(id, score)]) of each query row, products added up in order."""
    out = []
    for q, x in rows:
        if q % 20 == 0:
            scored = []
            for i, y in rows:
                if i != q:
                    total = 0.0
                    for a, b in zip(x, y):
                        total += a * b
                    scored.append((math.isnan(total), 0 if math.isnan(total) else -total, i, total))
            out.append((q, [(i, s) for *_, i, s in sorted(scored, key=lambda t: t[:3])[:k]]))
    return sorted(out, key=str)


def found(spark, rows, k):
    df = spark.createDataFrame([(i, [float(c) for c in v], "x") for i, v in rows], "vec_id bigint, embedding array<double>, key string")
    got = {}
    for r in sorted(ann.search(df, F.col("vec_id") % 20 == 0, k=k).collect(), key=lambda r: r["rank"]):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return sorted(got.items(), key=str)


@pytest.mark.parametrize("size", [1e160, 1e150, 1.0, 1e-160, 1e-308])
def test_finite_vectors_of_any_size(spark, size, monkeypatch):
    monkeypatch.setattr(ann, "CANDIDATE_BLOCK", 20)
    rng = np.random.default_rng(8)
    rows = [(i, (x * size).tolist()) for i, x in enumerate(rng.normal(size=(45, 5)))]
    assert str(found(spark, rows, 5)) == str(by_loops(rows, 5))


def test_mixed_sizes(spark):
    rng = np.random.default_rng(9)
    rows = [(i, (x * 10.0 ** rng.integers(-150, 160)).tolist()) for i, x in enumerate(rng.normal(size=(45, 4)))]
    assert str(found(spark, rows, 6)) == str(by_loops(rows, 6))


def test_repeated_ids_are_found_each_and_never_by_themselves(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (1, [2.0, 0.0]), (1, [3.0, 1.0]), (2, [1.0, 1.0])]
    assert found(spark, rows, 3) == [(0, [(1, 3.0), (1, 2.0), (1, 2.0)])]


def test_many_equal_vectors(spark):
    rows = [(i, [1.0, 2.0]) for i in range(60)] + [(100 + i, [1.0, 2.0 + i / 100]) for i in range(5)] + [(2, [1.0, 2.0])] * 5
    assert found(spark, rows, 6) == by_loops(rows, 6)
