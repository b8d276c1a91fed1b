"""Joins with split keys, and components where every key is split and every group cut into blocks."""

import functools
import random

import pytest

from lexiflow.llm import common, minhash
from tests.llm.test_operators import brute_components


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
def test_split_join_equals_a_join(spark, how):
    many = spark.createDataFrame([(k % 5 if k % 3 else 0, k) for k in range(60)] + [(None, 99), (7, 100)], "k bigint, v bigint")
    one = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c"), (9, "z")], "k bigint, w string")
    rows = lambda df: sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)
    assert common.frequent(many, "k", 100) is None and common.frequent(many, "k", 5).count() > 1
    assert rows(common.split_join(many, one, "k", "v", how, most=5)) == rows(many.join(one, "k", how))


@pytest.mark.parametrize("block", [60, 400])
def test_components_with_split_keys_and_small_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(minhash, "split_join", functools.partial(common.split_join, most=3))
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block)
    monkeypatch.setattr(minhash, "COLUMNS", 50)
    rng, rows = random.Random(block), []
    words = [f"w{i}" for i in range(60)]
    for group in range(5):
        base = [rng.choice(words) for _ in range(30 + 6 * group)]
        for _ in range(25 if group else 50):  # similarities on both sides of the threshold, in chains
            base = list(base)
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = rng.choice(words)
            rows.append((len(rows), " ".join(base)))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = minhash.near_duplicates(df, 2).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == sorted(brute_components(rows, 2, 80))


def test_more_bands_are_a_parameter(spark):
    df = spark.createDataFrame([(0, "a b c d e f"), (1, "a b c d e f g"), (2, "x y")], "doc_id bigint, text string")
    found = minhash.near_duplicates(df, 2, count=20, band_rows=1).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in found) == [(0, 0), (1, 0), (2, 2)]
    assert minhash.bands(minhash.shingles("a b c", 2), 20, 1).size == 40
