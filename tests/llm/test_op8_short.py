"""The order of short texts counts: their fingerprints agree as 64 permutations of all k-mers would."""

import random

from lexiflow.llm import order_minhash


def likeness_by_permutations(a, b, n=400):
    """The share of n random orders of all k-mers in which the first two, as they stand in the text, agree; the last word alone is one more k-mer."""
    at = [{pair: i for i, pair in enumerate(zip(words, [*words[1:], None]))} for words in (a, b)]
    every, rng, same = sorted({*at[0], *at[1]}, key=str), random.Random(5), 0
    for _ in range(n):
        rank = {pair: rng.random() for pair in every}
        first = [sorted(sorted(places, key=rank.get)[:2], key=places.get) for places in at]
        same += first[0] == first[1]
    return same / n


def test_swapped_halves_of_short_texts(spark):
    rng, rows, expected = random.Random(3), [], {}
    for size in (20, 40, 60, 100):
        for k in range(12):
            words = [f"{rng.randrange(10**9):x}" for _ in range(size)]
            swapped = words[size // 2 :] + words[: size // 2]
            rows.append((size, " ".join(words), " ".join(swapped)))
            expected.setdefault(size, []).append(likeness_by_permutations(words, swapped))
    df = spark.createDataFrame(rows, "size int, a string, b string")
    near = order_minhash.likeness(order_minhash.signature(df.a), order_minhash.signature(df.b))
    found = {}
    for r in df.select("size", near.alias("near")).collect():
        found.setdefault(r["size"], []).append(r["near"])
    print({size: (sum(v) / 12, sum(expected[size]) / 12) for size, v in sorted(found.items())})
    for size, values in found.items():
        assert abs(sum(values) / len(values) - sum(expected[size]) / len(expected[size])) < 0.07
