"""Near duplicates by min-max hashing, confirmed on full shingle sets.

Each permutation gives two values of a set's signature, its least and its greatest
hash, so half as many hashes are evaluated. Bands of values deal sets into
buckets. Texts with equal sets are one node from the start, so copies never meet
in pairs. In each bucket the sets are compared with one centre first, and links
confirmed on the full sets are contracted to components. Buckets that still hold
several components get other centres, and at last the sets of different components
that share a bucket and are close in size are compared block by block as matrices, so
no candidate goes unchecked and no group is written out as pairs. Frequent keys of a
join are split. Only counts and the most frequent keys reach the driver.

A pair of similarity s shares no band of r values out of b with a chance of about
(1 - s^r)^b: with the defaults 1.5 in 100,000 at 0.8 and less above; more
`permutations` or fewer `band_rows` lower it as far as is wanted.

Defined cases: texts that are null, empty or have no words have an empty set, are
linked with nothing and kept; texts of fewer words than a shingle have one
shingle, all their words. Rows with equal ids count as linked with each other.
Rows with a null id are linked with nothing: no component, and kept. Very long
texts are read whole; an empty table gives an empty table.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import discard, map_texts, materialise, same_files, split_join

#: Permutations (two values each), and values in a band, unless others are given.
PERMUTATIONS, BAND_ROWS = 70, 5
#: Shingles in a block of sets that is compared as a matrix, about; columns of a matrix.
BLOCK_SHINGLES, COLUMNS = 60_000, 4096
#: Shingles hashed at a time.
CHUNK = 8192
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


@functools.lru_cache(maxsize=4)
def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Seeds and odd factors of so many permutations of 64-bit numbers."""
    random = np.random.default_rng(20_240_607)
    return random.integers(0, 1 << 63, count, dtype=np.uint64), random.integers(0, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the word shingles; words are lower-cased in A-Z only
    and separated by ASCII white space."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.full(len(words) - width + 1, np.uint64(width))
    with np.errstate(over="ignore"):
        for k in range(width):
            total = mixed(total * GOLDEN + hashes[k : len(words) - width + 1 + k])
    return np.unique(total)


def bands(found: np.ndarray, count: int = PERMUTATIONS, band_rows: int = BAND_ROWS) -> np.ndarray:
    """Hashes of the bands of a set's min-max signature; values short of a band are left out."""
    seeds, factors = permutations(count)
    low = np.full(count, np.uint64((1 << 64) - 1))
    high = np.zeros(count, np.uint64)
    with np.errstate(over="ignore"):
        for a in range(0, found.size, CHUNK):
            values = (found[a : a + CHUNK, None] ^ seeds) * factors
            np.minimum(low, values.min(0), out=low)
            np.maximum(high, values.max(0), out=high)
        rows = np.concatenate([low, high])
        rows = rows[: rows.size // band_rows * band_rows].reshape(-1, band_rows)
        total = np.arange(len(rows), dtype=np.uint64) * GOLDEN
        for k in range(band_rows):
            total = mixed(total + rows[:, k])
    return total.view(np.int64)


def features(df: DataFrame, width: int, id_col: str, text_col: str, count: int, band_rows: int) -> DataFrame:
    """(id, n, fp binary, bands array<bigint>): size, digest and bands of each text's set."""

    def work(texts: list[str]) -> Iterator[tuple]:
        for t in texts:
            found = shingles(t, width)
            yield found.size, hashlib.blake2b(found.tobytes(), digest_size=16).digest(), bands(found, count, band_rows).tolist() if found.size else []

    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    return map_texts(rows, "id", "text", "n bigint, fp binary, bands array<bigint>", lambda: work)


def shingle_sets(df: DataFrame, wanted: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(id, shingles binary) of the rows whose id is in `wanted` (id)."""
    rows = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).join(wanted, "id", "left_semi")
    return map_texts(rows, "id", "text", "shingles binary", lambda: lambda texts: ((shingles(t, width).tobytes(),) for t in texts))


def confirmed(edges: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The (a, b) among `edges` whose full sets have 100 |a & b| >= percent |a | b|; each b
    is in few edges, each a in any number."""
    edges = materialise(edges.distinct())
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("of_b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                small, large = sorted((x.size, y.size))
                common = np.intersect1d(x, y, assume_unique=True).size if 100 * small >= percent * large else 0
                keep.append(100 * common >= percent * (x.size + y.size - common) and common > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    pairs = split_join(edges, left, "a", "b").join(right, "b").select("a", "b", "of_a", "of_b")
    found = materialise(pairs.mapInArrow(run, "a bigint, b bigint"))
    discard(edges)
    return found


def connected(edges: DataFrame) -> DataFrame | None:
    """(node, root): the least node reachable, for each node of `edges` (a, b) that is not
    a root itself; None without edges. Large and small stars alternate until nothing
    changes."""
    edges = materialise(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    number, state = edges.count(), None
    if not number:
        discard(edges)
        return None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = split_join(both, least, "u", "v", rows=2 * number).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        own = least.select("u", F.col("m").alias("v"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(own).distinct()
        after = materialise(small)
        discard(edges)
        edges = after
        now = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == state:
            return same_files(edges.select(F.col("u").alias("node"), F.col("v").alias("root")), edges)
        number, state = now[0], now


class Components:
    """Roots of nodes, joined step by step by confirmed links."""

    def __init__(self):
        self.roots: DataFrame | None = None

    def of(self, df: DataFrame, column: str, name: str) -> DataFrame:
        """Adds the root of the node in `column`."""
        if self.roots is None:
            return df.withColumn(name, F.col(column))
        roots = self.roots.select(F.col("node").alias(column), F.col("root").alias("__root"))
        return df.join(roots, column, "left").withColumn(name, F.coalesce("__root", column)).drop("__root")

    def link(self, links: DataFrame) -> None:
        """Joins the components that `links` (a, b) connect."""
        between = self.of(self.of(links, "a", "x"), "b", "y").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        merged = connected(between)
        discard(links)
        if merged is None:
            return
        if self.roots is None:
            self.roots = merged
            return
        moved = merged.select(F.col("node").alias("root"), F.col("root").alias("to"))
        kept = self.roots.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        renewed = materialise(kept.unionByName(merged))
        discard(self.roots, merged)
        self.roots = renewed


def counts_in_common(x: list[np.ndarray], y: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets of `x` with all of `y`, as products of
    incidence matrices over the shingles that both sides have."""
    shared = np.intersect1d(np.concatenate(x), np.concatenate(y))
    total = np.zeros((len(x), len(y)), np.float32)

    def incidence(sets: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
        flat = np.concatenate(sets)
        row = np.repeat(np.arange(len(sets)), [s.size for s in sets])
        place = np.searchsorted(columns, flat)
        there = columns[np.minimum(place, columns.size - 1)] == flat
        out = np.zeros((len(sets), columns.size), np.float32)
        out[row[there], place[there]] = 1
        return out

    for k in range(0, shared.size, COLUMNS):
        columns = shared[k : k + COLUMNS]
        total += incidence(x, columns) @ incidence(y, columns).T
    return total


def spanning_links(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, linked: np.ndarray) -> list[tuple[int, int]]:
    """Of the linked pairs as many as connect the parts they lie in."""
    roots: dict[int, int] = {}

    def root(p: int) -> int:
        while (q := roots.get(p, p)) != p:
            roots[p] = roots.get(q, q)
            p = q
        return p

    out = []
    for i, j in zip(*np.nonzero(linked & (of_a[:, None] != of_b[None, :]))):
        p, q = root(int(of_a[i])), root(int(of_b[j]))
        if p != q:
            roots[max(p, q)] = min(p, q)
            out.append((int(a[i]), int(b[j])))
    return out


def links_between_parts(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that connect all parts of each bucket in `members` (bucket, rep, n,
    part) that any link does. Buckets with the same least part, their hub, are taken
    together, and of these the sets of a class of sizes with those of the class below; such
    a group is cut into blocks of about as many shingles, and each two blocks, but for two
    of the hub itself, go to a task of their own. There the sets that share a bucket, are
    of different parts and close in size are compared as matrices, so no pair becomes a
    row unless it links two parts."""
    hubs = members.groupBy("bucket").agg(F.min("part").alias("hub"))
    rows = split_join(members, hubs, "bucket", "rep").groupBy("hub", "rep", "n", "part").agg(F.collect_list("bucket").alias("buckets"))
    # sizes of linked sets differ by less than a class and a bit, so by one class at most
    size = F.floor(F.log(F.col("n")) / (math.log(100 / percent) + 1e-3))
    rows = materialise(rows.withColumn("size", size).withColumn("upper", F.explode(F.array(F.col("size"), F.col("size") + 1))).withColumn("group", F.xxhash64("hub", "upper")))
    own = F.col("part") == F.col("hub")
    blocks = lambda size: F.greatest(F.lit(1), F.ceil(F.coalesce(size, F.lit(0)) / BLOCK_SHINGLES))
    sizes = rows.groupBy("group").agg(blocks(F.sum(F.when(own, F.col("n")))).alias("hub_blocks"), blocks(F.sum(F.when(~own, F.col("n")))).alias("blocks"), F.max(F.col("size") == F.col("upper")).alias("any"))
    dealt = split_join(rows, sizes.where("any").drop("any"), "group", "rep").withColumn("block", F.pmod(F.xxhash64("rep"), F.when(own, F.col("hub_blocks")).otherwise(F.col("blocks"))))
    upto = lambda first, last: F.sequence(first.cast("bigint"), last.cast("bigint"))
    zero = F.lit(0)
    what = ["group", "rep", "part", "buckets", (F.col("size") == F.col("upper")).alias("top")]
    # a tile is (group, block of others, whether the other side is the hub's, its block)
    with_hub = F.transform(upto(zero, F.col("hub_blocks") - 1), lambda j: F.struct(F.lit(True).alias("h"), j.alias("j")))
    with_others = F.transform(upto(F.col("block"), F.col("blocks") - 1), lambda j: F.struct(F.lit(False).alias("h"), j.alias("j")))
    left = dealt.where(~own).select(*what, F.col("block").alias("i"), F.explode(F.concat(with_hub, with_others)).alias("t")).select("*", "t.*").drop("t")
    over = F.when(own, upto(zero, F.col("blocks") - 1)).otherwise(upto(zero, F.col("block")))
    right = dealt.select(*what, own.alias("h"), F.col("block").alias("j"), F.explode(over).alias("i"))
    left = left.join(sets.withColumnRenamed("id", "rep"), "rep")
    right = right.join(sets.withColumnRenamed("id", "rep"), "rep")
    right = right.select(*(F.col(c).alias(f"r_{c}") for c in ("group", "i", "h", "j", "rep", "part", "buckets", "top", "shingles")))

    def compare(x: pd.DataFrame, y: pd.DataFrame) -> pd.DataFrame:
        links: list[tuple[int, int]] = []
        if len(x) and len(y):
            n, m = ((side.str.len() // 8).to_numpy()[:, None] for side in (x["shingles"], y["r_shingles"]))
            may = x["top"].to_numpy()[:, None] | y["r_top"].to_numpy()[None, :]
            may &= x["part"].to_numpy()[:, None] != y["r_part"].to_numpy()[None, :]
            may &= (100 * n >= percent * m.T) & (100 * m.T >= percent * n)
            may &= counts_in_common(*([np.sort(np.asarray(b, np.int64)) for b in side] for side in (x["buckets"], y["r_buckets"]))) > 0
            x, y = x[may.any(1)], y[may.any(0)]
            may = may[may.any(1)][:, may.any(0)]
        if len(x) and len(y):
            of_x, of_y = ([np.frombuffer(s, np.uint64) for s in side] for side in (x["shingles"], y["r_shingles"]))
            common = counts_in_common(of_x, of_y).astype(np.int64)
            union = np.array([s.size for s in of_x])[:, None] + np.array([s.size for s in of_y])[None, :] - common
            linked = may & (100 * common >= percent * union) & (common > 0)
            links = spanning_links(x["rep"].to_numpy(), y["r_rep"].to_numpy(), x["part"].to_numpy(), y["r_part"].to_numpy(), linked)
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    tiles = left.groupBy("group", "i", "h", "j").cogroup(right.groupBy("r_group", "r_i", "r_h", "r_j"))
    found = materialise(tiles.applyInPandas(compare, "a bigint, b bigint"))
    discard(rows)
    return found


def near_duplicates(df: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", count: int = PERMUTATIONS, band_rows: int = BAND_ROWS) -> DataFrame:
    """(id, n_shingles, component_id, kept): the size of each text's set, the least id that
    links of similarity percent / 100 or more reach from it, and whether that is its own.
    `count` permutations in bands of `band_rows` values find the candidates."""
    found = materialise(features(df, width, id_col, text_col, count, band_rows))
    linkable = found.where("n > 0 and id is not null")
    nodes = materialise(linkable.groupBy("fp").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands")))
    dealt = nodes.select("rep", "n", F.explode("bands").alias("bucket"))
    shared = dealt.groupBy("bucket").agg(F.min("rep").alias("centre"), F.max("rep").alias("last")).where("centre <> last").select("bucket", "centre")
    members = materialise(split_join(dealt, shared, "bucket", "rep"))
    sets = materialise(shingle_sets(df, members.select(F.col("rep").alias("id")).distinct(), width, id_col, text_col))
    parts = Components()

    first = members.where("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b"))
    parts.link(confirmed(first, sets, percent))

    def mixed_buckets() -> DataFrame:
        """Members, with their components, of buckets that hold several."""
        placed = materialise(parts.of(members.select("bucket", "rep", "n"), "rep", "part"))
        several = placed.groupBy("bucket").agg(F.min("part").alias("p"), F.max("part").alias("q")).where("p <> q").select("bucket")
        kept = materialise(split_join(placed, several, "bucket", "rep"))
        discard(placed)
        return kept

    def close(x: str, y: str) -> Column:
        return (F.col(x) * 100 >= F.col(y) * percent) & (F.col(y) * 100 >= F.col(x) * percent)

    # other centres: in each bucket the member that comes first in an order of its own
    left = mixed_buckets()
    order = F.struct(F.xxhash64("rep", "bucket"), "rep", "n", "part")
    centres = left.groupBy("bucket").agg(F.min(order).alias("c")).select("bucket", F.col("c.rep").alias("centre"), F.col("c.n").alias("size"), F.col("c.part").alias("own"))
    second = split_join(left, centres, "bucket", "rep").where((F.col("part") != F.col("own")) & close("n", "size"))
    parts.link(confirmed(second.select(F.col("centre").alias("a"), F.col("rep").alias("b")), sets, percent))
    discard(left)

    left = mixed_buckets()
    parts.link(links_between_parts(left, sets, percent))
    discard(left)

    # an id with several sets joins their components
    several = linkable.select("id", "fp").distinct().groupBy("id").agg(F.count("*").alias("k")).where("k > 1")
    split = linkable.join(several, "id", "left_semi").join(nodes.select("fp", "rep"), "fp").select(F.col("id").alias("a"), F.col("rep").alias("b"))
    parts.link(split)

    placed = parts.of(linkable.join(nodes.select("fp", "rep"), "fp").select("id", "n", "rep"), "rep", "component_id").select("id", "n", "component_id")
    alone = found.where("n = 0 or id is null").select("id", "n", F.when(F.col("id").isNotNull(), F.col("id")).alias("component_id"))
    result = placed.unionByName(alone).select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
    result = materialise(result)
    discard(found, nodes, members, sets, *([parts.roots] if parts.roots is not None else []))
    return result
