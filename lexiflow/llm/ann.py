"""Nearest neighbours by a block matrix join.

Vectors are quantised once to int8 with one scale each, and only codes, scales and
norms travel to the tiles. Queries and candidates are cut into blocks by a hash of
their rows; for each pair of blocks one task multiplies the int8 tiles. With the norms
of the quantisation errors every product has a bound, so only pairs that may be among
a query's nearest in the tile go on, and of these only those that may be among its
nearest in all tiles. Of equal vectors, however many, only those with the least ids are
candidates, as no others can be found. These few are computed again in double precision from the
vectors themselves and merged by a heap for each query.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows with a null id; vectors are compared with
those of their own length only; equal scores are ordered by id; rows with equal
ids and vectors count as they come, except that a query never finds its own id;
queries without candidates have no rows; an empty table gives an empty table. Where a
bound is beyond the range of doubles the pair is kept; a product beyond it is infinite,
and one that is no number ranks last.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiflow.llm.common import materialise, split_join

#: Vectors in a block of queries, of candidates, about; queries multiplied at a time.
QUERY_BLOCK, CANDIDATE_BLOCK, QUERIES_AT_ONCE = 2048, 8192, 256
#: Sums of products of int8 are exact in float32 up to so many components.
EXACT_DIMENSIONS = 1024
#: A query with more pairs to compute again has them computed in parts.
MOST_SURVIVORS = 256
#: What is sent to tiles of each vector.
CODE = ["key", "id", "codes", "scale", "meant", "error"]


def norms(x: np.ndarray) -> np.ndarray:
    """Euclidean norms that neither overflow nor vanish before their result does."""
    top = np.abs(x).max(1, initial=0)
    return top * np.linalg.norm(x / np.where(top > 0, top, 1)[:, None], axis=1)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(int8 codes, scales, norms of what the codes stand for, norms of the errors)."""
    scale = np.abs(x).max(1) / 127
    codes = np.rint(x / np.where(scale > 0, scale, np.inf)[:, None]).astype(np.int8)
    meant = codes * scale[:, None]
    return codes, scale, norms(meant), norms(x - meant)


def tile_product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The exact integer products of two int8 tiles, through float32 matrix products."""
    out = np.zeros((len(a), len(b)))
    for d in range(0, a.shape[1], EXACT_DIMENSIONS):
        out += a[:, d : d + EXACT_DIMENSIONS].astype(np.float32) @ b[:, d : d + EXACT_DIMENSIONS].astype(np.float32).T
    return out


def bounds(queries: tuple[np.ndarray, ...], vectors: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """(least, greatest) that each inner product can be, infinite where unknown."""
    (qc, qs, qn, qe), (vc, vs, vn, ve) = queries, vectors
    with np.errstate(over="ignore", invalid="ignore"):
        about = tile_product(qc, vc) * qs[:, None] * vs[None, :]
        # x.y = x'.y' + x'.dy + dx.y, and |y| <= |y'| + |dy|
        error = qn[:, None] * ve[None, :] + qe[:, None] * (vn + ve)[None, :]
        error += 1e-9 * (qn + qe)[:, None] * (vn + ve)[None, :] + 1e-300
        low, high = about - error, about + error
    known = np.isfinite(low) & np.isfinite(high)
    return np.where(known, low, -np.inf), np.where(known, high, np.inf)


def survivors(query_ids: np.ndarray, queries: tuple[np.ndarray, ...], ids: np.ndarray, vectors: tuple[np.ndarray, ...], k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(query, candidates, least, greatest products), by their places in the tile, of all
    pairs that may be among the query's k nearest of one block."""
    keep = min(k, len(ids))
    for a in range(0, len(query_ids), QUERIES_AT_ONCE):
        part = slice(a, a + QUERIES_AT_ONCE)
        low, high = bounds(tuple(x[part] for x in queries), vectors)
        own = query_ids[part, None] == ids[None, :]
        low[own] = -np.inf
        floor = np.partition(low, len(ids) - keep, axis=1)[:, len(ids) - keep]
        may = (high >= floor[:, None]) & ~own
        for q, there in enumerate(may):
            if there.any():
                at = np.flatnonzero(there)
                yield a + q, at, low[q, at], high[q, at]


def usable(id_col: str, vector: Column) -> Column:
    """Whether a vector takes part."""
    sound = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.coalesce(F.col(id_col).isNotNull() & (F.size(vector) > 0) & F.forall(vector, sound) & F.exists(vector, lambda x: x != 0), F.lit(False))


def coded(rows: DataFrame) -> DataFrame:
    """Adds the codes, scale and norms of each vector to rows (key, id, dim, q, v)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = part.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                codes, *numbers = quantise(x)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array([c.tobytes() for c in codes], pa.binary()), *map(pa.array, numbers)], names=[*part.schema.names, *CODE[2:]])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{fields}, codes binary, scale double, meant double, error double")


def search(df: DataFrame, is_query: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, <id>, score): the k rows of the largest inner product with each
    row for which `is_query` holds, itself left out."""
    vector = F.col(vector_col)
    rows = df.where(usable(id_col, vector.cast("array<double>"))).select(F.monotonically_increasing_id().alias("key"), F.col(id_col).cast("bigint").alias("id"), F.size(vector).alias("dim"), F.coalesce(is_query, F.lit(False)).alias("q"), vector.alias("v"))
    held = materialise(coded(rows))
    # of equal vectors only the k + 1 of the least ids can be among the k nearest of a row
    among_equals = F.row_number().over(Window.partitionBy("v").orderBy("id", "key"))
    others = held.select(*CODE, "dim", "v").withColumn("r", among_equals).where(F.col("r") <= k + 1).drop("r", "v")
    n, n_queries = held.agg(F.count("*"), F.count_if("q")).first()
    parts, query_parts = max(1, -(-n // CANDIDATE_BLOCK)), max(1, -(-n_queries // QUERY_BLOCK))
    block = lambda seed, of: F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(of))
    every = lambda of: F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(of - 1).cast("bigint")))
    queries = held.where("q").select(*CODE, "dim", block(1, query_parts).alias("qb")).withColumn("cb", every(parts))
    candidates = others.select(*(F.col(c).alias(f"c_{c}") for c in CODE), F.col("dim").alias("size"), block(2, parts).alias("in_cb")).withColumn("in_qb", every(query_parts))

    def arrays(side: pd.DataFrame, prefix: str) -> tuple[np.ndarray, ...]:
        codes = np.frombuffer(b"".join(side[f"{prefix}codes"]), np.int8).reshape(len(side), -1)
        return codes, *(side[f"{prefix}{c}"].to_numpy() for c in CODE[3:])

    def tile(asked: pd.DataFrame, there: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(asked) and len(there):
            keys, own = there["c_key"].to_numpy(), asked["key"].to_numpy()
            for q, at, low, high in survivors(asked["id"].to_numpy(), arrays(asked, ""), there["c_id"].to_numpy(), arrays(there, "c_"), k):
                found.append((int(own[q]), keys[at], low, high))
        return pd.DataFrame(found, columns=["query", "keys", "lows", "highs"])

    def merge(pairs: pd.DataFrame) -> pd.DataFrame:
        last = np.isnan(pairs["score"])
        best = heapq.nsmallest(k, zip(last, np.where(last, 0, -pairs["score"]), pairs["id"], pairs["score"]))
        return pd.DataFrame({"query_id": pairs["query_id"].iloc[0], "rank": np.arange(1, len(best) + 1, dtype=np.int32), "id": [i for *_, i, _ in best], "score": [s for *_, s in best]})

    lists = queries.groupBy("qb", "cb", "dim").cogroup(candidates.groupBy("in_qb", "in_cb", "size")).applyInPandas(tile, "query bigint, keys array<bigint>, lows array<double>, highs array<double>")
    # over all tiles: the k-th greatest of the least products is a floor for the greatest
    pairs = F.flatten(F.collect_list(F.arrays_zip("keys", "highs")))
    lows = F.sort_array(F.flatten(F.collect_list("lows")), asc=False)
    found = lists.groupBy("query").agg(pairs.alias("pairs"), F.coalesce(F.get(lows, F.lit(k - 1)), F.lit(float("-inf"))).alias("floor"))
    few = found.select("query", F.explode(F.filter("pairs", lambda p: p["highs"] >= F.col("floor"))).alias("p")).select("query", F.col("p.keys").alias("key"))
    own = held.where("q").select(F.col("key").alias("query"), F.col("id").alias("query_id"), F.col("v").cast("array<double>").alias("x"))
    both = split_join(few.join(held.select("key", "id", F.col("v").cast("array<double>").alias("y")), "key"), own, "query", "key", most=MOST_SURVIVORS)
    # added up component by component in double precision
    score = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda total, p: total + p)
    scored = both.select("query", "query_id", "id", score.alias("score"))
    # each task sends on no more than k rows of a query
    order = F.row_number().over(Window.partitionBy("query").orderBy(F.isnan("score"), F.desc("score"), "id"))
    nearest = scored.withColumn("r", order).where(F.col("r") <= k).drop("r")
    merged = nearest.groupBy("query").applyInPandas(merge, "query_id bigint, rank int, id bigint, score double")
    # pandas gives no numbers as nulls
    return merged.select("query_id", "rank", F.col("id").alias(id_col), F.coalesce("score", F.lit(float("nan"))).alias("score"))
