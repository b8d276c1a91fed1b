"""Where two ordered tables differ, by trees of hashes.

Rows are digested by ranges of places, and the digests of ranges by wider ranges, level by
level. Both trees are compared from the top, and only below nodes that differ, so what is
sent is in proportion to the differences; only rows of ranges that differ are joined.

An inserted row moves all places after it. To find it, ranges end at rows that are chosen by
their own content, so that later ranges stay what they were; ranges that both sides have are
left out, and of the others the rows that only one side has are what was inserted or removed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiflow.operators.running import running
from lexiflow.session import discard, materialise, same_files

#: Places of a leaf, and nodes under a node.
LEAF, FANOUT = 1024, 32


def node_of(place: Column, width: int) -> Column:
    return F.floor(place / width).cast("bigint")


def digests(df: DataFrame, ordinal: str, columns: list[str]) -> DataFrame:
    """(node, hash, n) of each leaf, written; equal rows at one place count each."""
    row = F.xxhash64(ordinal, F.to_json(F.struct(*columns)))
    return materialise(df.groupBy(node_of(F.col(ordinal), LEAF).alias("node")).agg(F.bit_xor(row).alias("hash"), F.count("*").alias("n")))


def differing_leaves(left: DataFrame, right: DataFrame, ordinal: str, columns: list[str]) -> DataFrame:
    """(node): the leaves that are not alike."""
    sides = [digests(df, ordinal, columns) for df in (left, right)]
    top = max((s.agg(F.max("node")).first()[0] or 0) for s in sides)
    levels, nodes = 1, None
    while FANOUT**levels <= top:
        levels += 1
    for level in reversed(range(levels)):
        width, parent = FANOUT**level, node_of(F.col("node"), FANOUT ** (level + 1))

        def at_level(leaves: DataFrame) -> DataFrame:
            below = leaves if nodes is None else leaves.join(nodes.withColumnRenamed("node", "parent"), parent == F.col("parent"), "left_semi")
            return below.groupBy(node_of(F.col("node"), width).alias("node")).agg(F.bit_xor("hash").alias("hash"), F.sum("n").alias("n"))

        a, b = (at_level(s) for s in sides)
        unlike = a.alias("a").join(b.alias("b"), "node", "full_outer").where(~(F.col("a.hash").eqNullSafe(F.col("b.hash")) & F.col("a.n").eqNullSafe(F.col("b.n"))))
        was, nodes = nodes, materialise(unlike.select("node"))
        discard(*([] if was is None else [was]))
    discard(*sides)
    return nodes


def positional_difference(left: DataFrame, right: DataFrame, ordinal: str, columns: list[str]) -> DataFrame:
    """Places at which two ordered streams differ, or only one has a row: (ordinal, l, r)."""
    leaves = differing_leaves(left, right, ordinal, columns)
    own = lambda df, name: df.select(ordinal, F.struct(*columns).alias(name)).join(leaves, node_of(F.col(ordinal), LEAF) == F.col("node"), "left_semi")
    return same_files(own(left, "l").join(own(right, "r"), ordinal, "full_outer").where(~F.col("l").eqNullSafe(F.col("r"))), leaves)


def ranges_by_content(df: DataFrame, ordinal: str, columns: list[str], size: int) -> DataFrame:
    """The rows with `row` (a hash) and `first`, the place at which their range begins: about
    every `size`-th row begins one, by its own hash."""
    hashed = df.select(ordinal, *columns, F.xxhash64(F.to_json(F.struct(*columns))).alias("row"))
    marked = hashed.withColumn("__mark", F.when(F.pmod("row", F.lit(size)) == 0, F.col(ordinal)))
    return running(marked, [], [ordinal], "__mark", "first", last=True).drop("__mark").withColumn("first", F.coalesce("first", F.lit(0)))


def row_changes(left: DataFrame, right: DataFrame, ordinal: str, columns: list[str], size: int = LEAF) -> DataFrame:
    """(change, ordinal, *columns): rows `removed` from the left and `inserted` on the right, with
    their places there. Of equal rows the last ones count as those that only one side has."""
    cut = [materialise(ranges_by_content(df, ordinal, columns, size)) for df in (left, right)]
    same = Window.partitionBy("hash", "n").orderBy("first")
    sums = [c.groupBy("first").agg(F.sum(F.xxhash64("row", F.col(ordinal) - F.col("first")).cast("decimal(38,0)")).alias("hash"), F.count("*").alias("n")).withColumn("k", F.row_number().over(same)) for c in cut]
    rest = [c.join(own.join(other, ["hash", "n", "k"], "left_anti").select("first"), "first", "left_semi") for c, own, other in zip(cut, sums, reversed(sums))]
    again = Window.partitionBy("row").orderBy(ordinal)
    counted = [r.withColumn("k", F.row_number().over(again)) for r in rest]
    only = [own.join(other.select("row", "k"), ["row", "k"], "left_anti").select(F.lit(what).alias("change"), ordinal, *columns) for what, own, other in zip(("removed", "inserted"), counted, reversed(counted))]
    return only[0].unionByName(only[1])
