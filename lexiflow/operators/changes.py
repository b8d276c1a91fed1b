"""What a change touches: digests kept by group, the difference of two states, renewed results.

A state has a row a group, with sums of hashes of all rows that bear on the group, so it takes
one aggregation that is combined in each task before anything is sent, and no row is moved.
Whatever is derived from whole groups needs to be derived again only for groups that differ.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.session import materialise


def state_of(tables: dict[str, DataFrame], group: str) -> DataFrame:
    """(group, first, second, n): the digest of each group's rows in named tables, 128 bits a
    row. The order of rows and of columns does not matter, repeated rows count, a null field
    is as good as none, and null is a group."""
    seen = []
    for name, df in sorted(tables.items()):
        row = F.to_json(F.struct(*(F.col(c) for c in sorted(df.columns) if c != group), F.lit(name).alias("__table")))
        seen.append(df.select(group, F.xxhash64(row).alias("a"), F.xxhash64(F.lit(1), row).alias("b")))
    every = seen[0]
    for df in seen[1:]:
        every = every.unionByName(df)
    total = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).cast("decimal(38,0)")
    return every.groupBy(group).agg(total("a").alias("first"), total("b").alias("second"), F.count("*").alias("n"))


def touched(before: DataFrame, after: DataFrame, group: str) -> DataFrame:
    """(group, change): groups that are `added`, `removed` or `changed` between two states."""
    a = before.select(F.col(group).alias("__of_a"), F.struct("first", "second", "n").alias("__a"))
    b = after.select(F.col(group).alias("__of_b"), F.struct("first", "second", "n").alias("__b"))
    met = a.join(b, F.col("__of_a").eqNullSafe(F.col("__of_b")), "full_outer").where(~F.col("__a").eqNullSafe(F.col("__b")))
    change = F.when(F.col("__a").isNull(), "added").when(F.col("__b").isNull(), "removed").otherwise("changed")
    return met.select(F.coalesce("__of_a", "__of_b").alias(group), change.alias("change"))


def only(df: DataFrame, groups: DataFrame, group: str, how: str = "left_semi") -> DataFrame:
    """The rows of `df` in some groups, or with left_anti in none of them; null is a group."""
    wanted = groups.select(F.col(group).alias("__wanted"))
    return df.join(wanted, F.col(group).eqNullSafe(F.col("__wanted")), how)


def closure(keys: DataFrame, members: list[DataFrame], key: str, group: str) -> DataFrame:
    """(group): the groups that a touched key is in, or was: `members` are tables (key, group),
    of before and after. What holds of a group is settled by all its keys, and a key is in one
    group of a table, so no further group is touched."""
    every = members[0].select(key, group)
    for other in members[1:]:
        every = every.unionByName(other.select(key, group))
    return only(every, keys, key).select(group).distinct()


def renewed(kept: DataFrame, groups: DataFrame, group: str, tables: dict[str, DataFrame], derive: Callable[[dict[str, DataFrame]], DataFrame]) -> DataFrame:
    """A result with the rows of touched groups derived again, out of their rows alone."""
    fresh = derive({name: only(df, groups, group) for name, df in tables.items()})
    return only(kept, groups, group, "left_anti").unionByName(fresh)


def step(kept: DataFrame, kept_state: DataFrame, group: str, tables: dict[str, DataFrame], bearing: dict[str, DataFrame], derive: Callable[[dict[str, DataFrame]], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(result, state) after a change, both to be kept for the next: `bearing` are the tables
    with the columns that the result depends on. The state and what is touched are written."""
    state = materialise(state_of(bearing, group))
    groups = materialise(touched(kept_state, state, group))
    return renewed(kept, groups, group, tables, derive), state
