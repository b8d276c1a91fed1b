"""Prioritised joins, coverage, division, fills and positional comparison."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def spelling_index(df: DataFrame, spellings: list[Column], name: str = "spelling") -> DataFrame:
    """One row for each distinct spelling of a row that is not null."""
    return df.withColumn(name, F.explode(F.array_distinct(F.array_compact(F.array(*spellings)))))


def tiered_match(left: DataFrame, right: DataFrame, left_id: str, tiers: list[tuple[list[Column], list[Column]]]) -> DataFrame:
    """Pairs of `left` with all rows of `right` that agree in the keys of the first tier
    in which there are any; adds `tier`, from 1. Each tier sees only the rows that no
    earlier one has matched."""
    result, rest = None, left
    for number, (of_left, of_right) in enumerate(tiers, 1):
        keys = [f"__k{n}" for n in range(len(of_left))]
        l = rest.withColumns(dict(zip(keys, of_left)))
        r = right.withColumns(dict(zip(keys, of_right)))
        found = l.join(r, keys).drop(*keys).withColumn("tier", F.lit(number))
        result = found if result is None else result.unionByName(found)
        if number < len(tiers):
            rest = l.join(r.select(*keys).distinct(), keys, "left_anti").drop(*keys)
    return result


def unmatched(left: DataFrame, matched: DataFrame, left_id: str) -> DataFrame:
    """The rows of `left` whose id has no match: the supplement."""
    return left.join(matched.select(left_id).distinct(), left_id, "left_anti")


def ordered_union(df: DataFrame, keys: list[str], values: str, order: str, name: str) -> DataFrame:
    """For each key the distinct elements of its arrays in the order they first appear."""
    gathered = F.transform(F.array_sort(F.collect_list(F.struct(order, values))), lambda x: x[values])
    return df.groupBy(*keys).agg(F.array_distinct(F.flatten(gathered)).alias(name))


def first_match(left: DataFrame, right: DataFrame, on: str, order: str, columns: list[str]) -> DataFrame:
    """`left` with the columns of the first row of `right` in order, or nulls."""
    firsts = right.groupBy(on).agg(F.min_by(F.struct(*columns), order).alias("__f"))
    return left.join(firsts, on, "left").select(*left.columns, *(F.col(f"__f.{c}").alias(c) for c in columns))


def overridden(df: DataFrame, overrides: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """`df` with columns replaced by the values of `overrides`, where it has any."""
    fresh = overrides.select(*keys, *(F.col(c).alias(f"__{c}") for c in columns))
    joined = df.join(fresh, keys, "left")
    return joined.select(*(F.coalesce(f"__{c}", c).alias(c) if c in columns else F.col(c) for c in df.columns))


def stale(overrides: DataFrame, df: DataFrame, keys: list[str]) -> DataFrame:
    """Overrides whose key is in no row: a build stops on any."""
    return overrides.join(df, keys, "left_anti")


def value_mismatch(expected: DataFrame, actual: DataFrame, key: str, column: str) -> DataFrame:
    """Rows of both whose values differ; null expectations expect nothing."""
    a = actual.select(key, F.col(column).alias("actual"))
    return expected.select(key, F.col(column).alias("expected")).where("expected is not null").join(a, key).where(~F.col("expected").eqNullSafe(F.col("actual")))


def divided(df: DataFrame, key: str, item: str, wanted: DataFrame) -> DataFrame:
    """Keys that have every item of `wanted` (item): relational division, by counts of
    distinct items, so no key's items are gathered."""
    total = wanted.select(F.count_distinct(item).alias("__all"))
    held = df.join(wanted.select(item).distinct(), item, "left_semi").groupBy(key).agg(F.count_distinct(item).alias("__n"))
    return held.join(F.broadcast(total), F.col("__n") == F.col("__all")).select(key)


def accepted(received: DataFrame, requested: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """What was requested, and of repeated answers the first."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return received.join(requested.select(*keys).distinct(), keys, "left_semi").withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def verdict(count: Column) -> Column:
    """How far an external source confirms a row: full, headword, or none."""
    return F.when(count.isNull(), "none").when(count > 0, "full").otherwise("headword")


def append_missing(have: Column, add: Column) -> Column:
    """`have` with the elements of `add` that it lacks, in their order."""
    have = F.coalesce(have, F.array().cast("array<string>"))
    return F.concat(have, F.array_except(add, have))


def collapse_equal(df: DataFrame, keys: list[str], same: list[str], order: str, elements: str, name: str) -> DataFrame:
    """Rows that agree in `same` become one, at the place of the first (`place`); what
    later ones add to `elements` is appended to what the first has."""
    gathered = F.transform(F.array_sort(F.collect_list(F.struct(order, elements))), lambda x: x[elements])
    joined = F.aggregate(F.slice(gathered, 2, F.greatest(F.size(gathered) - 1, F.lit(0))), F.element_at(gathered, 1), append_missing)
    return df.groupBy(*keys, *same).agg(F.min(order).alias("place"), F.count("*").alias("merged"), joined.alias(name))


def examples(df: DataFrame, label: str, value: str, most: int = 3) -> DataFrame:
    """(label, n, examples): the count of each label and its least values, joined."""
    rank = F.row_number().over(Window.partitionBy(label).orderBy(value))
    few = df.select(label, value).withColumn("__rank", rank).where(F.col("__rank") <= most)
    few = few.groupBy(label).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__rank", F.col(value).cast("string").alias("v")))), lambda x: x["v"]), ",").alias("examples"))
    return df.groupBy(label).agg(F.count("*").alias("n")).join(few, label)
