"""Values that recur, stored once: dictionaries of shared values, and rows that carry their ids.

A value is sent once for each task that holds it, to be counted; rows then look up its id by
its digest. Ids that many rows carry would make one task of a join long: those that at least
one in HOT rows carries are looked up in a table of at most HOT rows a kind, and their rows
are dealt to all tasks by the join of the others, in which they meet nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.operators.ordering import global_ordinal
from lexiflow.session import materialise

#: A value is looked up in a broadcast table if at least one in so many values is equal to it;
#: a longer one than LONGEST bytes never is, so such a table has a bounded size.
HOT, LONGEST = 1000, 4096


def digest(value: Column) -> Column:
    return F.sha2(value, 256)


def shared_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """(id, kind, value, n): the distinct values of text columns, each column a kind of its
    own, with the number of rows that hold them; ids count from 1 by kind and value. Nulls
    are no values, and empty texts are. Written; equal values of two kinds are two."""
    each = df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in columns))).alias("v")).select("v.*")
    counted = each.where("value is not null").groupBy("kind", digest(F.col("value")).alias("digest")).agg(F.any_value("value").alias("value"), F.count("*").alias("n"))
    return materialise(global_ordinal(counted, "kind", "value", name="id").select("id", "kind", "value", "n"))


def looked_up(df: DataFrame, column: str, table: DataFrame, found: str) -> DataFrame:
    """`df` with `found`, what `table` (key, found, n, bytes) has for the key in `column`, or
    null. Keys that many rows carry are met in a broadcast table, whose rows are bounded in
    number and size, the others by a join, to which the rows of the first come dealt."""
    total = table.agg(F.sum("n")).first()[0] or 0
    is_hot = (F.col("n") * HOT >= total) & (F.col("bytes") <= LONGEST)
    hot = F.broadcast(table.where(is_hot).select(F.col("key").alias("__hot"), F.struct(found).alias("__of_hot")))
    cold = table.where(~is_hot).select(F.col("key").alias("__cold"), F.struct(found).alias("__of_cold"))
    met = df.join(hot, F.col(column) == F.col("__hot"), "left")
    apart = F.col("__of_hot").isNotNull() | F.col(column).isNull()
    dealt = met.withColumn("__dealt", F.monotonically_increasing_id() % 65536)
    dealt = dealt.withColumn("__key", F.when(apart, F.concat(F.lit("#"), "__dealt")).otherwise(F.col(column).cast("string")))
    joined = dealt.join(cold.withColumn("__key", F.col("__cold").cast("string")), "__key", "left")
    return joined.select(*(df[c] for c in df.columns), F.coalesce("__of_hot", "__of_cold")[found].alias(found))


def with_ids(df: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with the id of its value in place of each of the columns; null stays null."""
    for c in columns:
        table = values.where(F.col("kind") == c).select(digest(F.col("value")).alias("key"), F.col("id").alias("__id"), "n", F.lit(64).alias("bytes"))
        keyed = df.withColumn("__digest", digest(F.col(c)))
        df = looked_up(keyed, "__digest", table, "__id").select(*(F.col("__id").alias(c) if name == c else F.col(name) for name in df.columns))
    return df


def resolved(df: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with {kind, value} of its id in place of each of the columns: null stands where an
    id is null or not known."""
    for c in columns:
        table = values.select(F.col("id").alias("key"), F.struct("kind", "value").alias("__v"), "n", F.octet_length("value").alias("bytes"))
        df = looked_up(df.withColumnRenamed(c, "__key_of"), "__key_of", table, "__v").withColumn(c, F.struct(F.col("__key_of").alias("id"), "__v.kind", "__v.value")).drop("__key_of", "__v")
    return df


def faults(df: DataFrame, values: DataFrame, columns: list[str], key: str) -> DataFrame:
    """(key, kind, id, fault): ids that stand for nothing (`unknown`) or for a value of
    another kind than their column's (`kind`)."""
    met = resolved(df, values, columns)
    told = [F.struct(F.lit(c).alias("kind"), F.col(f"{c}.id").alias("id"), F.when(F.col(f"{c}.kind").isNull(), "unknown").when(F.col(f"{c}.kind") != c, "kind").alias("fault")) for c in columns]
    return met.select(key, F.explode(F.array(*told)).alias("f")).select(key, "f.*").where("id is not null and fault is not null")


def with_values(df: DataFrame, values: DataFrame, columns: list[str]) -> DataFrame:
    """`df` with the values in place of ids; an id without a value of the column's kind ends
    the job."""
    met = resolved(df, values, columns)

    def own(c: str) -> Column:
        wrong = F.col(f"{c}.id").isNotNull() & ~F.col(f"{c}.kind").eqNullSafe(F.lit(c))
        said = F.concat(F.lit(f"no shared {c} under id "), F.col(f"{c}.id").cast("string"))
        return F.when(wrong, F.raise_error(said)).otherwise(F.col(f"{c}.value")).alias(c)

    return met.select(*(own(c) if c in columns else F.col(c) for c in df.columns))
