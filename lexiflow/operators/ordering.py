"""Ordinals, samples, shards and orders of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiflow.session import materialise

#: monotonically_increasing_id() has the row's place in its partition in these bits.
PLACE_BITS = 33


def global_ordinal(df: DataFrame, *order: Column | str, name: str = "ordinal") -> DataFrame:
    """Adds each row's place, from 1, in a total order. Rows are range-partitioned and
    sorted where they are; only one count for each partition meets in one task."""
    placed = materialise(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", PLACE_BITS)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("__n"))
    starts = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    within = F.col("__at").bitwiseAND(F.lit((1 << PLACE_BITS) - 1).cast("bigint")) + 1
    return placed.withColumn("__part", part).join(F.broadcast(starts), "__part").withColumn(name, within + F.col("__start")).drop("__at", "__part", "__start")


def repeats_with_first(df: DataFrame, keys: list[str], order: str, first: str = "first_line") -> DataFrame:
    """Rows that repeat a key, with the `order` value of the key's first row."""
    window = Window.partitionBy(*keys)
    ranked = df.withColumn("__rank", F.row_number().over(window.orderBy(order))).withColumn(first, F.min(order).over(window))
    return ranked.where("__rank > 1").drop("__rank")


def last_value_per_key(df: DataFrame, keys: list[str], columns: list[str], order: Column | str, only_known: bool = True) -> DataFrame:
    """For each key and column the last value (by default the last that is not null)."""
    order = F.col(order) if isinstance(order, str) else order
    at = lambda c: F.when(F.col(c).isNotNull(), order) if only_known else order
    return df.groupBy(*keys).agg(*(F.max_by(c, at(c)).alias(c) for c in columns))


def fixed_batches(df: DataFrame, size: int, *order: Column | str) -> DataFrame:
    """Adds `batch`, from 0: every `size` rows in order."""
    return global_ordinal(df, *order).withColumn("batch", F.floor((F.col("ordinal") - 1) / size))


def modulo_shard(df: DataFrame, total: int, *order: Column | str) -> DataFrame:
    """Adds `shard`, from 0: rows are dealt in turn."""
    return global_ordinal(df, *order).withColumn("shard", (F.col("ordinal") - 1) % total)


def parse_shard(spec: Column) -> tuple[Column, Column]:
    """(index, total) of a specification such as 2/8; indexes count from 0."""
    return F.split_part(spec, F.lit("/"), F.lit(1)).try_cast("int"), F.split_part(spec, F.lit("/"), F.lit(2)).try_cast("int")


def even_sample(df: DataFrame, count: int, *order: Column | str, ordinal: str | None = None) -> DataFrame:
    """`count` rows spread evenly over the order, both ends among them (all rows, if
    there are no more); halves round to even."""
    placed = df.withColumnRenamed(ordinal, "ordinal") if ordinal else global_ordinal(df, *order)
    total = placed.agg(F.max("ordinal")).first()[0] or 0
    if total <= count:
        return placed
    if count <= 1:
        return placed.where(F.col("ordinal") <= count)
    step = (total - 1) / (count - 1)
    wanted = df.sparkSession.range(count).select((F.bround(F.col("id") * F.lit(step)).cast("bigint") + 1).alias("ordinal")).distinct()
    return placed.join(wanted, "ordinal", "left_semi")


def pilot_plan(df: DataFrame, total: int, head: int, *order: Column | str) -> DataFrame:
    """The first `head` rows and an even sample of the rest, `total` rows in all."""
    placed = global_ordinal(df, *order)
    tail = placed.where(F.col("ordinal") > head).withColumn("ordinal", F.col("ordinal") - head)
    sampled = even_sample(tail, max(0, total - head), ordinal="ordinal").withColumn("ordinal", F.col("ordinal") + head)
    return placed.where(F.col("ordinal") <= min(head, total)).withColumn("part", F.lit("head")).unionByName(sampled.withColumn("part", F.lit("sample")))


def ranked_first(df: DataFrame, ranks: DataFrame, key: str, then: str) -> DataFrame:
    """Adds `position`: rows that `ranks` (key, rank) names by rank, then the others in
    their own order."""
    joined = df.join(ranks, key, "left").withColumn("__unranked", F.col("rank").isNull())
    return global_ordinal(joined, "__unranked", "rank", then, name="position").drop("__unranked")


def progress(done: Column, total: Column, seconds: Column) -> dict[str, Column]:
    """Percent done, rate a minute, and minutes left (null without progress)."""
    rate = F.when((seconds > 0) & (done > 0), done * 60.0 / seconds)
    return {"percent": F.when(total > 0, 100.0 * done / total).otherwise(0.0), "per_minute": F.coalesce(rate, F.lit(0.0)), "minutes_left": (total - done) / rate}


def natural_id_order(column: str) -> list[Column]:
    """Sort keys of ids such as c10: the letter, the number, the id itself."""
    c = F.col(column)
    return [F.substring(c, 1, 1), F.substring(c, 2, 20).try_cast("bigint"), c]


def generation_order(has_level: Column, frequency: Column, key: str) -> list[Column]:
    """Rows with a level first, then the frequent ones, then by id as text."""
    return [F.when(has_level, 0).otherwise(1), F.coalesce(frequency, F.lit(0)).desc(), F.col(key)]
