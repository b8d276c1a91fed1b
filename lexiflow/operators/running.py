"""Running sums and last values over groups of any size.

A window by group puts a group into one task. Here rows are sorted in range partitions by group
and order, so a hot group is cut into many, and read in blocks of a bounded number of rows. Within
a block running values are found in one pass. Only the block's first group may have begun
before it: one row a block tells what it leaves behind, these rows are read in order, and
what each block's first group begins with is joined to its rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from lexiflow.operators import chunking
from lexiflow.operators.chunking import blocks
from lexiflow.session import materialise, same_files


def local_values(starts: np.ndarray, values: pa.Array, last: bool) -> pa.Array:
    """The running sum or last known value of each row, whose group begins at `starts`."""
    if last:
        known = np.where(values.is_valid().to_numpy(zero_copy_only=False), np.arange(len(values)), -1)
        at = np.maximum.accumulate(known)
        return values.take(pa.array(at, mask=at < starts))
    sums = np.concatenate([[0], np.cumsum(pc.fill_null(values, 0).to_numpy())])
    return pa.array(sums[1:] - sums[starts], values.type)


def carried(parts: Iterator[dict], last: bool) -> Iterator[tuple]:
    """(block, what its first group begins with) in order."""
    key, carry = None, None
    for m in parts:
        begun = carry if m["first"] == key else None
        yield m["part"], begun
        carry, key = m["tail"], m["last"]
        if m["whole"] and begun is not None:
            carry = (begun if carry is None else carry) if last else begun + carry


def running(df: DataFrame, group: list[str], order: list[Column | str], value: str, name: str, last: bool = False) -> DataFrame:
    """Adds `name`: the sum (of whole numbers, null as 0) of `value` over the rows of the group
    up to this one, or with `last` its last value that is not null. `order` is total in a group."""
    kind = df.schema[value].dataType.simpleString() if last else "bigint"
    key = F.to_json(F.struct(*group)) if group else F.lit("")
    placed = df.withColumn("__key", key).withColumn("__value", F.col(value).cast(kind)).repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    extra = f"__part bigint, __open boolean, __local {kind}, __map struct<first: string, last: string, whole: boolean, tail: {kind}>"
    schema = StructType([*df.schema.fields, *_parse_datatype_string(extra).fields])
    arrow, width, size = to_arrow_schema(schema), len(df.columns), chunking.BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in blocks(batches, size):
            keys, values = held.column("__key").combine_chunks(), held.column("__value").combine_chunks()
            borders = np.flatnonzero(pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)) + 1
            cuts = np.concatenate([[0], borders, [len(keys)]])
            local = local_values(np.repeat(cuts[:-1], np.diff(cuts)), values, last)
            summary = {"first": keys[0].as_py(), "last": keys[-1].as_py(), "whole": len(borders) == 0, "tail": local[-1].as_py()}
            at = 0
            for batch in held.to_batches():
                to = at + batch.num_rows
                own = [batch.column(f.name).cast(f.type) for f in list(arrow)[:width]]
                maps = pa.array([summary if at == 0 else None] + [None] * (to - at - 1), arrow.field("__map").type)
                yield pa.RecordBatch.from_arrays([*own, pa.array(np.full(to - at, part, np.int64)), pa.array(np.arange(at, to) < cuts[1]), local.slice(at, to - at), maps], schema=arrow)
                at = to

    rows = materialise(placed.mapInArrow(run, schema))
    maps = rows.where("__map is not null").select(F.col("__part").alias("part"), "__map.*")

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = lambda v: None if v is None or v is pd.NA or v != v else v
        found = carried((m | {"tail": known(m["tail"])} for pdf in parts for m in pdf.astype(object).to_dict("records")), last)
        while some := list(islice(found, 1000)):
            yield pd.DataFrame({"__part": [p for p, _ in some], "__begun": pd.Series([v for _, v in some], dtype=object)})

    begun = maps.repartition(1).sortWithinPartitions("part").mapInPandas(fold, f"__part bigint, __begun {kind}")  # a row a block
    met = rows.join(F.broadcast(begun), "__part")
    start = F.when(F.col("__open"), F.col("__begun"))
    whole = F.coalesce("__local", start) if last else F.col("__local") + F.coalesce(start, F.lit(0))
    return same_files(met.select(*df.columns, whole.alias(name)), rows)


def token_budget(df: DataFrame, group: list[str], order: list[str], cost: str, budget: float) -> DataFrame:
    """Rows that still start within the budget: what came before them is below it."""
    summed = running(df, group, order, cost, "__through")
    spent = F.col("__through") - F.coalesce(F.col(cost).cast("bigint"), F.lit(0))
    return same_files(summed.withColumn("spent_before", spent).where(F.col("spent_before") < budget).drop("__through"), summed)


def as_of(lookups: DataFrame, samples: DataFrame, group: list[str], at: str, value: str, ties: list[str], name: str) -> DataFrame:
    """`lookups` with `name`: the value of the newest sample of the group that is not after
    their `at`; of samples at one time the last in the order of `ties`. Lookups and samples
    are merged in one order, so neither side's hot group is one task's."""
    known = samples.where(F.col(value).isNotNull() & F.col(at).isNotNull()).select(*group, F.col(at).alias("__at"), F.lit(0).alias("__kind"), F.struct(*ties).alias("__tie"), F.col(value).alias("__sample"))
    asked = lookups.select(*group, F.col(at).alias("__at"), F.lit(1).alias("__kind"), F.struct("*").alias("__row")).withColumn("__at", F.col("__at"))
    both = known.unionByName(asked, allowMissingColumns=True)
    found = running(both, group, ["__at", "__kind", "__tie", F.hash("__row")], "__sample", "__found", last=True)
    return same_files(found.where("__kind = 1").select("__row.*", F.col("__found").alias(name)), found)


def stalled(df: DataFrame, group: list[str], time: str, value: str, seconds: int, ties: list[str]) -> DataFrame:
    """Adds `stalled`: whether the value has not grown since the newest sample of the group
    that is at least so many seconds old (`time` in seconds); without one it is not."""
    lookups = df.withColumn("__time", F.col(time)).withColumn(time, F.col(time) - seconds)
    earlier = as_of(lookups, df, group, time, value, ties, "__old")
    found = earlier.withColumn(time, F.col("__time")).withColumn("stalled", F.coalesce(F.col(value) <= F.col("__old"), F.lit(False)))
    return same_files(found.drop("__old", "__time"), earlier)
