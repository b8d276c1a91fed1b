"""Greedy chunks within a budget, over groups of any size and many tasks.

A chunk takes rows in order until another one would exceed the budget or the row limit; a
row over the budget stands alone. Where a chunk ends depends on where it began, so this
looks like work for one task a group. But of a sorted partition only the first start
depends on what came before: from a start s the next one, next(s), is known from sums of
costs alone, by binary search. A row has two numbers:

* n(i), how many chunks have begun up to the row i if the first one begins at the partition's
  first row;
* t(i), the last first start with which as many have begun. As next() never decreases, for any
  first start p within the first chunk it is n(i), or n(i) - 1 where p is after t(i). With g(i)
  the last s with next(s) <= i, t(i) = t(g(i)), and t(i) = i in the first chunk; so
  doubling of pointers finds all of them at once.

A partition is read in blocks of BLOCK rows, and what is said here of partitions holds of blocks: a
task holds one of them, however many rows there are.

Of a partition whose rows continue a group to its end, the map from its first start to what is
open at its end has an entry for each row that fits into one chunk. One row a
partition with such a map is read in order, and what results (a number and a first start) is
joined to the rows. So rows are sent once, and no task holds more than a range of them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from lexiflow.session import materialise, same_files

#: Rows that a task holds at once; blocks of a partition are numbered in the low bits of theirs.
BLOCK, BLOCK_BITS = 250_000, 24
#: What each row gets: its block, whether its chunk's number depends on the first start,
#: n and t; a block's first row also gets the block's map.
ROW = "__part bigint, __open boolean, __n bigint, __t bigint"
MAP = "__map struct<first: string, last: string, whole: boolean, fits: array<double>, held: array<double>, rows: array<bigint>, chunks: array<bigint>>"


def blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, pa.Table]]:
    """(number, rows) of a task's rows in order, each of about `size` rows; numbers grow over
    the tasks of a sorted table."""
    number, held, count = TaskContext.get().partitionId() << BLOCK_BITS, [], 0
    for batch in (b for b in batches if b.num_rows):
        held.append(batch)
        count += batch.num_rows
        if count >= size:
            yield number, pa.Table.from_batches(held)
            number, held, count = number + 1, [], 0
    if held:
        yield number, pa.Table.from_batches(held)


def follow(pointers: np.ndarray) -> np.ndarray:
    """Where each chain of pointers ends, by doubling; ends point to themselves."""
    while True:
        further = pointers[pointers]
        if np.array_equal(further, pointers):
            return pointers
        pointers = further


def next_starts(sums: np.ndarray, ends: np.ndarray, budget: float, most_rows: int) -> np.ndarray:
    """next(s) of each row s: sums has the costs before each row and all of them, ends the
    end of each row's group."""
    rows = np.arange(len(ends))
    by_cost = np.searchsorted(sums, sums[:-1] + budget, side="right") - 1  # so many rows stay within the budget
    return np.minimum(np.maximum(np.minimum(by_cost, rows + most_rows), rows + 1), ends)


@dataclass
class Partition:
    """n and t of each row of a sorted partition, and its map."""

    n: np.ndarray
    t: np.ndarray
    head: int
    map: dict


def solve(keys: np.ndarray, costs: np.ndarray, budget: float, most_rows: int) -> Partition:
    """`keys` are codes of the rows' groups, equal ones together."""
    count = len(keys)
    sums = np.concatenate([[0.0], np.cumsum(costs)])
    borders = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    starts = np.concatenate([[0], borders])
    ends = np.repeat(np.concatenate([borders, [count]]), np.diff(np.concatenate([starts, [count]])))
    following = next_starts(sums, ends, budget, most_rows)
    begins = np.zeros(count, bool)  # chunks of the chains from each group's first row
    for start in starts.tolist():
        at, end = start, int(ends[start])
        while at < end:
            begins[at] = True
            at = int(following[at])
    total = np.cumsum(begins)
    n = total - np.repeat(total[starts] - 1, np.diff(np.concatenate([starts, [count]])))
    head = int(ends[0])
    own = following[:head]
    t = np.full(count, count)
    parents = np.where(n[:head] == 1, np.arange(head), np.searchsorted(own, np.arange(head), side="right") - 1)
    t[:head] = follow(parents)
    whole = head == count
    first = np.arange(int(following[0]) + 1)  # first starts; the head's end stands for none
    if whole:  # what is open at the end, for each first start
        last = follow(np.where(own >= count, np.arange(count), np.minimum(own, count - 1)))[first[first < count]]
        none = first[first == count]
        held = np.concatenate([sums[count] - sums[last], sums[none]])
        rows = np.concatenate([count - last, none])
        chunks = np.concatenate([n[-1] - (first[first < count] > t[-1]), 0 * none])
    else:  # the last group begins here, so only what it leaves open counts
        at = int(np.flatnonzero(begins)[-1])
        held, rows, chunks = np.array([sums[count] - sums[at]]), np.array([count - at]), n[-1:]
    return Partition(n, t, head, {"whole": whole, "fits": sums[first].tolist(), "held": held.tolist(), "rows": rows.tolist(), "chunks": chunks.tolist()})


def compose(maps: Iterator[dict], budget: float, most_rows: int) -> Iterator[tuple[int, int, int]]:
    """(partition, number of the chunk that is open before it, its first start) in order; the
    number is -1 and the start 0 where the partition's first row begins a group."""
    key, held, rows, chunk = None, 0.0, 0, -1
    for m in maps:
        first = 0
        if m["first"] == key:
            fits = int(np.searchsorted(m["fits"], budget - held, side="right")) - 1
            first = max(0, min(fits, most_rows - rows))
        else:
            held, rows, chunk = 0.0, 0, -1
        yield m["part"], chunk, first
        key = m["last"]
        if not m["whole"]:
            held, rows, chunk = m["held"][0], m["rows"][0], m["chunks"][0] - 1
        elif m["chunks"][first]:
            held, rows, chunk = m["held"][first], m["rows"][first], chunk + m["chunks"][first]
        else:
            held, rows = held + m["held"][first], rows + m["rows"][first]


def budget_chunks(df: DataFrame, group: list[str], order: list[str], cost: str, budget: float, most_rows: int) -> DataFrame:
    """Adds `chunk`, from 0 in each group: a chunk is closed when another row would exceed
    the budget or the row limit; a row over the budget stands alone. `order` is total within a
    group. Costs are whole numbers of any type and not below 0, as which null counts."""
    key = F.to_json(F.struct(*group)) if group else F.lit("")
    placed = df.withColumn("__key", key).withColumn("__cost", F.coalesce(F.col(cost).cast("double"), F.lit(0.0)))
    placed = placed.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    schema = StructType([*df.schema.fields, *_parse_datatype_string(f"{ROW}, {MAP}").fields])
    arrow, width, size = to_arrow_schema(schema), len(df.columns), BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, held in blocks(batches, size):
            keys = held.column("__key").combine_chunks()
            changes = pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False)
            found = solve(np.concatenate([[0], np.cumsum(changes)]), held.column("__cost").to_numpy(), budget, most_rows)
            summary = {"first": keys[0].as_py(), "last": keys[-1].as_py(), **found.map}
            at = 0
            for batch in held.to_batches():
                to = at + batch.num_rows
                own = [batch.column(f.name).cast(f.type) for f in list(arrow)[:width]]
                maps = pa.array([summary if at == 0 else None] + [None] * (batch.num_rows - 1), arrow.field("__map").type)
                rows = (np.full(to - at, part, np.int64), np.arange(at, to) < found.head, found.n[at:to], found.t[at:to])
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, rows), maps], schema=arrow)
                at = to

    rows = materialise(placed.mapInArrow(run, schema))
    maps = rows.where("__map is not null").select(F.col("__part").alias("part"), "__map.*")

    def fold(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = compose((m for pdf in parts for m in pdf.to_dict("records")), budget, most_rows)
        while some := list(islice(found, 1000)):
            yield pd.DataFrame(some, columns=["__part", "__before", "__first"])

    starts = maps.repartition(1).sortWithinPartitions("part").mapInPandas(fold, "__part bigint, __before bigint, __first bigint")  # a row a block
    met = rows.join(F.broadcast(starts), "__part")
    open_ = F.col("__before") + F.col("__n") - (F.col("__first") > F.col("__t")).cast("bigint")
    chunk = F.when(F.col("__open"), open_).otherwise(F.col("__n") - 1).cast("int")
    return same_files(met.select(*df.columns, chunk.alias("chunk")), rows)
