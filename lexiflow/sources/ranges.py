"""Files read as byte ranges, and places in them.

Spark cuts files into ranges of `spark.sql.files.maxPartitionBytes`; its text reader gives
each record to the range in which it begins, whatever lies across the border. Records keep
their range and a number that grows within it, so a place in a file takes one small table
with a row a range: how many records (or bytes) the ranges before it hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE = ("file", "range")


def records(spark: SparkSession, path: str | list[str], separator: str = "\n", longest: int | None = None) -> DataFrame:
    """(value, file, range, at, file_size): what stands between separators, byte for byte
    but for a byte-order mark at the start; (file, range, at) is the order. Files of one path
    come by name, packed ones (gzip by the suffix) as one range. Records of `longest` bytes
    or more, their separator among them, are left out unread."""
    reader = spark.read if longest is None else spark.read.option("mapreduce.input.linerecordreader.line.maxlength", longest)
    read = reader.text(path, lineSep=separator)
    at = {"file": "_metadata.file_path", "range": "_metadata.file_block_start", "file_size": "_metadata.file_size"}
    return with_at(read.select("value", *(F.col(c).alias(n) for n, c in at.items())))


def with_at(rows: DataFrame) -> DataFrame:
    """Numbers anew, in the order of the rows in their tasks."""
    return rows.withColumn("at", F.monotonically_increasing_id())


def before(ranges: DataFrame, *sums: str) -> DataFrame:
    """`ranges` (a row each) with sums over all ranges before, as <name>_before."""
    earlier = Window.orderBy(*RANGE).rowsBetween(Window.unboundedPreceding, -1)
    return ranges.withColumns({f"{c}_before": F.coalesce(F.sum(c).over(earlier), F.lit(0)).cast("bigint") for c in sums})


def numbered(rows: DataFrame, name: str = "ord", by_file: bool = False) -> DataFrame:
    """Adds each row's place from 1, in all files or in its own, for rows with a range and
    numbers without gaps. The rows are counted by one pass and numbered by another."""
    ranges = rows.groupBy(*RANGE).agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("file").orderBy("range") if by_file else Window.orderBy(*RANGE)
    start = F.coalesce(F.sum("n").over(earlier.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = ranges.select(*RANGE, (F.col("first") - start).alias("__first"))
    return rows.join(F.broadcast(starts), list(RANGE)).withColumn(name, F.col("at") - F.col("__first") + 1).drop("__first")  # a row a range


def place_in_files() -> Column:
    """What rows with a range are ordered by."""
    return F.struct(*RANGE, "at")
