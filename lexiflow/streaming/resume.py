"""Streams that continue where they stopped: appended logs, first answers win."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def follow_log(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """A stream of the JSON lines of files that appear in a folder, with the file's name;
    lines that are broken have null in every field."""
    return spark.readStream.schema(schema).option("mode", "PERMISSIVE").json(folder).withColumn("source", F.input_file_name())


def append_once(
    stream: DataFrame, keys: list[str], order: list[str], target: str, checkpoint: str, at: str | None = None, period: str = "1 day", late: str = "1 hour"
) -> StreamingQuery:
    """Appends to a Parquet table the rows of keys it does not hold yet, of several in a batch
    the first in order (nulls first); rows without a key are left out.

    The state is the aggregate of each key: its first row and the time of the batch that
    brought it. A batch updates the keys it holds, combined in each task before they are
    sent, and those whose batch is this one are new. With `at`, a time, keys are first in
    each period of it, rows without a time are left out, and a period is forgotten once it
    ended `late` before the newest time seen; rows of forgotten periods are dropped.

    A batch is written to a folder of its own, so one that is repeated counts once. Takes
    the times of batches from the driver's clock, which must not be put back between them.
    Processes what is there and ends; run again, it goes on after the last complete batch."""
    rows, group = stream.dropna(subset=keys), [F.col(k) for k in keys]
    if at is not None:
        rows, group = rows.withWatermark(at, late), [*group, F.window(at, period).alias("__period")]
    place = F.struct("__batch", *order)
    seen = rows.withColumn("__batch", F.current_timestamp()).groupBy(*group).agg(F.min_by(F.struct(*stream.columns), place).alias("__row"), F.min("__batch").alias("__since"))

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    fresh = seen.where(F.col("__since") == F.current_timestamp()).select("__row.*")
    return fresh.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def held(spark: SparkSession, target: str) -> DataFrame:
    """What append_once() has written."""
    return spark.read.option("recursiveFileLookup", "true").parquet(target)


def run_available(start: Callable[[], StreamingQuery]) -> None:
    """Runs a query over all that is there and waits for its end."""
    start().awaitTermination()
