"""Where the engine keeps what it has to write between steps."""

from __future__ import annotations

import atexit
import contextlib
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share; a temporary one is
    set only where the session has none and runs on this machine alone, as in tests."""
    context = spark.sparkContext._jsc.sc()
    if not context.getCheckpointDir().isDefined():
        folder = spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return context.getCheckpointDir().get()


#: Folders that are still there, with their sessions; they go when the driver ends.
_written: dict[str, SparkSession] = {}


def working_folder(spark: SparkSession, kind: str) -> str:
    """A new name in the shared folder, deleted when the driver ends."""
    path = f"{shared_dir(spark)}/{kind}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(_delete_all)
    _written[path] = spark
    return path


def materialise(df: DataFrame) -> DataFrame:
    """Writes `df` to the shared folder and reads it back, which cuts its lineage."""
    path = working_folder(df.sparkSession, "m")
    df.write.parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    found._written_to = path
    return found


def discard(*frames: DataFrame) -> None:
    """Deletes what materialise() wrote for frames that nothing reads any more."""
    for df in frames:
        if (path := getattr(df, "_written_to", None)) in _written:
            _delete(path)


def discard_folder(path: str) -> None:
    """Deletes a folder of working_folder() that nothing reads any more."""
    if path in _written:
        _delete(path)


def same_files(view: DataFrame, written: DataFrame) -> DataFrame:
    """`view`, as a frame over the files of `written`, so that discard() deletes them."""
    view._written_to = written._written_to
    return view


def _delete(path: str) -> None:
    spark = _written.pop(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _delete_all() -> None:
    with contextlib.suppress(Exception):  # the session may have ended
        for path in list(_written):
            _delete(path)
