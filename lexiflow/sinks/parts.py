"""Ordered dumps in parts: written, digested and checked by many tasks, published whole or not.

A dump is a folder with generations. A generation holds text files whose contents, in the
order of their names, are the lines in order, and a manifest with a row for each of them. The
file `current` names the generation that counts; it is replaced in one step, after what was
written has been counted and checked, so readers see the dump of before or the new one. It
takes any file system that Spark writes to and that can replace a file.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.sinks.artifacts import PublishError
from lexiflow.sources.scans import text_lines

MANIFEST = "part string, lines bigint, bytes bigint, sha256 string"
#: A part holds about so many bytes; names of parts have five digits, so there are no more.
PART_BYTES, MOST_PARTS = 32 << 20, 90_000


def file_name(path: str) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def found_parts(spark: SparkSession, generation: str) -> DataFrame:
    """(part, lines, bytes, sha256) of the files that are there; a task digests a part at a time."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{generation}/lines")
    digested = files.select(file_name("path").alias("part"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
    lines = spark.read.option("pathGlobFilter", "part-*").text(f"{generation}/lines", lineSep="\n")
    counted = lines.groupBy(file_name("_metadata.file_path").alias("part")).agg(F.count("*").alias("lines"))
    return digested.join(counted, "part", "left").select("part", F.coalesce("lines", F.lit(0)).alias("lines"), "bytes", "sha256")


def manifest(spark: SparkSession, generation: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{generation}/manifest")


def current(spark: SparkSession, target: str) -> str:
    """The generation that counts."""
    return f"{target}/{spark.read.text(f'{target}/current').first()[0]}"


def lines_of(spark: SparkSession, target: str) -> DataFrame:
    """(ord, value): the lines of a dump, numbered from 1, read by byte ranges."""
    return text_lines(spark, f"{current(spark, target)}/lines")


def digest_of(parts: DataFrame) -> str:
    """The SHA-256 of the digests of a manifest's parts in order (64 bytes a part)."""
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("part", "sha256"))), lambda p: p["sha256"])
    return parts.agg(F.sha2(F.array_join(ordered, ""), 256)).first()[0]


def publish(lines: DataFrame, target: str, part_bytes: int = PART_BYTES, check: Callable[[str], None] | None = None) -> str:
    """Writes `lines` (ord, value) as a new generation and lets it count; returns its folder.
    Stops, with the dump as it was, if a line is null or would be two, if what was written is
    not what was given in lines and bytes, or if `check` of the folder raises. Of a run that
    stops a generation without effect can stay; prune() deletes such."""
    spark = lines.sparkSession
    given = lines.agg(F.count("*").alias("lines"), F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0)).alias("bytes"), F.count_if(F.col("value").isNull() | F.contains("value", F.lit("\n"))).alias("torn")).first()
    if given.torn:
        raise PublishError(f"{given.torn} rows are no single lines")
    name = uuid.uuid4().hex
    place = f"{target}/{name}"
    parts = min(MOST_PARTS, -(-given.bytes // part_bytes) or 1)
    lines.repartitionByRange(parts, "ord").sortWithinPartitions("ord").select("value").write.text(f"{place}/lines", lineSep="\n")
    found_parts(spark, place).write.parquet(f"{place}/manifest")
    written = manifest(spark, place).agg(F.coalesce(F.sum("lines"), F.lit(0)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    if tuple(written) != (given.lines, given.bytes):
        raise PublishError(f"{tuple(written)} lines and bytes were written of {(given.lines, given.bytes)}")
    if check is not None:
        check(place)
    point(spark, target, name)
    return place


def point(spark: SparkSession, target: str, name: str) -> None:
    """Lets a generation count, by a file that is written beside `current` and replaces it."""
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    fresh, path = hadoop.Path(f"{target}/.current-{name}"), hadoop.Path(f"{target}/current")
    out = path.getFileSystem(conf).create(fresh, False)
    out.write(bytearray(name.encode()))
    out.close()
    rename = getattr(hadoop, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    context = hadoop.FileContext.getFileContext(path.getFileSystem(conf).makeQualified(path).toUri(), conf)
    context.rename(path.getFileSystem(conf).makeQualified(fresh), path.getFileSystem(conf).makeQualified(path), how)


def faults(spark: SparkSession, target: str) -> DataFrame:
    """(part, fault): parts that are `missing`, `unlisted`, or not what the manifest says in
    `bytes`, `lines` or `sha256`, the first that differs."""
    place = current(spark, target)
    a, b = manifest(spark, place).alias("a"), found_parts(spark, place).alias("b")
    met = a.join(b, F.col("a.part") == F.col("b.part"), "full_outer")
    fault = F.when(F.col("b.part").isNull(), "missing").when(F.col("a.part").isNull(), "unlisted")
    for c in ("bytes", "lines", "sha256"):
        fault = fault.when(F.col(f"a.{c}") != F.col(f"b.{c}"), c)
    return met.select(F.coalesce("a.part", "b.part").alias("part"), fault.alias("fault")).where("fault is not null")


def prune(spark: SparkSession, target: str) -> int:
    """Deletes all generations but the current one, once nobody reads them; says how many."""
    keep, path = current(spark, target).rsplit("/", 1)[-1], spark._jvm.org.apache.hadoop.fs.Path(target)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [s.getPath() for s in files.listStatus(path) if s.isDirectory() and s.getPath().getName() != keep]
    for folder in old:
        files.delete(folder, True)
    return len(old)
