"""Raw-DEFLATE containers of JSON lines: written in segments by many tasks, read by many.

A container is one compressed stream without a header. Each task of a sorted table
compresses its own lines and ends them with a full flush, after which nothing refers to
what stood before; so its segments, one after another and followed by an empty last block,
are one valid stream, and each can be read alone. Segments are rows of a table (any store
that Spark writes to); joined to a single file they have an index beside it, with which
the file is read by as many tasks as it has segments. A stream without an index, made elsewhere,
is read by one task in chunks; `resegment` does that once and writes segments.
"""

from __future__ import annotations

import codecs
import json
import os
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import islice

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from lexiflow.session import working_folder

CHUNK = 1 << 20
LEVEL = 9
COMPRESSION = "deflate-raw"  # as manifests name it
LINES_AT_ONCE = 10_000
#: Expanded bytes of a segment, about; the empty last block of a stream of segments.
SEGMENT, END = 8 << 20, b"\x03\x00"
#: A segment: its task and place there, the lines and compressed bytes of the task before it, its own,
#: and the checksum of what it expands to.
SEGMENTS = "part int, seq int, lines_before bigint, bytes_before bigint, lines bigint, bytes bigint, expanded bigint, crc bigint, content binary"


@dataclass
class Sizes:
    compressed: int
    expanded: int


class ContainerError(ValueError):
    """A stream that is cut off, damaged, or followed by other bytes."""


def expanded(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """The content of a raw stream; stops if it does not end where the file does."""
    stream = zlib.decompressobj(-zlib.MAX_WBITS)
    try:
        for chunk in chunks:
            if stream.eof:
                raise ContainerError("bytes after the end of the stream")
            yield stream.decompress(chunk)
        yield stream.flush()
    except zlib.error as error:
        raise ContainerError(f"damaged stream: {error}") from error
    if not stream.eof:
        raise ContainerError("the stream is cut off")
    if stream.unused_data:
        raise ContainerError("bytes after the end of the stream")


def file_chunks(path: str, size: int = CHUNK) -> Iterator[bytes]:
    with open(path.removeprefix("file://"), "rb") as file:
        while chunk := file.read(size):
            yield chunk


def lines_of(chunks: Iterable[bytes]) -> Iterator[str]:
    """Lines, split at newlines only; characters may lie across chunks."""
    decoder, rest = codecs.getincrementaldecoder("utf-8")(), ""
    for chunk in expanded(chunks):
        *whole, rest = (rest + decoder.decode(chunk)).split("\n")
        yield from whole
    rest += decoder.decode(b"", True)
    if rest:
        yield rest


def write_container(path: str, lines: Iterable[str]) -> Sizes:
    """Writes lines, each with a newline, and returns the sizes. The file appears whole
    or not at all."""
    stream, partial, sizes = zlib.compressobj(LEVEL, zlib.DEFLATED, -zlib.MAX_WBITS), f"{path}.partial", Sizes(0, 0)
    try:
        with open(partial, "wb") as file:
            for line in lines:
                data = (line + "\n").encode()
                sizes.expanded += len(data)
                sizes.compressed += file.write(stream.compress(data))
            sizes.compressed += file.write(stream.flush())
        os.replace(partial, path)
    finally:
        if os.path.exists(partial):
            os.remove(partial)
    return sizes


def container_sizes(path: str) -> Sizes:
    total = Sizes(0, 0)

    def counted() -> Iterator[bytes]:
        for chunk in file_chunks(path):
            total.compressed += len(chunk)
            yield chunk

    for part in expanded(counted()):
        total.expanded += len(part)
    return total


def write_segments(df: DataFrame, place: str, order: str, value: str = "value", segment_bytes: int = SEGMENT) -> None:
    """Writes the rows' lines, in order, as a table of segments in the folder `place`."""
    schema = _parse_datatype_string(SEGMENTS)
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, lines, size = TaskContext.get().partitionId(), 0, 0, 0

        def closed(held: list[bytes]) -> pa.RecordBatch:
            nonlocal seq, lines, size
            stream, text = zlib.compressobj(LEVEL, zlib.DEFLATED, -zlib.MAX_WBITS), b"\n".join(held) + b"\n"
            content = stream.compress(text) + stream.flush(zlib.Z_FULL_FLUSH)
            row = (part, seq, lines, size, len(held), len(content), len(text), zlib.crc32(text), content)
            seq, lines, size = seq + 1, lines + len(held), size + len(content)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, arrow)], schema=arrow)

        held, total = [], 0
        for batch in batches:
            for line in batch.column(0).cast(pa.binary()).to_pylist():
                held.append(line)
                total += len(line) + 1
                if total >= segment_bytes:
                    yield closed(held)
                    held, total = [], 0
        if held:
            yield closed(held)

    df.repartitionByRange(order).sortWithinPartitions(order).select(F.coalesce(F.col(value), F.lit(""))).mapInArrow(run, schema).write.parquet(place)


def segments(spark: SparkSession, place: str) -> DataFrame:
    """The table of segments with `offset` in the joined stream and `first_line`, from 1."""
    read = spark.read.schema(SEGMENTS).parquet(place)
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = read.groupBy("part").agg(F.sum("lines").alias("l"), F.sum("bytes").alias("b"))
    starts = parts.select("part", *(F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__{c}") for c in ("l", "b")))
    return read.join(F.broadcast(starts), "part").withColumn("offset", F.col("__b") + F.col("bytes_before")).withColumn("first_line", F.col("__l") + F.col("lines_before") + 1).drop("__l", "__b")  # a row a task


def segment_sizes(spark: SparkSession, place: str) -> Sizes:
    """Of the stream that the segments make; nothing but their numbers is read."""
    row = spark.read.schema(SEGMENTS).parquet(place).agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("expanded"), F.lit(0))).first()
    return Sizes(row[0] + len(END), row[1])


def segment_lines(content: bytes, offset: int, first_line: int, lines: int, expanded_size: int, crc: int, permissive: bool) -> pa.RecordBatch:
    """(ord, value, error) of one segment; damage is a row with its place."""
    try:
        text = zlib.decompressobj(-zlib.MAX_WBITS).decompress(content)
        if len(text) != expanded_size or zlib.crc32(text) != crc:
            raise ContainerError("its content is another")
        values = pa.array(text.split(b"\n")[:-1], pa.binary()).cast(pa.string())
    except (zlib.error, ContainerError, pa.ArrowInvalid) as problem:
        error = f"damaged segment at byte {offset}, lines {first_line} to {first_line + lines - 1}: {problem}"
        if not permissive:
            raise ContainerError(error) from problem
        return line_batch([first_line], [None], [error])
    return line_batch(range(first_line, first_line + lines), values, [None] * lines)


def line_batch(numbers: Iterable[int], values: Iterable, errors: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), values if isinstance(values, pa.Array) else pa.array(values, pa.string()), pa.array(errors, pa.string())], names=["ord", "value", "error"])


def read_segments(spark: SparkSession, place: str, permissive: bool = False) -> DataFrame:
    """(ord, value, error) of a table of segments, by as many tasks as it is split into."""
    columns = ["content", "offset", "first_line", "lines", "expanded", "crc"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in columns)):
                yield segment_lines(*row, permissive)

    return segments(spark, place).select(*columns).mapInArrow(run, RawDeflateSource.FIELDS)


def join_segments(spark: SparkSession, place: str, path: str, indexed: bool = True) -> Sizes:
    """One file of all segments, with its index beside it (<path>.index) if asked for. Only
    compressed bytes pass through the driver, a segment at a time, as one file is written in
    one place. Both files appear whole or not at all."""
    sizes, target, index = Sizes(0, 0), f"{path}.partial", f"{path}.index.partial"
    rows = segments(spark, place).orderBy("part", "seq").toLocalIterator(prefetchPartitions=True)
    try:
        with open(target, "wb") as file, open(index, "w", encoding="utf-8") as places:
            for r in rows:
                sizes.compressed += file.write(r["content"])
                sizes.expanded += r["expanded"]
                places.write(json.dumps({k: r[k] for k in ("offset", "bytes", "first_line", "lines", "expanded", "crc")}) + "\n")
            sizes.compressed += file.write(END)
        if indexed:
            os.replace(index, f"{path}.index")
        os.replace(target, path)
    finally:
        for left in (target, index):
            if os.path.exists(left):
                os.remove(left)
    return sizes


def resegment(spark: SparkSession, path: str, place: str, segment_bytes: int = SEGMENT) -> None:
    """A stream made elsewhere, read once by one task, as a table of segments."""
    write_segments(read_container(spark, path), place, "ord", segment_bytes=segment_bytes)


class RawDeflateSource(DataSource):
    """spark.read.format("raw_deflate").load(path): (ord, value), or with the option
    permissive=true also (error) instead of a stop. With an index each segment is a
    partition of its own."""

    FIELDS = "ord bigint, value string, error string"

    @classmethod
    def name(cls) -> str:
        return "raw_deflate"

    def schema(self) -> str:
        return self.FIELDS

    def reader(self, schema) -> RawDeflateReader:
        return RawDeflateReader(self.options)


class RawDeflateReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"].removeprefix("file://")
        self.permissive = str(options.get("permissive", "false")).lower() == "true"

    def partitions(self) -> list[InputPartition]:
        """The index's segments and what has to follow them, or the whole file."""
        if not os.path.exists(f"{self.path}.index"):
            return [InputPartition(None)]
        with open(f"{self.path}.index", encoding="utf-8") as places:
            own = [json.loads(line) for line in places]
        return [InputPartition(x) for x in own] + [InputPartition({"end": own[-1]["offset"] + own[-1]["bytes"] if own else 0, "line": own[-1]["first_line"] + own[-1]["lines"] if own else 1})]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        own = partition.value
        if own is None:
            yield from batches_of(numbered(file_chunks(self.path), self.permissive))
        elif "end" in own:
            yield from self.end(own["end"], own["line"])
        else:
            with open(self.path, "rb") as file:
                file.seek(own["offset"])
                content = file.read(own["bytes"])
            yield segment_lines(content, own["offset"], own["first_line"], own["lines"], own["expanded"], own["crc"], self.permissive)

    def end(self, at: int, line: int) -> Iterator[pa.RecordBatch]:
        """Nothing where the stream ends as it has to, else the fault."""
        with open(self.path, "rb") as file:
            file.seek(at)
            rest = file.read(len(END) + 1)
        if rest != END:
            error = "bytes after the end of the stream" if rest.startswith(END) else "the stream is cut off"
            if not self.permissive:
                raise ContainerError(error)
            yield line_batch([line], [None], [error])


def batches_of(rows: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    while part := list(islice(rows, LINES_AT_ONCE)):
        yield line_batch(*zip(*part))


def numbered(chunks: Iterable[bytes], permissive: bool) -> Iterator[tuple]:
    """(ord, value, error) of a container's lines; with `permissive` damage is a last row
    with an error instead of a stop."""
    number = 0
    try:
        for number, line in enumerate(lines_of(chunks), 1):
            yield number, line, None
    except (ContainerError, UnicodeDecodeError) as error:
        if not permissive:
            raise
        yield number + 1, None, str(error)


def read_container(spark: SparkSession, path: str, permissive: bool = False) -> DataFrame:
    """Container lines. Of a file in a store that only Spark reads its binary reader gives
    the compressed bytes; the task that holds them expands a chunk at a time and hands
    lines on as they come."""
    if "://" in path and not path.startswith("file://"):
        blobs = spark.read.format("binaryFile").load(path).select("content")

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for content in pdf["content"]:
                    rows = numbered((content[a : a + CHUNK] for a in range(0, len(content), CHUNK)), permissive)
                    while part := list(islice(rows, LINES_AT_ONCE)):
                        yield pd.DataFrame(part, columns=["ord", "value", "error"])

        return blobs.mapInPandas(run, RawDeflateSource.FIELDS)
    spark.dataSource.register(RawDeflateSource)
    return spark.read.format("raw_deflate").option("permissive", str(permissive).lower()).load(path)


def write_ordered(df: DataFrame, path: str, order: str, value: str = "value", indexed: bool = False) -> Sizes:
    """One artifact of the rows' lines in order, compressed by as many tasks as sort them."""
    place = working_folder(df.sparkSession, "segments")
    write_segments(df, place, order, value)
    return join_segments(df.sparkSession, place, path, indexed)
