"""The elements of one huge JSON array, by byte ranges.

The document is read as what stands between line ends or, where a line is long, between
commas, so each record belongs to one range. Whether a comma separates elements depends on
all text before it, but little of that is needed: whether it ends within a string, and how
deep. Of each range one pass finds whether it changes the first, and how much deeper it ends
for either start; sums of these over the ranges before it give the state in which each one
begins. A second pass follows the brackets from there and cuts the text where an element
begins or ends. What lies across the border of ranges, at most two pieces a range, is put
together again. Places come from sums of bytes and of cuts; a document may also be several
files, by name. Records only go through both passes: nothing sorts or sends them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from lexiflow.session import materialise, same_files
from lexiflow.sources.ranges import RANGE, before, records

QUOTE, COMMA, ARRAY = b'",['
#: Depth of the elements: of an array that is the document, or that is a field of it.
IN_DOCUMENT, IN_FIELD = 1, 2
#: Bytes of a line, its end among them, from which on the reader leaves it out: then a document is read by its commas.
LONGEST = 1 << 16
PIECE = "nth bigint, k bigint, began string, ended string, offset bigint, text string"
#: By character: whether it may be structure, how it changes the depth, and its place in CUTS.
CUTS = ",[]}"
MAY, STEP, CODE = bytes(c in b'",[]{}' for c in range(256)), np.zeros(256, np.int8), np.zeros(256, np.int8)
STEP[list(b"[{")], STEP[list(b"]}")] = 1, -1
CODE[list(CUTS.encode())] = range(len(CUTS))


def structure(data: bytes, in_string: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(places, characters there, whether each is in no string, whether the end is in one) of
    the characters that may be structure."""
    plain = data.replace(b"\\\\", b"__").replace(b'\\"', b"__") if b"\\" in data else data
    places = np.flatnonzero(np.frombuffer(plain.translate(MAY), bool))
    marks = np.frombuffer(plain, np.uint8)[places]
    quotes = np.logical_xor.accumulate(marks == QUOTE)
    return places, marks, quotes == in_string, bool(quotes[-1]) != in_string if len(places) else in_string


def runs(batches: Iterator[pa.RecordBatch], *key: str) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Consecutive rows of one range, which the columns of the key name."""
    for batch in (b for b in batches if b.num_rows):
        other = np.zeros(batch.num_rows - 1, bool)
        for column in map(batch.column, key):
            other |= pc.not_equal(column[1:], column[:-1]).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(other) + 1).tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:]):
            yield tuple(batch.column(c)[start].as_py() for c in key), batch.slice(start, end - start)


def text_of(batch: pa.RecordBatch, separator: bytes) -> bytes:
    """The records with the separator between them."""
    return separator.join(batch.column("value").cast(pa.binary()).to_pylist())


def summaries(rows: DataFrame, separator: str) -> DataFrame:
    """(file, range, file_size, bytes, turns, flat, quoted): whether a range ends in the other state
    (in a string or not) than it begins, and the change of depth if it begins outside, or
    within. A separator counts behind each record, also where a file ends without one."""
    schema = _parse_datatype_string("file string, range bigint, file_size bigint, bytes bigint, turns int, flat bigint, quoted bigint")
    arrow, mark = to_arrow_schema(schema), separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*key, state[0], int(state[1]), *state[2:]), arrow)], schema=arrow)
        for own, batch in runs(batches, *RANGE, "file_size"):
            if own != key:
                if key is not None:
                    yield out()
                key, state = own, [0, False, 0, 0]
            data = text_of(batch, mark)
            _, marks, outside, turned = structure(data, state[1])  # of a start outside; of one within it is the reverse
            flat, every = int(STEP[marks[outside]].sum(dtype=np.int64)), int(STEP[marks].sum(dtype=np.int64))
            state = [state[0] + len(data) + 1, turned, state[2] + flat, state[3] + every - flat]
        if key is not None:
            yield out()

    return rows.select("value", *RANGE, "file_size").mapInArrow(run, schema)


class Range:
    """The cuts of one range: what is read, from its start, gives pieces."""

    def __init__(self, nth: int, in_string: bool, depth: int, offset: int, ends: bool, level: int, arrow: pa.Schema) -> None:
        self.nth, self.in_string, self.depth, self.offset, self.ends, self.level, self.arrow = nth, in_string, depth, offset, ends, level, arrow
        self.k, self.began, self.start, self.held = 0, None, offset, []

    def pieces(self, ended: np.ndarray, starts: np.ndarray, text: bytes, bounds: np.ndarray) -> pa.RecordBatch:
        """Pieces that follow each other in a text; nothing ended the last one, if `ended` has one less."""
        count, codes, none = len(starts), pa.array(list(CUTS)), pa.array([None], pa.int8())
        ends = pa.concat_arrays([pa.array(ended, pa.int8()), none])
        began = pa.concat_arrays([pa.array([self.began], pa.int8()), ends])[:count]
        texts = pa.Array.from_buffers(pa.large_binary(), count, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(text)])
        try:
            texts = texts.cast(pa.string())
        except pa.ArrowInvalid:  # no UTF-8
            texts = pa.array([t.decode("utf-8", "replace") for t in texts.to_pylist()], pa.string())
        columns = [pa.array(np.full(count, self.nth)), pa.array(self.k + np.arange(count)), codes.take(began), codes.take(ends[:count]), pa.array(starts), texts]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, self.arrow)], schema=self.arrow)

    def read(self, data: bytes) -> Iterator[pa.RecordBatch]:
        places, marks, outside, self.in_string = structure(data, self.in_string)
        outside &= marks != QUOTE
        places, marks = places[outside], marks[outside]
        change = STEP[marks]
        depths = self.depth + np.cumsum(change, dtype=np.int64)
        cuts = (((marks == COMMA) | (marks == ARRAY)) & (depths == self.level)) | ((change < 0) & (depths == self.level - 1))
        at, ended = places[cuts], CODE[marks[cuts]]
        if len(at):
            before, last = b"".join(self.held), int(at[-1])
            text = before + np.delete(np.frombuffer(data, np.uint8, last), at[:-1]).tobytes()
            bounds = np.concatenate([[0], len(before) + at - np.arange(len(at))])
            starts = np.concatenate([[self.start], self.offset + at[:-1] + 1])
            yield self.pieces(ended, starts, text, bounds)
            self.k, self.began, self.start, self.held = self.k + len(at), int(ended[-1]), self.offset + last + 1, [data[last + 1 :]]
        else:
            self.held.append(data)
        self.offset, self.depth = self.offset + len(data), int(depths[-1]) if len(depths) else self.depth

    def close(self, separator: bytes) -> Iterator[pa.RecordBatch]:
        if not self.ends:
            yield from self.read(separator)
        text = b"".join(self.held)
        yield self.pieces(np.array([], np.int8), np.array([self.start]), text, np.array([0, len(text)]))


def pieces(rows: DataFrame, level: int, separator: str) -> DataFrame:
    """What stands between cuts, in each range from 0: before the first one, where nothing
    `began`, and after the last, where nothing `ended`; offsets are of the whole document."""
    schema = _parse_datatype_string(PIECE)
    arrow, mark = to_arrow_schema(schema), separator.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = None
        for (nth,), batch in runs(batches, "nth"):
            data = text_of(batch, mark)
            if current is not None and current.nth == nth:
                data = mark + data
            else:
                if current is not None:
                    yield from current.close(mark)
                current = Range(nth, *(batch.column(c)[0].as_py() for c in ("in_string", "depth", "offset", "ends")), level, arrow)
            yield from current.read(data)
        if current is not None:
            yield from current.close(mark)

    return rows.select("value", "nth", "in_string", "depth", "offset", "ends").mapInArrow(run, schema)


def ranges_of(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, str]:
    """(records, their ranges, separator): lines, or what stands between commas where the
    reader left out a line as too long, which the sizes of the files tell."""
    size = spark.read.format("binaryFile").load(path).agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    for separator, longest in (("\n", LONGEST), (",", None)):
        rows = records(spark, path, separator, longest)
        ranges = materialise(summaries(rows, separator))
        files = ranges.groupBy("file", "file_size").agg((F.col("file_size") - F.sum("bytes")).alias("more"))  # the mark, and no separator at the end
        odd, seen = files.agg(F.count_if(~F.col("more").isin(-1, 0, 2, 3)), F.coalesce(F.sum("file_size"), F.lit(0))).first()
        if longest is None or (odd == 0 and seen == size):
            return rows, ranges, separator
    raise AssertionError


def json_array(spark: SparkSession, path: str, field: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(elements (ord, offset, value), faults (offset, detail)) of the array that a document
    is, or that its field holds. Offsets count bytes from 0. Faults are elements that are no
    JSON and a document that is cut off or has no such array; an empty file is one. A
    field that is given twice counts once, the first time."""
    rows, ranges, separator = ranges_of(spark, path)
    own = Window.partitionBy("file")
    more = F.col("file_size") - F.sum("bytes").over(own)  # a file's size tells a byte-order mark, and a separator behind the last record
    marked = ranges.withColumn("mark", F.when((F.col("range") == 0) & (more >= 2), 3).otherwise(0)).withColumn("ends", (F.col("range") == F.max("range").over(own)) & ~more.isin(0, 3))
    found = marked.withColumn("bytes", F.col("bytes") + F.col("mark") - F.col("ends").cast("int"))
    begun = before(found, "turns", "bytes").withColumn("in_string", F.col("turns_before") % 2 == 1)
    begun = materialise(before(begun.withColumn("change", F.when(F.col("in_string"), F.col("quoted")).otherwise(F.col("flat"))).withColumn("one", F.lit(1)), "change", "one"))
    states = begun.select(*RANGE, F.col("one_before").alias("nth"), "in_string", F.col("change_before").alias("depth"), (F.col("bytes_before") + F.col("mark")).alias("offset"), "ends")
    level = IN_DOCUMENT if field is None else IN_FIELD
    cut = materialise(pieces(rows.join(F.broadcast(states), list(RANGE)), level, separator))  # a row a range

    # pieces across borders of ranges, put together
    counts = cut.groupBy("nth").agg(F.max("k").alias("cuts"))
    earlier = F.coalesce(F.sum("cuts").over(Window.orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = cut.join(F.broadcast(counts.select("nth", earlier.alias("cuts_before"))), "nth").withColumn("id", F.col("cuts_before") + F.col("k"))
    whole = F.col("began").isNotNull() & F.col("ended").isNotNull()
    parts = F.array_sort(F.collect_list(F.struct("nth", "text")))
    joined = materialise(placed.where(~whole).groupBy("id").agg(F.max("began").alias("began"), F.max("ended").alias("ended"), F.min("offset").alias("offset"), F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text")))  # two rows a range, once for all that follows
    every = placed.where(whole).select("id", "began", "ended", "offset", "text").unionByName(joined)

    # the array's place among the cuts: the one that opens it and the one that closes it
    opens = F.rlike("text", F.lit("^[ \t\r\n]*$")) & (F.col("id") == 0) if field is None else F.rlike("text", F.lit(f'"{field}"[ \t\r\n]*:[ \t\r\n]*$'))
    first = every.where((F.col("ended") == "[") & opens).agg(F.min("id")).first()[0]
    last, closed = (None, None) if first is None else every.where((F.col("id") > first) & F.col("ended").isin("]", "}")).agg(F.min("id"), F.min_by("ended", "id")).first()
    inside = every.where(F.lit(False) if first is None else (F.col("id") > first) & (F.lit(True) if last is None else F.col("id") <= last))
    value = F.btrim("text", F.lit(" \t\r\n"))
    none = (F.col("began") == "[") & F.coalesce(F.col("ended") == "]", F.lit(False)) & (F.col("value") == "")
    elements = inside.withColumn("value", value).where(~none).select((F.col("id") - F.lit(first or 0)).alias("ord"), "offset", "value")
    broken = elements.where(F.try_parse_json("value").isNull()).select("offset", F.concat(F.lit("no JSON: "), F.substring("value", 1, 60)).alias("detail"))
    end, turns, deep = begun.agg(F.coalesce(F.sum("bytes"), F.lit(0)), F.coalesce(F.sum("turns"), F.lit(0)), F.coalesce(F.sum("change"), F.lit(0))).first()
    faults = {"cut off within a string": turns % 2, "cut off": deep > 0, "closed too often": deep < 0, "no such array": first is None, "closed as an object": closed == "}"}
    document = spark.createDataFrame([(end, what) for what, there in faults.items() if there][:1], "offset bigint, detail string")
    return same_files(elements, cut), document.unionByName(broken)


def strict_elements(spark: SparkSession, path: str, schema: str, field: str | None = None) -> DataFrame:
    """(ord, e): the elements under a schema, read lazily; a fault stops the job with its place."""
    elements, faults = json_array(spark, path, field)
    if (fault := faults.orderBy("offset").first()) is not None:
        raise ValueError(f"byte {fault['offset']}: {fault['detail']}")
    return elements.select("ord", F.from_json("value", schema).alias("e"))
