"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from lexiflow.session import discard, materialise, same_files, shared_dir  # noqa: F401 - operators take them from here

#: Texts are handed to vectorised code in slices of about so many bytes.
SLICE_BYTES = 2_000_000
#: A key of more rows is split for joins; at most so many keys and parts.
HOT_ROWS, MOST_HOT, MOST_PARTS = 1000, 1000, 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` of the data folder `sf_dir`."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """Place of a public vocabulary file; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def frequent(df: DataFrame, key: str, most: int = HOT_ROWS) -> DataFrame | None:
    """(key, __parts): the most frequent values of a column that have over `most` rows,
    and how many parts their rows are split into."""
    hot = df.groupBy(key).agg(F.count("*").alias("__n")).where(F.col("__n") > most).orderBy(F.desc("__n")).limit(MOST_HOT).collect()
    if not hot:
        return None
    parts = [(r[key], min(MOST_PARTS, -(-r["__n"] // most))) for r in hot]
    return F.broadcast(df.sparkSession.createDataFrame(parts, f"`{key}` bigint, __parts int"))  # MOST_HOT rows


def split_join(many: DataFrame, one: DataFrame, key: str, spread: str, how: str = "inner", most: int = HOT_ROWS, rows: int | None = None) -> DataFrame:
    """`many` joined with `one`, which has a row a key. The rows of a key of over `most`
    are dealt to parts by the column `spread`, and the other side is repeated for each.
    Where `many` is known to have no more than `most` rows, `rows` says so."""
    hot = frequent(many, key, most) if rows is None or rows > most else None
    if hot is None:
        return many.join(one, key, how)
    dealt = many.join(hot, key, "left").withColumn("__part", F.coalesce(F.pmod(F.xxhash64(spread), F.col("__parts")), F.lit(0)).cast("int")).drop("__parts")
    every = one.join(hot, key, "left").withColumn("__part", F.explode(F.sequence(F.lit(0), F.coalesce("__parts", F.lit(1)) - 1))).drop("__parts")
    return dealt.join(every, [key, "__part"], how).drop("__part")


_held: tuple[Hashable, object] | None = None


def held(key: Hashable, make: Callable[[], object]) -> object:
    """make()'s result, which a worker process keeps from task to task until another one is
    asked for: caches of one operator never stand beside those of the one before."""
    global _held
    if _held is None or _held[0] != key:
        _held = None
        release()
        _held = key, make()
    return _held[1]


def release() -> None:
    """Gives back what Arrow's pool keeps of arrays that are gone; after each slice."""
    pa.default_memory_pool().release_unused()


def text_of(column: str) -> Column:
    """The text, with null as the empty string."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with the value computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def bounds_of(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """(from, to) of consecutive texts of about `most` bytes."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    start = held = 0
    for i, n in enumerate(sizes.tolist()):
        held += n
        if held >= most or i + 1 == len(sizes):
            yield start, i + 1
            start, held = i + 1, 0


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, list[str | None]]]:
    """(from, to, texts) of consecutive texts of about `most` bytes; only these are turned
    into Python strings at a time."""
    for a, b in bounds_of(texts, most):
        yield a, b, texts.slice(a, b - a).to_pylist()


def map_texts(df: DataFrame, id_col: str, text_col: str, schema: str, make: Callable[[], Callable[[list[str]], Iterable[tuple]]], keep_null: bool = False, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Applies a per-worker function to slices of texts.

    `make()` runs once per task and returns a function from a list of texts to
    one tuple per text; the result has the id column followed by `schema`. A null
    text is given as the empty text, or as None with `keep_null`.
    """
    source = df.select(F.col(id_col), (F.col(text_col) if keep_null else text_of(text_col)).alias("__text"))
    out_schema = StructType([df.schema[id_col], *_parse_datatype_string(schema).fields])
    arrow = to_arrow_schema(out_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for a, b, texts in slices(batch.column(1), slice_bytes):
                rows = list(work(texts))
                columns = list(zip(*rows)) if rows else [[] for _ in range(len(arrow) - 1)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), *(pa.array(c, arrow.field(k + 1).type) for k, c in enumerate(columns))],
                    schema=arrow,
                )
                release()

    return source.mapInArrow(run, out_schema)
