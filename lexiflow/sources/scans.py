"""Scans of the text sources: ordinals, headers, seeds, tables and logs."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiflow.functions.text import SPACE, trimmed
from lexiflow.schemas import GLOSS, HSK_ENTRY, LEGACY, REFERENCE_ENTRY
from lexiflow.sources.json_array import strict_elements
from lexiflow.sources.ranges import RANGE, numbered, records, with_at


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(ord, value): the lines of a text file, numbered from 1; gzip by the suffix."""
    return numbered(records(spark, path)).select("ord", "value")


def declared_entries(lines: DataFrame) -> int | None:
    """The number in `#! entries=N` among the comments at the head of a file."""
    body = lines.where(~F.col("value").startswith("#")).agg(F.min("ord")).first()[0]
    head = lines.where(F.col("value").rlike(r"^#!\s*entries=\d+"))
    if body is not None:
        head = head.where(F.col("ord") < body)
    row = head.orderBy("ord").select(F.regexp_extract("value", r"entries=(\d+)", 1).cast("int")).first()
    return row[0] if row else None


def check_declared(lines: DataFrame, entries: DataFrame) -> int:
    """Stops if the header does not declare as many entries as there are."""
    declared, actual = declared_entries(lines), entries.count()
    if declared is None:
        raise ValueError("the header declares no number of entries")
    if declared != actual:
        raise ValueError(f"{actual} entries, but the header declares {declared}")
    return actual


def json_lines(spark: SparkSession, path: str | list[str], schema: str) -> DataFrame:
    """Rows of JSON lines under an explicit schema; blank lines are skipped."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def legacy_rows(spark: SparkSession, path: str) -> DataFrame:
    """Earlier translations with their line numbers."""
    lines = text_lines(spark, path).where(F.trim("value") != "")
    fields = LEGACY.removeprefix("ord bigint, ")
    return lines.select("ord", F.from_json("value", fields, {"mode": "FAILFAST"}).alias("r")).select("ord", "r.*")


def hsk_seed(spark: SparkSession, path: str) -> DataFrame:
    """(word, hsk2, hsk3, pos, pinyin, ord): levels by word, from the entries of one JSON
    document. A word that is given again keeps its first place and takes the last values."""
    rows = strict_elements(spark, path, HSK_ENTRY, "entries")
    codes = F.filter(F.array_distinct(F.transform(F.split("e.pos", ","), trimmed)), lambda c: (c != "") & (c != "unknown"))
    value = F.struct(F.col("e.hsk_levels.`2.0`").alias("hsk2"), F.col("e.hsk_levels.`3.0`").alias("hsk3"), F.when(F.size(codes) > 0, codes).alias("pos"), F.coalesce("e.pinyin", F.lit("")).alias("pinyin"))
    return rows.groupBy(F.col("e.word").alias("word")).agg(F.max_by(value, "ord").alias("v"), F.min("ord").alias("ord")).select("word", "v.*", "ord")


def reference_counts(spark: SparkSession, path: str) -> DataFrame:
    """(title, definitions): of an external dictionary, one JSON array, only the greatest number
    of definitions of each title; the schema prunes the texts away."""
    rows = strict_elements(spark, path, REFERENCE_ENTRY).select("e.*")
    total = F.aggregate(F.transform("heteronyms", lambda h: F.coalesce(F.size(h["definitions"]), F.lit(0))), F.lit(0), lambda a, b: a + b)
    return rows.groupBy("title").agg(F.max(F.coalesce(total, F.lit(0))).alias("definitions"))


def frequencies(lines: DataFrame) -> DataFrame:
    """(word, freq) of lines `word number tag`; other lines are skipped, the last wins."""
    parts = lines.select("ord", F.split(trimmed(F.col("value")), f"{SPACE}+").alias("p")).where((F.size("p") >= 2) & F.rlike(F.get("p", F.lit(1)), F.lit(r"^\p{Nd}+$")))
    return parts.groupBy(F.get("p", F.lit(0)).alias("word")).agg(F.max_by(F.get("p", F.lit(1)).cast("bigint"), "ord").alias("freq"))


def overrides(lines: DataFrame) -> DataFrame:
    """(word, pinyin, sense, ja) of tab-separated lines; a line of fewer than four
    columns stops the job; the last wins."""
    rows = lines.where((F.trim("value") != "") & ~F.col("value").startswith("#")).select("ord", F.split("value", "\t").alias("c"))
    whole = F.when(F.size("c") >= 4, F.col("c")).otherwise(F.raise_error(F.concat(F.lit("an override needs four columns: line "), F.col("ord"))))
    cells = rows.select("ord", whole.alias("c")).select("ord", *(F.get("c", F.lit(k)).alias(n) for k, n in enumerate(("word", "pinyin", "sense", "ja"))))
    return cells.groupBy("word", "pinyin", F.col("sense").cast("int").alias("sense")).agg(F.max_by("ja", "ord").alias("ja"))


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """Those of the paths that are there; Spark's own file systems are asked."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    path = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    return [p for p in paths if path(p).getFileSystem(conf).exists(path(p))]


def repaired(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(id, sense) of all files that are there, each once."""
    found = existing(spark, paths)
    return spark.read.schema("id string, sense int").json(found).distinct() if found else spark.createDataFrame([], "id string, sense int")


def allowlist(lines: DataFrame) -> DataFrame:
    """(token): lines without what follows a `#`, trimmed, without empty ones."""
    return lines.select(trimmed(F.regexp_replace("value", "#.*$", "")).alias("token")).where("token <> ''").distinct()


def log_rows(spark: SparkSession, paths: list[str], schema: str = GLOSS) -> tuple[DataFrame, DataFrame]:
    """(rows, broken lines) of logs that may have been cut off; missing files are skipped.
    Rows also have `written`, the place of their line: logs in the order given, in each
    the files by name, then the lines."""
    found = existing(spark, paths)
    if not found:
        none = spark.createDataFrame([], f"{schema}, written struct<log: int, file: string, range: bigint, at: bigint>")
        return none, spark.createDataFrame([], "file string, value string")
    each = [records(spark, p).withColumn("log", F.lit(n)) for n, p in enumerate(found)]
    raw = functools.reduce(DataFrame.unionByName, each).where(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))
    sound = F.col("v").isNotNull() & F.col("value").rlike(r"^\s*\{")
    rows = raw.where(sound).select(F.from_json("value", schema).alias("r"), F.struct("log", *RANGE, "at").alias("written")).select("r.*", "written")
    return rows, raw.where(~sound).select("file", "value")


def ids(lines: DataFrame) -> DataFrame:
    """(id, rank) of a list of ids, or of the first column of a table with a header."""
    rows = lines.where((F.trim("value") != "") & ~F.col("value").startswith("#")).select("ord", F.split_part("value", F.lit("\t"), F.lit(1)).alias("id"))
    return rows.where("id <> 'id'").groupBy("id").agg(F.min("ord").alias("rank"))


def strict_records(lines: DataFrame, required: dict[str, str], optional: dict[str, str], identity: tuple[str, ...] = ("word", "trad", "pinyin")) -> tuple[DataFrame, DataFrame]:
    """(rows, errors (ord, error)) of patch records: JSON objects with exactly the known
    keys, each of its type, and no identity twice: what repeats an earlier one is an
    error. Types are read from the raw JSON, so that true is no number and 1.0 no index."""
    raw = lines.where(F.trim("value") != "").withColumn("v", F.try_parse_json("value"))
    keys = F.map_keys(F.from_json("value", "map<string, string>"))
    known = F.array(*(F.lit(k) for k in [*required, *optional]))
    field = lambda k: F.try_variant_get(F.col("v"), f"$.{k}", "variant")

    def bad(k: str, kind: str, needed: bool) -> Column:
        there = F.schema_of_variant(field(k))
        absent = field(k).isNull() | F.is_variant_null(field(k))
        return F.when(absent, F.lit(f"{k} is missing") if needed else F.lit(None)).when(there != kind, F.lit(f"{k} is of another type"))

    tests = [bad(k, t, True) for k, t in required.items()] + [bad(k, t, False) for k, t in optional.items()]
    error = F.when(F.col("v").isNull() | ~F.col("value").rlike(r"^\s*\{"), "no object").when(F.size(F.array_except(keys, known)) > 0, "unknown key")
    checked = raw.withColumn("error", F.coalesce(error, *tests))
    names = {"BIGINT": "bigint", "STRING": "string", "ARRAY<STRING>": "array<string>", "BOOLEAN": "boolean"}
    fields = {**required, **optional}
    typed = checked.where("error is null").select("ord", *(F.try_variant_get("v", f"$.{k}", names[t]).alias(k) for k, t in fields.items()))
    place = F.row_number().over(Window.partitionBy(*(k for k in identity if k in fields)).orderBy("ord"))
    ranked = typed.withColumn("__place", place)
    again = ranked.where("__place > 1").select("ord", F.lit("the identity is given twice").alias("error"))
    return ranked.where("__place = 1").drop("__place"), checked.where("error is not null").select("ord", "error").unionByName(again)


#: What ends a line beside a line feed, for programs that split at any of them.
OTHER_ENDS = "[\\u2028\\u2029\\x{85}\\x0B\\x0C]"


def forensic_lines(spark: SparkSession, path: str, name: str) -> tuple[DataFrame, DataFrame]:
    """(rows (line, value), violations) of JSON-lines files read as bytes: byte-order
    mark, carriage returns, a missing last newline, bytes that are no UTF-8, blank and
    broken lines, lines that are no objects, replacement characters. Ranges of a file are
    read by many tasks. The mark and the last newline show in a file's size: that is what
    its lines and their ends take, three more with a mark, and one less without a newline.
    Lines are numbered in their files; of several files rows and violations have `file` too."""
    from lexiflow.operators.rules import violation

    raw, last = records(spark, path), F.max(F.struct("range", "at"))
    taken = F.sum(F.octet_length("value").cast("bigint") + 1)
    whole = raw.groupBy("file", "file_size").agg(
        (F.col("file_size") - taken).alias("rest"), F.max(F.col("value").contains("\r")).alias("crlf"), F.min(F.is_valid_utf8("value")).alias("valid"), last.alias("last")
    )
    marked, open_ = F.col("rest") >= 2, F.col("rest").isin(-1, 2)
    kinds = F.array_compact(F.array(F.when(marked, "bom"), F.when(F.col("crlf"), "crlf"), F.when(open_, "no-final-newline"), F.when(~F.col("valid"), "invalid-utf8")))
    files = whole.select("file", F.explode(kinds).alias("kind")).select("file", *violation(name, F.lit(None), F.lit(None), F.col("kind"), F.lit("the file as a whole")))
    ends = whole.where(open_).select("file", F.col("last.range").alias("range"), F.col("last.at").alias("at"), F.lit(True).alias("open"))
    text = F.make_valid_utf8("value")
    cut = raw.join(F.broadcast(ends), [*RANGE, "at"], "left").withColumn("value", F.when(F.col("open"), text).otherwise(F.regexp_replace(text, "\r$", "")))  # a row a file
    parts = with_at(cut.select(*RANGE, F.explode(F.split("value", OTHER_ENDS)).alias("value")))
    lines = numbered(parts, "line", by_file=True).withColumn("v", F.try_parse_json("value"))
    kind = F.when(F.trim("value") == "", "blank-line").when(F.col("v").isNull(), "broken-json").when(~F.col("value").rlike(r"^\s*\{"), "not-object").when(F.col("value").contains("\ufffd"), "replacement-char")
    found = lines.withColumn("kind", kind)
    broken = found.where("kind is not null").select("file", *violation(name, F.col("line"), F.lit(None), F.col("kind"), F.substring("value", 1, 80)))
    return found.where("kind is null or kind = 'replacement-char'").select("file", "line", "value"), files.unionByName(broken)
