"""Patches of native rows: primary senses, default rows, parts of speech."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.operators.matching import append_missing, examples
from lexiflow.session import discard, materialise, same_files


class PatchError(ValueError):
    """Records that do not fit the rows; nothing was written."""


def identity(df: DataFrame) -> Column:
    """A row's exact identity: word, traditional form (or empty), reading."""
    return F.struct(F.col("word"), F.coalesce("trad", F.lit("")).alias("trad"), F.col("pinyin"))


def keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("__key", identity(df))


def primary_errors(rows: DataFrame, primary: DataFrame, default: DataFrame) -> DataFrame:
    """(label, key): records that name no row, another sense or another text, repeated
    records, and words of several rows of which none or several are the default."""
    r = materialise(keyed(rows).select("__key", F.transform("senses", lambda s: s["ja"]).alias("texts")))  # read several times
    p = keyed(primary)
    met = p.join(r.withColumn("there", F.lit(True)), "__key", "left")
    found = F.get("texts", F.col("sense") - 1)
    label = F.when(F.col("there").isNull(), "no such row").when(~F.col("sense").between(1, F.size("texts")), "no such sense").when(~found.eqNullSafe(F.col("ja")), "another text")
    wrong = met.withColumn("label", label).where("label is not null").select("label", "__key")
    lost = keyed(default).join(r.select("__key"), "__key", "left_anti").select(F.lit("no such row").alias("label"), "__key")
    twice = p.groupBy("__key").count().where("count > 1").select(F.lit("repeated record").alias("label"), "__key")
    need = r.groupBy(F.col("__key.word").alias("word")).agg(F.count("*").alias("n")).where("n > 1").join(default.select("word").distinct(), "word", "left_anti")
    bare = need.select(F.lit("no default").alias("label"), F.struct("word", F.lit("").alias("trad"), F.lit("").alias("pinyin")).alias("__key"))
    no_primary = r.where(F.size("texts") >= 2).join(p.select("__key"), "__key", "left_anti").select(F.lit("no primary").alias("label"), "__key")
    return same_files(wrong.unionByName(lost).unionByName(twice).unionByName(bare).unionByName(no_primary).withColumnRenamed("__key", "key"), r)


def apply_primary(rows: DataFrame, primary: DataFrame, default: DataFrame) -> DataFrame:
    """Rows with `primary` and `default` of the records alone, whatever they had before; a
    record for a row of one sense is checked but not written. Stops on any error."""
    primary, default = (materialise(df.select(*names)) for df, names in ((primary, ["word", "trad", "pinyin", "sense", "ja"]), (default, ["word", "trad", "pinyin"])))  # read several times
    errors = primary_errors(rows, primary, default)
    found = examples(errors.select("label", F.col("key.word").alias("word")), "label", "word").orderBy("label").collect()
    discard(errors)
    if found:
        raise PatchError("; ".join(f"{r['label']}: {r['n']} ({r['examples']})" for r in found))
    p = keyed(primary).select("__key", F.col("sense").alias("__primary"))
    d = keyed(default).select("__key", F.lit(True).alias("__default")).distinct()
    joined = keyed(rows.drop("primary", "default")).join(p, "__key", "left").join(d, "__key", "left")
    fresh = joined.withColumn("primary", F.when(F.size("senses") >= 2, F.col("__primary"))).withColumn("default", F.col("__default"))
    return same_files(fresh.select(*rows.columns), primary)


def apply_pos(rows: DataFrame, records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with the codes they lacked, report (status, n)): added, present, absent."""
    r = keyed(records).select("__key", "add")
    joined = keyed(rows).join(r, "__key", "left")
    have = F.coalesce("pos", F.array().cast("array<string>"))
    patched = joined.withColumn("pos", F.when(F.col("add").isNotNull(), append_missing(F.col("pos"), F.col("add"))).otherwise(F.col("pos"))).select(*rows.columns)
    met = r.join(keyed(rows).select("__key", have.alias("have"), F.lit(True).alias("there")), "__key", "left")
    status = F.when(F.col("there").isNull(), "absent").when(F.size(F.array_except("add", "have")) > 0, "added").otherwise("present")
    return patched, met.groupBy(status.alias("status")).agg(F.count("*").alias("n"))
