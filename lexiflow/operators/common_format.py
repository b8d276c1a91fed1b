"""The common format: a mapping of native rows, and the proof that it keeps everything."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.schemas import DICTIONARY_NAME

# By supplement or not and qa, the provenance method and the evidence
# (subject, method, result) for a translation.
CHECKED = ("translation", "script_and_length", "passed")
LEGACY = "legacy_entry_translation_set"
ORIGINS = {
    (False, "llm_ok"): ("llm", CHECKED),
    (False, "llm_fixed"): ("llm", CHECKED),
    (False, "hand_fixed"): ("manual_override", CHECKED),
    (False, "derived"): ("derived", None),
    (True, "llm_ok"): ("legacy", (LEGACY, "legacy_llm_review", "passed")),
    (True, "llm_fixed"): ("legacy", (LEGACY, "legacy_llm_review", "corrected")),
    (True, "machine_backed"): ("legacy", (LEGACY, "legacy_dictionary_overlap", "reported_overlap")),
    (True, "unchecked"): ("legacy", (LEGACY, "legacy_review", "unchecked")),
    (True, "human_reviewed"): ("legacy", ("reading_sense_alignment", "legacy_human_review", "passed")),
}
ENTRY_EXTENSIONS = ("cl", "pos", "src", "seed", "moe")
SENSE_EXTENSIONS = ("misc", "variant_of", "see_also", "lsource", "s_inf")


def present(*items: Column) -> Column:
    return F.array_compact(F.array(*items))


def part(condition: Column, **fields: Column | str) -> Column:
    """A structure where the condition holds, else null."""
    return F.when(condition, F.struct(*((F.lit(v) if isinstance(v, str) else v).alias(k) for k, v in fields.items())))


def evidence(subject: str, method: str, result: Column | str, source: Column | None = None) -> Column:
    value = F.lit(result) if isinstance(result, str) else result
    return F.struct(F.lit(subject).alias("subject"), F.lit(method).alias("method"), value.alias("result"), (source if source is not None else F.lit(None).cast("string")).alias("source_value"))


def common_id() -> Column:
    """[word, trad or null, pinyin] as compact JSON under the dictionary's name."""
    return F.struct(F.lit(DICTIONARY_NAME).alias("source"), F.to_json(F.array("word", "trad", "pinyin")).alias("value"))


def extensions(value: Column | None, names: tuple[str, ...], extra: dict[str, Column] | None = None) -> Column:
    """A map with one key, the dictionary's name, or an empty map if there is nothing."""
    pick = (lambda n: value[n]) if value is not None else F.col
    fields = {n: pick(n) for n in names} | (extra or {})
    held = F.struct(*(c.alias(n) for n, c in fields.items()))
    some = F.coalesce(*(F.when(c.isNotNull(), F.lit(True)) for c in fields.values()), F.lit(False))
    entries = F.array_compact(F.array(F.when(some, F.struct(F.lit(DICTIONARY_NAME).alias("key"), held.alias("value")))))
    return F.map_from_entries(entries)


def origin(supplement: Column, qa: Column, what: int) -> Column:
    """Provenance method (0) or evidence (1); other combinations stop the job."""
    out = None
    for (of_supplement, code), row in ORIGINS.items():
        test = (supplement == of_supplement) & (qa == code)
        value = F.lit(row[0]) if what == 0 else (F.array(evidence(*row[1])) if row[1] else F.array().cast("array<struct<subject: string, method: string, result: string, source_value: string>>"))
        out = F.when(test, value) if out is None else out.when(test, value)
    stop = F.raise_error(F.concat(F.lit("no origin for qa "), F.coalesce(qa, F.lit("null"))))
    return out.otherwise(stop if what == 0 else stop.cast("array<struct<subject: string, method: string, result: string, source_value: string>>"))


def to_common(native: DataFrame) -> DataFrame:
    """(ord, id, headwords, readings, levels, verification, extensions, senses)."""
    supplement = F.col("src").isNotNull()
    word = F.when((F.col("word") == "") | F.col("word").isNull() | (F.size("senses") < 1), F.raise_error(F.lit("an entry without a word or senses"))).otherwise(F.col("word"))

    def sense(s: Column) -> Column:
        text = F.when(s["ja"].isNull() | (s["ja"] == ""), F.raise_error(F.lit("a sense without a translation"))).otherwise(s["ja"])
        translation = F.struct(
            F.lit("ja").alias("language"),
            text.alias("text"),
            F.struct(origin(supplement, s["qa"], 0).alias("method"), F.lit(DICTIONARY_NAME).alias("source"), s["qa"].alias("source_value")).alias("provenance"),
            origin(supplement, s["qa"], 1).alias("verification"),
            F.coalesce(s["unsure"], F.lit(False)).alias("uncertain"),
        )
        glosses = F.transform(F.coalesce(s["en"], F.array().cast("array<string>")), lambda g: F.struct(F.lit("en").alias("language"), g.alias("text")))
        return F.struct(glosses.alias("glosses"), F.array(translation).alias("translations"), extensions(s, SENSE_EXTENSIONS).alias("extensions"))

    reading = lambda c, kind: part(F.col(c).isNotNull(), text=F.col(c), system="pinyin", kind=kind)
    level = lambda c, version: part(F.col(c).isNotNull(), system="HSK", version=version, value=F.col(c).cast("string"))
    return native.select(
        "ord",
        common_id().alias("id"),
        present(part(F.lit(True), text=word, kind="primary"), part(F.col("trad").isNotNull(), text=F.col("trad"), kind="traditional")).alias("headwords"),
        present(reading("pinyin", "primary"), reading("tw_pr", "taiwan"), reading("also_pr", "alternate")).alias("readings"),
        present(level("hsk2", "2.0"), level("hsk3", "3.0")).alias("levels"),
        F.array_compact(F.array(F.when(F.col("moe").isNotNull(), evidence("entry_headword_and_sense_count", "moedict_crosscheck", F.col("moe"))))).alias("verification"),
        extensions(None, ENTRY_EXTENSIONS, {"primary_sense": F.col("primary"), "default_row": F.col("default")}).alias("extensions"),
        F.transform("senses", sense).alias("senses"),
    )


def comparable(common: DataFrame) -> DataFrame:
    """(ord, value): each entry as canonical JSON."""
    return common.select("ord", F.to_json(F.struct(*(c for c in common.columns if c != "ord"))).alias("value"))


def preservation_errors(native: DataFrame, common: DataFrame, limit: int | None = None) -> DataFrame:
    """(ord, error): places where the common rows are not what the native ones map to; with
    a limit of the first so many places only. Whole files are counted in any case, by
    sinks.artifacts.check_artifact()."""
    if limit is not None:
        if limit < 1:
            raise ValueError("a limit is a positive number")
        native, common = (df.orderBy("ord").limit(limit) for df in (native, common))
    want, have = comparable(to_common(native)), comparable(common).withColumnRenamed("value", "other")
    joined = want.join(have, "ord", "full_outer")
    error = F.when(F.col("other").isNull(), "missing").when(F.col("value").isNull(), "unexpected").when(F.col("value") != F.col("other"), "different")
    return joined.withColumn("error", error).where("error is not null").select("ord", "error")


def repeated_ids(common: DataFrame) -> DataFrame:
    return common.groupBy("id.value").agg(F.count("*").alias("n")).where("n > 1")
