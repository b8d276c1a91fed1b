"""From base rows and texts to native rows: fill, override, collapse, cross-check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.operators.matching import append_missing, verdict
from lexiflow.plans.inference import last_texts


class AssembleError(ValueError):
    """Inputs that do not fit together; nothing was written."""


def filled_senses(base: DataFrame, glosses: DataFrame, repaired: DataFrame, overrides: DataFrame) -> DataFrame:
    """(id, n, s, used): every sense with its text. A text goes in only where there is
    none, of several for one sense the one written last; an override goes over any text but not over a missing one."""
    marked = last_texts(glosses).join(repaired.select("id", "sense").distinct().withColumn("fixed", F.lit(True)), ["id", "sense"], "left")
    senses = base.select("id", "word", "pinyin", F.posexplode("senses").alias("p", "s")).withColumn("sense", F.col("p") + 1)
    own = overrides.withColumnRenamed("ja", "override")
    met = senses.join(marked.withColumnRenamed("ja", "gloss"), ["id", "sense"], "left").join(own, ["word", "pinyin", "sense"], "left")
    lacks = F.coalesce(F.col("s.ja"), F.lit("")) == ""
    text, qa = F.when(lacks, F.col("gloss")).otherwise(F.col("s.ja")), F.when(lacks, F.when(F.col("fixed"), "llm_fixed").otherwise("llm_ok")).otherwise(F.col("s.qa"))
    used = F.col("override").isNotNull() & text.isNotNull()
    s = F.col("s").withField("ja", F.when(used, F.col("override")).otherwise(text)).withField("qa", F.when(used, F.lit("hand_fixed")).otherwise(qa))
    return met.select("id", "word", "pinyin", F.col("sense").alias("n"), s.alias("s"), used.alias("used"))


def collapsed(senses: DataFrame) -> DataFrame:
    """(id, senses, merged): senses of equal text and notes as one, at the first one's
    place; what later ones add to its glosses follows; a rewritten one marks it so."""
    notes = F.to_json(F.struct(*(F.col(f"s.{c}") for c in ("misc", "variant_of", "see_also", "lsource", "s_inf", "unsure"))))
    none = F.array().cast("array<string>")
    group = senses.groupBy("id", F.col("s.ja").alias("ja"), notes.alias("notes")).agg(F.min_by("s", "n").alias("s"), F.min("n").alias("n"), F.count("*").alias("k"), F.array_sort(F.collect_list(F.struct("n", F.coalesce("s.en", none).alias("en")))).alias("all"), F.max(F.when(F.col("n") > 0, F.struct("n", F.col("s.qa").alias("qa")))).alias("last"), F.collect_list(F.struct("n", F.col("s.qa").alias("qa"))).alias("states"))
    later = F.slice("all", 2, F.greatest(F.size("all") - 1, F.lit(0)))
    en = F.aggregate(later, F.element_at("all", 1)["en"], lambda have, x: append_missing(have, x["en"]))
    rewritten = F.exists("states", lambda x: (x["n"] > F.col("n")) & (x["qa"] == "llm_fixed"))
    one = F.col("s").withField("en", F.when(F.size(en) > 0, en)).withField("qa", F.when(rewritten, F.lit("llm_fixed")).otherwise(F.col("s.qa")))
    whole = group.select("id", "n", one.alias("s"), (F.col("k") - 1).alias("extra"))
    return whole.groupBy("id").agg(F.transform(F.array_sort(F.collect_list(F.struct("n", "s"))), lambda x: x["s"]).alias("senses"), F.sum("extra").alias("merged"))


def assemble(base: DataFrame, glosses: DataFrame, repaired: DataFrame, overrides: DataFrame, counts: DataFrame | None = None, allow_missing: bool = False) -> DataFrame:
    """Native rows. Stops on overrides that meet nothing and, unless allowed, on senses
    without a text; rows left without senses are dropped."""
    senses = filled_senses(base, glosses, repaired, overrides)
    stale = overrides.join(senses.where("used").select("word", "pinyin", F.col("n").alias("sense")), ["word", "pinyin", "sense"], "left_anti")
    if not stale.isEmpty():
        raise AssembleError(f"overrides that meet nothing: {[tuple(r) for r in stale.select('word', 'pinyin', 'sense').orderBy('word').limit(20).collect()]}")
    lacking = senses.where(F.col("s.ja").isNull())
    if not allow_missing and not lacking.isEmpty():
        raise AssembleError(f"senses without a text: {[tuple(r) for r in lacking.select('id', 'n').orderBy('id', 'n').limit(20).collect()]}")
    done = base.drop("senses", "seed_gloss").join(collapsed(senses.where(F.col("s.ja").isNotNull())), "id").drop("merged")
    if counts is None:
        moe = done.withColumn("moe", F.lit(None).cast("string"))
    else:
        title = counts.select(F.col("title").alias("__title"), "definitions")
        moe = done.join(title, F.coalesce("trad", "word") == F.col("__title"), "left")
        enough = F.col("definitions") >= F.size("senses")
        moe = moe.withColumn("moe", verdict(F.when(F.col("definitions").isNotNull(), F.when(enough, 1).otherwise(0)))).drop("__title", "definitions")
    rest = [c for c in ("word", "trad", "pinyin", "tw_pr", "also_pr", "cl", "hsk2", "hsk3", "pos", "src", "seed", "moe")]
    return moe.select(*rest, F.lit(None).cast("int").alias("primary"), F.lit(None).cast("boolean").alias("default"), "senses", "ord")


def with_line_numbers(native: DataFrame) -> DataFrame:
    """Rows renumbered from 1 without gaps, in their order, within one window of counts."""
    from lexiflow.operators.ordering import global_ordinal

    return global_ordinal(native, "ord", name="line").drop("ord").withColumnRenamed("line", "ord")


