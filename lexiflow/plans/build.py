"""From sources to base rows: parse, derive, match, supplement, order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from lexiflow.functions import readings
from lexiflow.operators import matching as M
from lexiflow.operators import ordering as O
from lexiflow.schemas import DICTIONARY_NAME, REF, SENSE

# Texts of senses that are references only.
DERIVED = {"variant": "の異体字", "old": "の旧字体", "erhua": "の儿化形", "see": "に同じ", "see_also": "も参照", "abbr": "の略", "used_in": "に使われる字"}

to_marks = readings.column(readings.to_marks)
reading_key = readings.column(readings.key)
toneless_key = readings.column(readings.toneless_key)
sandhi_key = readings.column(readings.sandhi_key)
heard_sandhi_key = readings.column(readings.heard_sandhi_key)
sandhi_first = readings.column(readings.starts_with_sandhi, BooleanType())


def marked_map(df: DataFrame, texts: Column) -> DataFrame:
    """Adds `__marks`: a map from the numbered readings of an array to tone-marked ones.
    The Python function sees one joined string a row, not one call an element."""
    joined = F.array_join(F.array_distinct(F.array_compact(texts)), "\n")
    each = readings.column(lambda t: "\n".join(map(readings.to_marks, t.split("\n"))))
    keys, values = F.split(joined, "\n"), F.split(each(joined), "\n")
    return df.withColumn("__marks", F.map_from_arrays(keys, values))


def derived_text(sense: Column, marks: Column) -> Column:
    """The text of a sense without one: its variants, else its references, with readings,
    joined and followed by what the first one's kind says; null if it has none."""
    templates = F.create_map(*(F.lit(x) for kv in DERIVED.items() for x in kv))
    label = lambda r: F.when(r["py"].isNull(), r["w"]).otherwise(F.concat(r["w"], F.lit("（"), F.element_at(marks, r["py"]), F.lit("）")))
    refs = F.when(F.size(sense["variant_of"]) > 0, sense["variant_of"]).when(F.size(sense["see_also"]) > 0, sense["see_also"])
    text = F.concat(F.array_join(F.transform(refs, label), "・"), F.element_at(templates, F.get(refs, F.lit(0))["kind"]))
    return F.when((F.size(sense["en"]) == 0) & refs.isNotNull(), text)


def filled(values: Column) -> Column:
    return F.when(F.size(values) > 0, values)


def skeleton(parsed: DataFrame) -> DataFrame:
    """Base rows of parsed lines, with the keys that other sources are matched by."""
    numbered = parsed.repartitionByRange("ord").sortWithinPartitions("ord")
    numbered = O.global_ordinal(numbered, "ord", name="n")
    refs = F.flatten(F.transform("senses", lambda s: F.concat(s["variant_of"], s["see_also"])))
    wanted = F.concat(F.transform(refs, lambda r: r["py"]), F.array("pinyin", "tw_pr", "also_pr"))
    rows = marked_map(numbered, wanted)
    marks = F.col("__marks")

    def sense(s: Column) -> Column:
        text = derived_text(s, marks)
        return F.struct(
            filled(s["en"]).alias("en"), text.alias("ja"), F.when(text.isNotNull(), "derived").alias("qa"), F.lit(None).cast("boolean").alias("unsure"), filled(s["misc"]).alias("misc"),
            filled(s["variant_of"]).alias("variant_of"), filled(s["see_also"]).alias("see_also"), filled(s["lsource"]).alias("lsource"), filled(s["s_inf"]).alias("s_inf"),
        )

    return rows.select(
        F.concat(F.lit("c"), F.col("n").cast("string")).alias("id"),
        F.col("simp").alias("word"),
        F.when(F.col("trad") != F.col("simp"), F.col("trad")).alias("trad"),
        F.element_at("__marks", F.col("pinyin")).alias("pinyin"),
        *(F.when(F.col(c).isNotNull(), F.element_at("__marks", F.col(c))).alias(c) for c in ("tw_pr", "also_pr")),
        filled(F.col("cl")).alias("cl"),
        F.transform("senses", sense).alias("senses"),
        F.col("n").alias("ord"),
        F.col("trad").alias("__trad"),
        F.col("pinyin").alias("__numbered"),
        reading_key("pinyin").alias("__key"),
        sandhi_key("pinyin").alias("__sandhi"),
        sandhi_first("pinyin").alias("__free"),
    )


def with_levels(rows: DataFrame, hsk: DataFrame) -> DataFrame:
    """Levels and parts of speech of a word go to all its rows, whichever spelling meets
    it; of several words that meet a row, each field takes the last that has it."""
    index = M.spelling_index(rows.select("id", "word", "__trad"), [F.col("word"), F.col("__trad")]).select("id", "spelling")
    met = index.join(hsk.withColumnRenamed("word", "spelling"), "spelling")
    found = O.last_value_per_key(met, ["id"], ["hsk2", "hsk3", "pos"], "ord")
    return rows.join(found, "id", "left")


def match_legacy(rows: DataFrame, legacy: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(legacy rows with the base ids they match and the tier, legacy rows without a
    match). Tier 1: spelling and reading; tier 2: the tone of a first yi or bu aside."""
    index = M.spelling_index(rows.select("id", "word", "__trad", "__key", "__sandhi", "__free"), [F.col("word"), F.col("__trad")])
    index = index.select("id", "spelling", "__key", F.when(F.col("__free"), F.col("__sandhi")).alias("__sandhi"))
    old = legacy.withColumn("__old_key", reading_key("pinyin")).withColumn("__old_sandhi", heard_sandhi_key("pinyin"))
    exact = ([F.col("word"), F.col("__old_key")], [F.col("spelling"), F.col("__key")])
    sandhi = ([F.col("word"), F.col("__old_sandhi")], [F.col("spelling"), F.col("__sandhi")])
    found = M.tiered_match(old, index, "ord", [exact, sandhi])
    return found, M.unmatched(legacy, found, "ord")


def uncovered(native: DataFrame, legacy: DataFrame) -> DataFrame:
    """The legacy rows (ord, word, pinyin) that no native row stands for, in either
    spelling: with the same reading, or one that differs in the tone of a first yi or bu."""
    rows = native.withColumn("__k", reading_key("pinyin")).withColumn("__s", F.when(sandhi_first("pinyin"), sandhi_key("pinyin")))
    index = M.spelling_index(rows.select("word", "trad", "__k", "__s"), [F.col("word"), F.col("trad")]).select("spelling", "__k", "__s").distinct()
    old = legacy.withColumn("__reading", F.coalesce("pinyin", F.lit(""))).withColumn("__old_key", reading_key("__reading")).withColumn("__old_sandhi", heard_sandhi_key("__reading"))
    exact = ([F.col("word"), F.col("__old_key")], [F.col("spelling"), F.col("__k")])
    sandhi = ([F.col("word"), F.col("__old_sandhi")], [F.col("spelling"), F.col("__s")])
    return M.unmatched(legacy, M.tiered_match(old, index, "ord", [exact, sandhi]), "ord")


def seeds(matched: DataFrame) -> DataFrame:
    """(id, seed_gloss, seed): the glosses of all legacy rows of a base row, each once, in
    order; the review state of the last one."""
    none = F.array().cast("array<string>")
    rows = matched.select("id", "ord", "qa", F.coalesce("gloss", none).alias("gloss"))
    return M.ordered_union(rows, ["id"], "gloss", "ord", "seed_gloss").join(rows.groupBy("id").agg(F.max_by("qa", "ord").alias("seed")), "id")


def supplement(rest: DataFrame, rows: DataFrame, hsk: DataFrame) -> DataFrame:
    """Base rows of legacy rows that match nothing. A traditional headword takes the
    simplified one of the first row that is written so; levels of the source win."""
    forms = rows.where("__trad <> word").select(F.col("__trad").alias("word"), F.col("word").alias("__simple"), F.col("ord").alias("__at"))
    known = M.first_match(rest, forms, "word", "__at", ["__simple"])
    gloss = F.filter(F.coalesce("gloss", F.array().cast("array<string>")), lambda g: F.coalesce(g, F.lit("")) != "")
    word = F.coalesce("__simple", "word")
    given = F.get("trad", F.lit(0))
    trad = F.when(F.col("__simple").isNotNull(), F.col("word")).when(given != word, given)
    some = F.size(gloss) > 0
    fields = {"ja": F.when(some, F.array_join(gloss, "、")), "qa": F.when(some, F.col("qa")), "unsure": F.when(some & F.coalesce("unsure", F.lit(False)), True)}
    empty = {"en": "array<string>", "misc": "array<string>", "variant_of": f"array<{REF}>", "see_also": f"array<{REF}>", "lsource": "array<string>", "s_inf": "array<string>"}
    order = ("en", "ja", "qa", "unsure", "misc", "variant_of", "see_also", "lsource", "s_inf")
    sense = F.struct(*((fields[n] if n in fields else F.lit(None).cast(empty[n])).alias(n) for n in order))
    base = known.select(F.concat(F.lit("x"), F.col("ord").cast("string")).alias("id"), word.alias("word"), trad.alias("trad"), "pinyin", F.lit(DICTIONARY_NAME).alias("src"), F.array(sense).cast(f"array<{SENSE}>").alias("senses"), "ord", "hsk2", "hsk3", "pos")
    levels = hsk.select("word", *(F.col(c).alias(f"__{c}") for c in ("hsk2", "hsk3", "pos")))
    return base.join(levels, "word", "left").withColumns({c: F.coalesce(f"__{c}", c) for c in ("hsk2", "hsk3", "pos")}).drop("__hsk2", "__hsk3", "__pos")


COLUMNS = ("id", "word", "trad", "pinyin", "tw_pr", "also_pr", "cl", "hsk2", "hsk3", "pos", "src", "seed", "seed_gloss", "senses", "ord")


def build_base(parsed: DataFrame, hsk: DataFrame, legacy: DataFrame) -> DataFrame:
    """The base: the skeleton in file order, then the supplement in the legacy order."""
    rows = skeleton(parsed)
    found, rest = match_legacy(rows, legacy)
    main = with_levels(rows, hsk).join(seeds(found), "id", "left")
    more = supplement(rest, rows, hsk)
    both = main.withColumn("__part", F.lit(0)).unionByName(more.withColumn("__part", F.lit(1)), allowMissingColumns=True)
    return O.global_ordinal(both.drop("n"), "__part", "ord", name="place").drop("ord").withColumnRenamed("place", "ord").select(*COLUMNS)


def generation_plan(base: DataFrame, freq: DataFrame) -> DataFrame:
    """(id, word, senses, position): rows that need texts, in the order to ask for them."""
    need = F.size(F.filter("senses", lambda s: s["ja"].isNull()))
    rows = base.select("id", "word", "hsk2", "hsk3", need.alias("senses")).where("senses > 0").join(freq, "word", "left")
    level = F.coalesce(F.col("hsk2"), F.lit(0)).cast("boolean") | F.coalesce(F.col("hsk3"), F.lit(0)).cast("boolean")
    return O.global_ordinal(rows, *O.generation_order(level, F.col("freq"), "id"), name="position").select("id", "word", "senses", "position")
