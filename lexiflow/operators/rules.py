"""Validation rules: violations as rows (path, line, word, kind, detail).

Row rules are columns over typed rows, group rules are windows; all of them give
the same five columns, so they are unioned, counted and reported together.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexiflow.functions import text as T
from lexiflow.operators.matching import spelling_index
from lexiflow.schemas import DICTIONARY_NAME

# The closed sets of the native format.
QA = ("machine_backed", "llm_ok", "llm_fixed", "human_reviewed", "unchecked", "derived", "hand_fixed")
SEED = QA[:5]
MOE = ("full", "headword", "none")
MISC = tuple("coll written fig dial tw hk cantonese loan slang net idiom proverb old arch onom bound derog honor polite humble vulgar euph joc neo formal".split())
POS = tuple("Mg Rg a ad an b c cc d e f g h k l m mq n nr ns nt nz o p q qt qv r s t tg u v vn y z".split())
VARIANT_KINDS, XREF_KINDS = ("variant", "old", "erhua"), ("see", "see_also", "abbr", "used_in")
ENTRY_REQUIRED, SENSE_REQUIRED = ("word", "pinyin", "senses"), ("ja", "qa")
ENTRY_OPTIONAL = ("trad", "tw_pr", "also_pr", "cl", "hsk2", "hsk3", "pos", "src", "seed", "moe", "primary", "default")
SENSE_OPTIONAL = ("en", "unsure", "misc", "variant_of", "see_also", "lsource", "s_inf")
RETIRED = ("hsk", "gloss", "reading_pos", "alt_pinyin")
REF_KEYS, CANDIDATE_KEYS, REVERSE_KEYS = ("w", "t", "py"), ("s", "pinyin"), ("word", "zh", "unsure")
MANIFEST_KEYS, SCHEMA_VERSION = ("schema_version", "generated", "files", "sources"), 3
LIMITS = {"short": 24, "reused": 80, "derived": 200}
LEVELS = {"hsk2": (1, 6), "hsk3": (1, 7)}
# What a reading may hold.
READING_LETTERS = "a-zA-ZāáǎàēéěèīíǐìōóǒòūúǔùǖǘǚǜüêḿńňǹĀÁǍÀĒÉĚÈĪÍǏÌŌÓǑÒŪÚǓÙǕǗǙǛÜÊŃŇǸ\\x{0300}\\x{0301}\\x{0304}\\x{030C}"
READING_SIGNS = " '.,()（）／，…·βθ0-9\\-"
READING_NUMBERS = ("F1",)


def violation(path: str, line: Column, word: Column, kind: Column, detail: Column) -> list[Column]:
    return [F.lit(path).alias("path"), line.cast("bigint").alias("line"), word.cast("string").alias("word"), kind.alias("kind"), detail.cast("string").alias("detail")]


def when(condition: Column, kind: str, detail: Column | str) -> Column:
    """One rule: a (kind, detail) where the condition holds, else null."""
    return F.when(condition, F.struct(F.lit(kind).alias("kind"), (F.lit(detail) if isinstance(detail, str) else detail).cast("string").alias("detail")))


def explode_rules(df: DataFrame, path: str, line: str, word: str, rules: list[Column], lists: list[Column] = ()) -> DataFrame:
    """A row for each rule a row breaks; `lists` are arrays of (kind, detail)."""
    found = F.array_compact(F.array(*rules)) if rules else F.array().cast("array<struct<kind: string, detail: string>>")
    for more in lists:
        found = F.concat(found, F.coalesce(more, nothing()))
    return df.select(F.col(line).alias("__l"), F.col(word).alias("__w"), F.explode(found).alias("v")).select(*violation(path, F.col("__l"), F.col("__w"), F.col("v.kind"), F.col("v.detail")))


def tokens_of(allowed: list[str]) -> Column:
    return F.array(*(F.lit(t) for t in allowed)).cast("array<string>")


def text_rules(field: str, value: Column, allowed_latin: Column) -> Column:
    """The (kind, detail) of a text, whatever its language; each unknown Latin word counts."""
    foreign = F.transform(T.without(T.latin_tokens(value), allowed_latin), lambda t: F.struct(F.lit("foreign-latin").alias("kind"), t.alias("detail")))
    rules = [when(value == "", "empty-string", field), when((value != "") & T.has_edge_space(value), "whitespace", field), when(T.has(value, T.CYRILLIC), "cyrillic", field)]
    return F.concat(F.array_compact(F.array(*rules)), F.coalesce(foreign, nothing()))


def nothing() -> Column:
    return F.array().cast("array<struct<kind: string, detail: string>>")


def reading_rules(field: str, value: Column | None = None) -> list[Column]:
    """What a reading may not be: empty, with space at its ends, with other characters,
    with digits inside letters (but for known ones), or with a colon after a u."""
    value = F.col(field) if value is None else value
    runs = F.regexp_extract_all(value, F.lit("([A-Za-z0-9]+)"), F.lit(1))
    odd = F.exists(runs, lambda r: r.rlike("[0-9]") & ~r.rlike("^[0-9]+$") & ~r.isin(*READING_NUMBERS))
    other = value.rlike(f"[^{READING_LETTERS}{READING_SIGNS}:]") | value.rlike("[uU]:")
    return [when(value == "", "empty-pinyin", field), when((value != "") & T.has_edge_space(value), "whitespace", field), when(odd | other, "bad-pinyin", field)]


def array_rules(field: str, value: Column, allowed: tuple[str, ...] | None = None) -> list[Column]:
    rules = [
        when(F.size(value) == 0, "empty-array", field),
        when(F.exists(value, lambda x: x.isNull() | (x == "")), "bad-type", field),
        when(F.exists(value, lambda x: (x != "") & T.has_edge_space(x)), "whitespace", field),
        when(F.size(F.array_distinct(value)) < F.size(value), "duplicate-item", field),
    ]
    if allowed:
        rules.append(when(F.exists(value, lambda x: ~x.isin(*allowed)), "unknown-value", field))
    return rules


def reference_rules(field: str, value: Column, kinds: tuple[str, ...] | None) -> list[Column]:
    rules = [
        when(F.size(value) == 0, "bad-type", field),
        when(F.exists(value, lambda r: r["w"].isNull() | (r["w"] == "") | (r["t"] == "") | (r["py"] == "")), "bad-type", field),
        when(F.exists(value, lambda r: F.coalesce(r["w"].contains(" "), F.lit(False)) | F.coalesce(r["t"].contains(" "), F.lit(False))), "text-in-ref", field),
        when(F.exists(value, lambda r: r["t"] == r["w"]), "redundant-trad", field),
    ]
    if kinds:
        rules.append(when(F.exists(value, lambda r: r["kind"].isNull() | ~r["kind"].isin(*kinds)), "bad-kind", field))
    return rules


def sense_rules(sense: Column, allowed_latin: Column) -> Column:
    """The (kind, detail) a sense breaks. A translation's limit follows its origin; only
    derived ones may hold readings, and Latin words only if they are allowed."""
    ja, qa = sense["ja"], sense["qa"]
    limit = F.when(qa.isin("llm_ok", "llm_fixed", "hand_fixed"), LIMITS["short"]).when(qa == "derived", LIMITS["derived"]).otherwise(LIMITS["reused"])
    english = T.english_tokens(F.coalesce(sense["en"], F.array().cast("array<string>")))
    bad = T.first_failure(ja, limit, allowed_latin, english, F.coalesce(qa == "derived", F.lit(False)))
    rules = [
        when(ja.isNull(), "missing-key", "ja"),
        when(qa.isNull(), "missing-key", "qa"),
        when(~qa.isin(*QA), "bad-qa", qa),
        when(ja.isNotNull() & bad.isNotNull(), "bad-ja", bad),
        when(~sense["unsure"], "explicit-false", "unsure"),
        *array_rules("en", sense["en"]),
        *array_rules("misc", sense["misc"], MISC),
        *array_rules("lsource", sense["lsource"]),
        *array_rules("s_inf", sense["s_inf"]),
        *reference_rules("variant_of", sense["variant_of"], VARIANT_KINDS),
        *reference_rules("see_also", sense["see_also"], XREF_KINDS),
    ]
    return F.array_compact(F.array(*rules))


def native_violations(df: DataFrame, path: str = "entries", allowed_latin: list[str] = (), line: str = "ord") -> DataFrame:
    """All violations of native rows: by row, by sense and by group."""
    allowed = tokens_of(allowed_latin)
    senses, primary = F.col("senses"), F.col("primary")
    rules = [
        *(when(F.col(k).isNull(), "missing-key", k) for k in ENTRY_REQUIRED),
        when(F.col("word") == "", "bad-word", "word"),
        when(T.has_edge_space(F.col("word")), "whitespace", "word"),
        *(when(~F.col(k).between(*v), "bad-hsk", k) for k, v in LEVELS.items()),
        *(r for f in ("pinyin", "tw_pr", "also_pr") for r in reading_rules(f)),
        when(F.col("trad") == "", "bad-type", "trad"),
        when(F.col("trad") == F.col("word"), "redundant-trad", "trad"),
        *array_rules("pos", F.col("pos"), POS),
        *reference_rules("cl", F.col("cl"), None),
        when(~F.col("src").isin(DICTIONARY_NAME), "unknown-value", "src"),
        when(~F.col("seed").isin(*SEED), "unknown-value", "seed"),
        when(~F.col("moe").isin(*MOE), "unknown-value", "moe"),
        when(F.size(senses) == 0, "bad-type", "senses"),
        when((F.size(senses) >= 2) & primary.isNull(), "missing-primary", "primary"),
        when(primary.isNotNull() & ~(primary.between(1, F.size(senses)) & (F.size(senses) >= 2)), "bad-primary", primary),
        when(~F.col("default"), "bad-default", "default"),
    ]
    by_row = explode_rules(df, path, line, "word", rules, [F.flatten(F.transform(senses, lambda s: sense_rules(s, allowed)))])
    key = [F.col("word"), F.col("trad"), F.regexp_replace("pinyin", "[ ']", "")]
    keyed = df.where("word <> '' and pinyin <> ''").select(F.col(line).alias("l"), F.col("word").alias("w"), F.struct(*key).alias("k"))
    first = F.min("l").over(Window.partitionBy("k"))
    repeated = keyed.withColumn("first", first).where("l > first").select(*violation(path, F.col("l"), F.col("w"), F.lit("duplicate-entry"), F.col("first")))
    words = df.where(F.col("word").isNotNull()).groupBy("word").agg(F.count("*").alias("n"), F.count_if("default").alias("d"), F.min(line).alias("l"))
    kind = F.when((F.col("n") >= 2) & (F.col("d") == 0), "missing-default").when(F.col("d") > 1, "duplicate-default")
    defaults = words.withColumn("kind", kind).where("kind is not null").select(*violation(path, F.col("l"), F.col("word"), F.col("kind"), F.col("d")))
    return by_row.unionByName(repeated).unionByName(defaults)


def reverse_violations(df: DataFrame, path: str = "glosses", line: str = "ord", allowed_latin: list[str] = (), allowed_kana: list[str] = ()) -> DataFrame:
    """Violations of rows of the other direction (word, zh array of (s, pinyin), unsure)."""
    zh, kana, latin = F.col("zh"), tokens_of(allowed_kana), tokens_of(allowed_latin)

    def candidate(z: Column) -> Column:
        text = z["s"]
        rules = [
            when(text.isNull(), "missing-key", "s"),
            when(T.has(text, T.KANA) & ~F.array_contains(kana, text), "kana-in-chinese", text),
            when((text != "") & ~T.has(text, T.HAN + T.LATIN + T.DIGITS), "no-han", text),
            when(z["pinyin"].isNull(), "missing-key", "pinyin"),
            *reading_rules("pinyin", z["pinyin"]),
        ]
        return F.concat(F.array_compact(F.array(*rules)), F.when(text.isNull(), nothing()).otherwise(text_rules("s", text, latin)))

    rules = [
        when(F.col("word").isNull() | (F.col("word") == ""), "bad-word", "word"),
        when(T.has_edge_space(F.col("word")), "whitespace", "word"),
        when(zh.isNull(), "missing-key", "zh"),
        when((F.size(zh) == 0) & ~F.coalesce("unsure", F.lit(False)), "empty-without-unsure", "zh"),
        when(F.size(F.array_distinct(F.transform(zh, lambda z: z["s"]))) < F.size(zh), "duplicate-candidate", "zh"),
        when(~F.col("unsure"), "explicit-false", "unsure"),
    ]
    by_row = explode_rules(df, path, line, "word", rules, [F.flatten(F.transform(zh, candidate))])
    first = F.min(line).over(Window.partitionBy("word"))
    repeated = df.where("word <> ''").withColumn("first", first).where(F.col(line) > F.col("first")).select(*violation(path, F.col(line), F.col("word"), F.lit("duplicate-word"), F.col("first")))
    return by_row.unionByName(repeated)


def named(names: Column, kind: str, prefix: str = "") -> Column:
    """A (kind, detail) for each of the names."""
    return F.transform(names, lambda k: F.struct(F.lit(kind).alias("kind"), F.concat(F.lit(prefix), k).alias("detail")))


def keys_of(names: tuple[str, ...]) -> Column:
    return F.array(*(F.lit(k) for k in names))


def key_rules(keys: Column, required: tuple[str, ...], known: tuple[str, ...], prefix: str = "") -> Column:
    """Keys that an object lacks, or has though nothing knows them."""
    return F.concat(named(F.array_except(keys_of(required), keys), "missing-key", prefix), named(F.array_except(keys, keys_of(known)), "unknown-key", prefix))


def type_of(value: Column, path: str) -> Column:
    """The type of a field of raw JSON, null where there is no such field."""
    return F.schema_of_variant(F.try_variant_get(value, path, "variant"))


def key_violations(raw: DataFrame, path: str = "entries", line: str = "line", value: str = "value") -> DataFrame:
    """Keys and types that a raw JSON line of entries may not have, down to its senses and
    references: keys that are unknown, missing or retired, and values of another type."""
    v = F.try_parse_json(F.col(value))
    object_ = "map<string, string>"
    entry = F.from_json(value, object_)
    keys = F.map_keys(entry)
    senses = F.from_json(F.element_at(entry, "senses"), f"array<{object_}>")
    none = F.array().cast("array<string>")

    def references(holder: Column, field: str, known: tuple[str, ...]) -> Column:
        refs = F.from_json(F.element_at(holder, field), f"array<{object_}>")
        return F.coalesce(F.flatten(F.transform(refs, lambda r: named(F.array_except(F.map_keys(r), keys_of(known)), "unknown-key", f"{field}."))), nothing())

    def sense(s: Column) -> Column:
        own = key_rules(F.map_keys(s), SENSE_REQUIRED, (*SENSE_REQUIRED, *SENSE_OPTIONAL), "senses.")
        return F.concat(own, *(references(s, f, (*REF_KEYS, "kind")) for f in ("variant_of", "see_also")))

    def typed(s: Column) -> Column:
        kind = lambda k: type_of(s, f"$.{k}")
        lists = [when(~kind(k).startswith("ARRAY"), "bad-type", f"senses.{k}") for k in ("en", "misc", "variant_of", "see_also", "lsource", "s_inf")]
        return F.array_compact(F.array(when(kind("ja") != "STRING", "bad-ja", "senses.ja"), when(kind("qa") != "STRING", "bad-qa", "senses.qa"), when(kind("unsure") != "BOOLEAN", "explicit-false", "senses.unsure"), *lists))

    kind = lambda k: type_of(v, f"$.{k}")
    rules = [
        when(kind("word") != "STRING", "bad-word", "word"),
        *(when(kind(k) != "STRING", "bad-type", k) for k in ("trad", "pinyin", "tw_pr", "also_pr")),
        *(when(kind(k) != "STRING", "unknown-value", k) for k in ("src", "seed", "moe")),
        *(when(~kind(k).startswith("ARRAY"), "bad-type", k) for k in ("pos", "cl")),
        when(~kind("senses").startswith("ARRAY<OBJECT") & (kind("senses") != "ARRAY<VOID>"), "bad-type", "senses"),
        when(kind("primary") != "BIGINT", "bad-primary", "primary"),
        when(kind("default") != "BOOLEAN", "bad-default", "default"),
        *(when(kind(k) != "BIGINT", "bad-hsk", k) for k in LEVELS),
    ]
    lists = [
        key_rules(keys, ENTRY_REQUIRED, (*ENTRY_REQUIRED, *ENTRY_OPTIONAL, *RETIRED)),
        named(F.array_intersect(F.coalesce(keys, none), keys_of(RETIRED)), "retired-key"),
        references(entry, "cl", REF_KEYS),
        F.flatten(F.transform(senses, sense)),
        F.flatten(F.transform(F.try_variant_get(v, "$.senses", "array<variant>"), typed)),
    ]
    return explode_rules(raw.withColumn("__word", F.get_json_object(value, "$.word")), path, line, "__word", rules, lists)


def reverse_key_violations(raw: DataFrame, path: str = "glosses", line: str = "line", value: str = "value") -> DataFrame:
    """The same for raw lines of the other direction."""
    object_ = "map<string, string>"
    entry, v = F.from_json(value, object_), F.try_parse_json(F.col(value))
    candidates = F.from_json(F.element_at(entry, "zh"), f"array<{object_}>")
    lists = [
        key_rules(F.map_keys(entry), ("word", "zh"), REVERSE_KEYS),
        F.flatten(F.transform(candidates, lambda c: named(F.array_except(F.map_keys(c), keys_of(CANDIDATE_KEYS)), "unknown-key", "zh."))),
    ]
    kind = lambda k: type_of(v, f"$.{k}")
    rules = [
        when(kind("word") != "STRING", "bad-word", "word"),
        when(~kind("zh").startswith("ARRAY<OBJECT") & (kind("zh") != "ARRAY<VOID>"), "bad-type", "zh"),
        when(kind("unsure") != "BOOLEAN", "explicit-false", "unsure"),
    ]
    return explode_rules(raw.withColumn("__word", F.get_json_object(value, "$.word")), path, line, "__word", rules, lists)


def archive_violations(container: DataFrame, path: str = "entries") -> DataFrame:
    """What a container that was read permissively says of its damage."""
    return container.where("error is not null").select(*violation(path, F.lit(0), F.lit(None), F.lit("broken-archive"), F.col("error")))


# --- rules across sources ----------------------------------------------------------------


def coverage_violations(missing: DataFrame, path: str = "entries") -> DataFrame:
    """Earlier rows (word, pinyin) that no entry stands for."""
    return missing.select(*violation(path, F.lit(0), F.col("word"), F.lit("existing-not-covered"), F.concat_ws(" ", "word", "pinyin")))


def level_violations(native: DataFrame, seed: DataFrame, path: str = "entries") -> DataFrame:
    """Words of a seed (word, hsk2, hsk3) that no entry has in either spelling, and entries
    of such a word without its level: every entry of a word keeps it."""
    index = spelling_index(native.select("word", "trad", "pinyin", *LEVELS), [F.col("word"), F.col("trad")])
    own = [F.col(k).alias(f"__{k}") for k in LEVELS]
    wanted = seed.select(F.col("word").alias("spelling"), *own)
    lost = wanted.join(index, "spelling", "left_anti").select(*violation(path, F.lit(0), F.col("spelling"), F.lit("hsk-word-missing"), F.lit("word")))
    rules = [when(F.col(f"__{k}").isNotNull() & ~F.col(k).eqNullSafe(F.col(f"__{k}")), "hsk-not-kept", F.concat(F.lit(f"{k} of "), F.coalesce("pinyin", F.lit("")))) for k in LEVELS]
    met = wanted.join(index.drop("word"), "spelling").withColumn("__line", F.lit(0))
    return lost.unionByName(explode_rules(met, path, "__line", "spelling", rules))


def skeleton_violations(native: DataFrame, expected: int, path: str = "entries") -> DataFrame:
    """Whether there are as many skeleton rows as the source has entries."""
    n = native.where("src is null").agg(F.count("*").alias("n"))
    return n.where(F.col("n") != expected).select(*violation(path, F.lit(0), F.lit(None), F.lit("skeleton-count-mismatch"), F.concat_ws(" ", F.col("n").cast("string"), F.lit(f"of {expected}"))))


# --- rules of the manifest ---------------------------------------------------------------


def manifest_violations(text: str | None, lines: dict[str, int], counts: dict[str, dict[str, int]], sources: dict, there: Callable[[str], bool] = lambda name: False, retired: tuple[str, ...] = (), name: str = "manifest.json") -> list[tuple]:
    """(path, line, word, kind, detail) of a manifest's text, None if there is none. `lines`
    has the files that must stand in it with their true numbers of lines, `counts` the
    numbers that some of them must state, `there` tells whether a retired file is left."""
    found: list[tuple] = [(name, 0, None, "retired-file", f) for f in retired if there(f)]
    add = lambda kind, detail: found.append((name, 0, None, kind, str(detail)))
    if text is None:
        add("missing-manifest", name)
        return found
    try:
        held = json.loads(text)
    except json.JSONDecodeError as error:
        add("broken-json", error)
        return found
    if not isinstance(held, dict):
        add("bad-type", "the manifest is no object")
        return found
    for key in MANIFEST_KEYS:
        if key not in held:
            add("missing-key", key)
    if "generated" in held and not (isinstance(held["generated"], str) and held["generated"]):
        add("bad-type", "generated")
    if type(held.get("schema_version")) is not int or held["schema_version"] != SCHEMA_VERSION:
        add("bad-schema-version", held.get("schema_version"))
    if "sources" in held and held["sources"] != sources:
        add("sources-mismatch", "sources")
    files = held.get("files")
    if not isinstance(files, dict):
        add("bad-type", "files")
        return found
    for file, actual in lines.items():
        stated = files.get(file)
        if stated is None:
            add("missing-key", file)
            continue
        if not isinstance(stated, dict):
            add("bad-type", file)
            continue
        if "lines" not in stated:
            add("missing-key", f"{file}: lines")
        elif stated["lines"] != actual:
            add("line-count-mismatch", f"{file}: {stated['lines']!r} of {actual}")
        for key, value in counts.get(file, {}).items():
            if key not in stated:
                add("missing-key", f"{file}: {key}")
            elif stated[key] != value:
                add("count-mismatch", f"{file}: {key} {stated[key]!r} of {value}")
    for file in sorted(set(files) - set(lines)):
        add("unknown-file", file)
    return found


def summary(violations: DataFrame, most: int = 3) -> DataFrame:
    """(kind, n, examples): kinds with their counts and the lines of the first ones."""
    rank = F.row_number().over(Window.partitionBy("kind").orderBy("line", "detail"))
    few = violations.withColumn("r", rank).where(F.col("r") <= most).groupBy("kind").agg(F.array_sort(F.collect_list("line")).alias("examples"))
    return violations.groupBy("kind").agg(F.count("*").alias("n")).join(few, "kind", "left").orderBy(F.desc("n"), "kind")


def report(violations: DataFrame, most: int = 200) -> list[str]:
    """A text report: how many violations, by kind, the most frequent first, and the first
    of them in the order of files and lines."""
    kinds = [(r["kind"], r["n"]) for r in violations.groupBy("kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind").collect()]
    total = sum(n for _, n in kinds)
    first = violations.orderBy("path", "line", "kind", "detail").limit(most).collect() if total else []
    lines = [f"{r['path']}:{r['line'] or 0}: {r['kind']}: {r['word'] or '-'}: {r['detail']}" for r in first]
    rest = [f"... and {total - len(lines)} more"] if total > len(lines) else []
    return [f"{total} violations", *(f"  {kind:<26} {n:>9,}" for kind, n in kinds), *lines, *rest]


def native_counts(df: DataFrame) -> dict[str, int]:
    """Rows, skeleton and supplement, senses, and rows with each attribute, in one pass."""
    names = [c for c in df.columns if c not in ("word", "pinyin", "senses", "ord")]
    row = df.agg(
        F.count("*").alias("entries"),
        F.count_if(F.col("src").isNull()).alias("skeleton"),
        F.count_if(F.col("src").isNotNull()).alias("supplement"),
        F.coalesce(F.sum(F.size("senses")), F.lit(0)).alias("senses"),
        *(F.count_if(F.col(c).isNotNull()).alias(f"with_{c}") for c in names),
    ).first()
    return row.asDict()
