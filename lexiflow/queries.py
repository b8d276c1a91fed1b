"""Registry of the engine's queries over the driver's tables, with their SQL twins."""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiflow import schemas as S
from lexiflow.functions import text as T
from lexiflow.operators import chunking as K
from lexiflow.operators import common_format as C
from lexiflow.operators import differences as D
from lexiflow.operators import matching as M
from lexiflow.operators import ordering as O
from lexiflow.operators import patches as P
from lexiflow.operators import rules as R
from lexiflow.operators import running as N
from lexiflow.operators import shared as V
from lexiflow.operators.source_lines import parse_lines
from lexiflow.plans import assemble as Z
from lexiflow.plans import build as B
from lexiflow.plans import inference as I
from lexiflow.session import materialise, working_folder
from lexiflow.sinks import artifacts as A
from lexiflow.sinks import parts as PT
from lexiflow.sinks import store as ST
from lexiflow.sources.raw_deflate import read_segments, segment_sizes, write_segments
from lexiflow.sources.scans import check_declared, forensic_lines, frequencies, hsk_seed, ids, log_rows, reference_counts, repaired, strict_records, text_lines
from lexiflow.streaming.resume import append_once, follow_log, held

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name, with the SQL for the same rows."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def local_folder(spark: SparkSession) -> Path:
    """A new folder for single files that the driver writes, within the shared folder, which
    has to be mounted on this machine for that; deleted when the driver ends."""
    place = re.sub("^file:(//)?", "", working_folder(spark, "files"))
    if "://" in place:
        raise ValueError(f"single files need a shared folder that is mounted here, not {place}")
    folder = Path(place)
    folder.mkdir(parents=True)
    return folder


def seconds(column: str) -> Column:
    """A time as whole seconds, the nearest, halves to even as SQL's cast of epoch() has it."""
    return F.rint(F.unix_micros(F.col(column).cast("timestamp")) / F.lit(1e6)).cast("bigint")


def cents(column: str) -> Column:
    """A sum of money as a whole number, so that sums do not depend on their order."""
    return F.round(F.col(column) * 100).cast("bigint")


def whole(column: Column) -> Column:
    return column.cast("bigint")


# --- scans, projections, predicates -------------------------------------------------


@query("""SELECT l.quality, l.toxic, d.lang, count(*) AS n_documents, CAST(sum(d.n_chars) AS BIGINT) AS n_chars
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY l.quality, l.toxic, d.lang""")
def counts_by_class(spark: SparkSession, d: str) -> DataFrame:
    """Rows and sizes by class of the joined label."""
    documents = read(spark, d, "documents", "doc_id", "lang", "n_chars")
    return documents.join(read(spark, d, "labels"), "doc_id").groupBy("quality", "toxic", "lang").agg(F.count("*").alias("n_documents"), F.sum("n_chars").alias("n_chars"))


@query("SELECT doc_id, source, n_chars, lang = 'de' AS is_de FROM documents WHERE lang IN ('de', 'fr') AND n_chars >= 1000")
def scan_filter_project(spark: SparkSession, d: str) -> DataFrame:
    """Filter and column choice that reach the scan."""
    df = read(spark, d, "documents").where(F.col("lang").isin("de", "fr") & (F.col("n_chars") >= 1000))
    return df.select("doc_id", "source", "n_chars", (F.col("lang") == "de").alias("is_de"))


@query("""SELECT item_id, len(t) AS n_tokens, len(list_distinct(t)) AS n_distinct, t[1] AS first_token FROM (
SELECT item_id, regexp_extract_all(text, '[A-Za-zªµºÀ-ÖØ-öø-ɏ]+') AS t FROM benchmark)""")
def latin_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Latin tokens of a text."""
    t = read(spark, d, "benchmark").select("item_id", T.latin_tokens(F.col("text")).alias("t"))
    return t.select("item_id", whole(F.size("t")).alias("n_tokens"), whole(F.size(F.array_distinct("t"))).alias("n_distinct"), F.get("t", F.lit(0)).alias("first_token"))


@query("""SELECT lang, count(*) AS n, count(*) FILTER (regexp_matches(text, '[A-Za-zªµºÀ-ÖØ-öø-ɏ]')) AS latin,
count(*) FILTER (regexp_matches(text, '[\\x{0400}-\\x{052F}]')) AS cyrillic, count(*) FILTER (regexp_matches(text, '[\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}]')) AS han,
count(*) FILTER (regexp_matches(text, '[\\x{3041}-\\x{30FF}\\x{31F0}-\\x{31FF}]')) AS kana, count(*) FILTER (regexp_matches(text, '[äöüß]')) AS umlaut FROM documents GROUP BY lang""")
def script_flags(spark: SparkSession, d: str) -> DataFrame:
    """Texts with characters of each script."""
    flags = {"latin": T.LATIN, "cyrillic": T.CYRILLIC, "han": T.HAN, "kana": T.KANA, "umlaut": "äöüß"}
    return read(spark, d, "documents", "lang", "text").groupBy("lang").agg(F.count("*").alias("n"), *(F.count_if(T.has("text", c)).alias(n) for n, c in flags.items()))


# Sample texts with the rule each breaks (allowed: DNA; English words: post)
# and the scripts it has characters of (l atin, c yrillic, h an, k ana).
SAMPLES = [
    ("語", None, "h"), ("11", None, ""), ("DNA", None, "l"), ("・", None, "k"), ("゛あ", None, "k"), ("々", "no-japanese", ""), ("Ԁ語", "cyrillic", "ch"), ("ԯ", "cyrillic", "c"), ("԰", "no-japanese", ""), ("語́", "tone-marks", "h"),
    ("Ō", "latin", "l"), ("Ǎ", "tone-marks", "l"), ("ÀB語", "tone-marks", "lh"), ("post語", "english-left", "lh"), ("odd語", "latin", "lh"), (" 語", "edge-space", "h"), ("", "empty", ""), ("☰", "no-japanese", ""), ("ｱ", "no-japanese", ""), ("長" * 25, "too-long", "h"), ("𠀀", None, "h"),
]
SAMPLES_SQL = ", ".join(f"({n}, '{t}', {'NULL' if f is None else repr(f)}, '{c}')" for n, (t, f, c) in enumerate(SAMPLES))


def sample_of(column: str, samples: list[str]) -> Column:
    """One of the samples for each row, by the remainder of a number."""
    return F.element_at(F.array(*(F.lit(x) for x in samples)), (F.col(column) % len(samples) + 1).cast("int"))


@query(f"""SELECT event_id, coalesce(f, 'none') AS failure, coalesce(CASE WHEN f NOT IN ('tone-marks', 'english-left', 'latin') THEN f END, 'none') AS derived_failure, c AS scripts
FROM events JOIN (VALUES {SAMPLES_SQL}) s(n, t, f, c) ON n = event_id % {len(SAMPLES)}""")
def text_rule_samples(spark: SparkSession, d: str) -> DataFrame:
    """The first rule each of some texts breaks, and its scripts."""
    text, allowed, english = sample_of("event_id", [t for t, _, _ in SAMPLES]), F.array(F.lit("DNA")), F.array(F.lit("post"))
    rows = read(spark, d, "events", "event_id").withColumn("t", text)
    fails = lambda **k: F.coalesce(T.first_failure(F.col("t"), 24, allowed, english, **k), F.lit("none"))
    scripts = F.concat(*(F.when(T.has("t", c), n).otherwise("") for n, c in {"l": T.LATIN, "c": T.CYRILLIC, "h": T.HAN, "k": T.KANA}.items()))
    return rows.select("event_id", fails().alias("failure"), fails(readings=F.lit(True)).alias("derived_failure"), scripts.alias("scripts"))


@query("""SELECT failure, count(*) AS n FROM (SELECT CASE WHEN text IS NULL OR text = '' THEN 'empty' WHEN regexp_matches(text, '^\\s|\\s$') THEN 'edge-space'
WHEN length(text) > 2000 THEN 'too-long' WHEN regexp_matches(text, '[\\x{0400}-\\x{052F}]') THEN 'cyrillic'
WHEN regexp_matches(text, '[\\x{0300}\\x{0301}\\x{0304}\\x{030C}āáǎàēéěèīíǐìōóǒòūúǔùǖǘǚǜĀÁǍÀĒÉĚÈ]') THEN 'tone-marks'
WHEN lower(list_filter(regexp_extract_all(text, '[A-Za-zªµºÀ-ÖØ-öø-ɏ]+'), lambda t: t NOT IN ('the', 'of'))[1]) IN ('and', 'to', 'in') THEN 'english-left'
WHEN len(list_filter(regexp_extract_all(text, '[A-Za-zªµºÀ-ÖØ-öø-ɏ]+'), lambda t: t NOT IN ('the', 'of'))) > 0 THEN 'latin' ELSE 'no-japanese' END AS failure FROM documents) GROUP BY failure""")
def text_first_failure(spark: SparkSession, d: str) -> DataFrame:
    """The first rule a text breaks."""
    words = lambda *w: F.array(*map(F.lit, w))
    failure = T.first_failure(F.col("text"), 2000, words("the", "of"), words("and", "to", "in"))
    return read(spark, d, "documents", "text").select(failure.alias("failure")).groupBy("failure").agg(F.count("*").alias("n"))


@query("""WITH w AS (SELECT DISTINCT unnest(regexp_extract_all(lower(url), '[a-zªµºÀ-ÖØ-öø-ɏ]+')) AS token FROM pages), a AS (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-zªµºÀ-ÖØ-öø-ɏ]+')) AS token FROM benchmark)
SELECT token, length(token) AS n_chars FROM w WHERE token NOT IN (SELECT token FROM a)""")
def allowlist_anti(spark: SparkSession, d: str) -> DataFrame:
    """Tokens that an allowlist does not have."""
    tokens = lambda df, c: df.select(F.explode(T.latin_tokens(F.lower(c))).alias("token")).distinct()
    found = tokens(read(spark, d, "pages", "url"), "url").join(tokens(read(spark, d, "benchmark"), "text"), "token", "left_anti")
    return found.select("token", whole(F.length("token")).alias("n_chars"))


@query("SELECT doc_id, lang FROM documents d WHERE EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1)")
def semi_labels(spark: SparkSession, d: str) -> DataFrame:
    """Rows with a match."""
    return read(spark, d, "documents", "doc_id", "lang").join(read(spark, d, "labels").where("quality = 1"), "doc_id", "left_semi")


@query("SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def anti_labels(spark: SparkSession, d: str) -> DataFrame:
    """Rows without a match."""
    return read(spark, d, "documents", "doc_id", "lang").join(read(spark, d, "labels"), "doc_id", "left_anti")


# --- joins -----------------------------------------------------------------------------


@query("""WITH s AS (SELECT n_nationkey, unnest(list_distinct([n_name, lower(n_name), substr(n_name, 1, 3)])) AS spelling FROM nation),
w AS (SELECT c_custkey, CASE c_custkey % 3 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) ELSE substr(n_name, 1, 3) END AS spelling FROM customer JOIN nation ON c_nationkey = n_nationkey)
SELECT spelling, count(*) AS n_rows, count(DISTINCT n_nationkey) AS n_targets FROM w JOIN s USING (spelling) GROUP BY spelling""")
def fanout_join(spark: SparkSession, d: str) -> DataFrame:
    """Every row that any spelling reaches."""
    nation = read(spark, d, "nation", "n_nationkey", "n_name")
    short = F.substring("n_name", 1, 3)
    index = M.spelling_index(nation, [F.col("n_name"), F.lower("n_name"), short]).select("n_nationkey", "spelling")
    words = read(spark, d, "customer", "c_custkey", "c_nationkey").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    words = words.select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("n_name")).when(F.col("c_custkey") % 3 == 1, F.lower("n_name")).otherwise(short).alias("spelling"))
    return words.join(index, "spelling").groupBy("spelling").agg(F.count("*").alias("n_rows"), F.count_distinct("n_nationkey").alias("n_targets"))


@query("""SELECT o_custkey, arg_max(o_orderpriority, o_orderkey) FILTER (o_orderkey % 3 <> 0) AS priority, arg_max(o_orderstatus, o_orderkey) AS status FROM orders GROUP BY o_custkey""")
def last_nonnull_wins(spark: SparkSession, d: str) -> DataFrame:
    """Each column's last known value of a key."""
    known = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderpriority"))
    rows = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority", "o_orderstatus").select("o_custkey", "o_orderkey", known.alias("priority"), F.col("o_orderstatus").alias("status"))
    return O.last_value_per_key(rows, ["o_custkey"], ["priority", "status"], "o_orderkey")


@query("""WITH p AS (SELECT p_partkey, p_brand, p_size FROM part), ref AS (SELECT DISTINCT p_brand AS brand, p_size AS size FROM part WHERE p_partkey % 7 = 0),
t1 AS (SELECT p_partkey, count(*) AS n FROM p JOIN ref ON p_brand = brand AND p_size = size GROUP BY 1),
t2 AS (SELECT p_partkey, count(*) AS n FROM p JOIN ref ON regexp_replace(p_brand, '[0-9]$', '') = regexp_replace(brand, '[0-9]$', '') AND p_size = size WHERE p_partkey NOT IN (SELECT p_partkey FROM t1) GROUP BY 1)
SELECT tier, count(*) AS n_parts, CAST(sum(n) AS BIGINT) AS n_targets FROM (SELECT p_partkey, 1 AS tier, n FROM t1 UNION ALL SELECT p_partkey, 2, n FROM t2
UNION ALL SELECT p_partkey, 0, 0 FROM p WHERE p_partkey NOT IN (SELECT p_partkey FROM t1) AND p_partkey NOT IN (SELECT p_partkey FROM t2)) GROUP BY tier""")
def priority_fallback_match(spark: SparkSession, d: str) -> DataFrame:
    """Exact matches, else looser ones, else the supplement."""
    part = read(spark, d, "part", "p_partkey", "p_brand", "p_size")
    ref = part.where("p_partkey % 7 = 0").select(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).distinct()
    loose = lambda c: F.regexp_replace(c, "[0-9]$", "")
    exact = ([F.col("p_brand"), F.col("p_size")], [F.col("brand"), F.col("size")])
    looser = ([loose("p_brand"), F.col("p_size")], [loose("brand"), F.col("size")])
    found = M.tiered_match(part, ref, "p_partkey", [exact, looser])
    per_part = found.groupBy("p_partkey", "tier").agg(F.count("*").alias("n"))
    rest = M.unmatched(part, found, "p_partkey").select("p_partkey", F.lit(0).alias("tier"), F.lit(0).cast("bigint").alias("n"))
    return per_part.unionByName(rest).groupBy("tier").agg(F.count("*").alias("n_parts"), F.sum("n").alias("n_targets"))


@query("""WITH f AS (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS k FROM orders GROUP BY 1, 2)
SELECT o_custkey, string_agg(o_orderpriority, '、' ORDER BY k) AS priorities FROM f GROUP BY o_custkey""")
def seed_union_ordered(spark: SparkSession, d: str) -> DataFrame:
    """Distinct values in the order they first appear."""
    rows = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderpriority").withColumn("p", F.array("o_orderpriority"))
    return M.ordered_union(rows, ["o_custkey"], "p", "o_orderkey", "all").select("o_custkey", F.array_join("all", "、").alias("priorities"))


@query("""SELECT c_custkey, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS first_order, arg_min(o_orderstatus, (o_orderdate, o_orderkey)) AS first_status
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""")
def first_match_norm(spark: SparkSession, d: str) -> DataFrame:
    """The first matching row's values."""
    orders = read(spark, d, "orders", "o_custkey", "o_orderkey", "o_orderstatus", "o_orderdate").withColumnRenamed("o_custkey", "c_custkey").withColumn("at", F.struct("o_orderdate", "o_orderkey"))
    found = M.first_match(read(spark, d, "customer", "c_custkey"), orders, "c_custkey", "at", ["o_orderkey", "o_orderstatus"])
    return found.select("c_custkey", F.col("o_orderkey").alias("first_order"), F.col("o_orderstatus").alias("first_status"))


OVERRIDES = [(0, "Overridden zero"), (7, "Overridden seven"), (99, "Stale ninety-nine"), (120, "Stale one-twenty")]
OVERRIDES_SQL = ", ".join(f"({k}, '{v}')" for k, v in OVERRIDES)


def overrides(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(OVERRIDES, "n_nationkey int, n_name string")


@query(f"SELECT n_nationkey, coalesce(o.name, n_name) AS n_name, n_regionkey FROM nation LEFT JOIN (VALUES {OVERRIDES_SQL}) o(k, name) ON k = n_nationkey")
def coalesce_override(spark: SparkSession, d: str) -> DataFrame:
    """Values replaced where an override has one."""
    return M.overridden(read(spark, d, "nation"), overrides(spark), ["n_nationkey"], ["n_name"])


@query(f"SELECT CAST(k AS INTEGER) AS n_nationkey, name AS n_name FROM (VALUES {OVERRIDES_SQL}) o(k, name) WHERE k NOT IN (SELECT n_nationkey FROM nation)")
def stale_override_anti(spark: SparkSession, d: str) -> DataFrame:
    """Overrides that no row has."""
    return M.stale(overrides(spark), read(spark, d, "nation", "n_nationkey"), ["n_nationkey"])


@query("""WITH t AS (SELECT l_suppkey, count(*) FILTER (l_quantity >= 40) AS n FROM lineitem WHERE l_suppkey % 5 <> 0 GROUP BY 1)
SELECT CASE WHEN n IS NULL THEN 'none' WHEN n > 240 THEN 'full' ELSE 'headword' END AS verdict, count(*) AS n_suppliers FROM supplier LEFT JOIN t ON l_suppkey = s_suppkey GROUP BY 1""")
def crosscheck_verdict(spark: SparkSession, d: str) -> DataFrame:
    """How far an external count confirms a row."""
    counts = read(spark, d, "lineitem", "l_suppkey", "l_quantity").where("l_suppkey % 5 <> 0").groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count_if(F.col("l_quantity") >= 40).alias("n"))
    joined = read(spark, d, "supplier", "s_suppkey").join(counts, "s_suppkey", "left")
    return joined.select(M.verdict(F.greatest(F.col("n") - 240, F.when(F.col("n").isNotNull(), 0))).alias("verdict")).groupBy("verdict").agg(F.count("*").alias("n_suppliers"))


def order_rows(spark: SparkSession, d: str) -> DataFrame:
    """Orders as rows with a sense for each of their lines: the word is the customer, the
    reading the order."""
    lines = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    senses = F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_quantity"))), lambda x: F.struct(x["l_quantity"].cast("int").cast("string").alias("ja")))
    gathered = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(senses.alias("senses"))
    named = read(spark, d, "orders", "o_orderkey", "o_custkey").select("o_orderkey", F.concat(F.lit("w"), "o_custkey").alias("word"), F.lit(None).cast("string").alias("trad"), F.concat(F.lit("p"), "o_orderkey").alias("pinyin"))
    return named.join(gathered, "o_orderkey").withColumns({"primary": F.lit(None).cast("int"), "default": F.lit(None).cast("boolean")})


ROWS_SQL = """l AS (SELECT l_orderkey AS k, CAST(l_quantity AS INTEGER) AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS n FROM lineitem),
c AS (SELECT k, max(n) AS n_lines, o_custkey AS w FROM l JOIN orders ON o_orderkey = k GROUP BY k, o_custkey)"""


@query(f"""WITH {ROWS_SQL}, r AS (SELECT o_orderkey AS k, o_orderkey % 5 + 1 AS pick, o_orderkey % 50 + 1 AS expected FROM orders WHERE o_orderkey % 4 = 0 UNION ALL SELECT -1 - o_orderkey, 1, 1 FROM orders WHERE o_orderkey % 100 = 0),
e AS (SELECT CASE WHEN n_lines IS NULL THEN 'no such row' WHEN pick > n_lines THEN 'no such sense' WHEN q <> expected THEN 'another text' END AS label FROM r LEFT JOIN c USING (k) LEFT JOIN l ON l.k = r.k AND l.n = pick
UNION ALL SELECT 'no primary' FROM c WHERE n_lines >= 2 AND k % 4 <> 0 UNION ALL SELECT 'no default' FROM (SELECT w FROM c GROUP BY w HAVING count(*) > 1 AND count(*) FILTER (k % 3 = 0) = 0))
SELECT label, count(*) AS n FROM e WHERE label IS NOT NULL GROUP BY label""")
def patch_indexed(spark: SparkSession, d: str) -> DataFrame:
    """What is wrong with patches that must hit an element by index and agree with it."""
    rows, orders = order_rows(spark, d), read(spark, d, "orders", "o_orderkey", "o_custkey")
    k, word = F.col("o_orderkey"), F.concat(F.lit("w"), "o_custkey")
    hit = orders.where(k % 4 == 0).select(word.alias("word"), F.concat(F.lit("p"), k).alias("pinyin"), (k % 5 + 1).cast("int").alias("sense"), (k % 50 + 1).cast("string").alias("ja"))
    lost = orders.where(k % 100 == 0).select(F.lit("nobody").alias("word"), F.concat(F.lit("p-"), k).alias("pinyin"), F.lit(1).alias("sense"), F.lit("1").alias("ja"))
    primary = hit.unionByName(lost).withColumn("trad", F.lit(None).cast("string"))
    default = rows.where(k % 3 == 0).select("word", "trad", "pinyin")
    return P.primary_errors(rows.drop("o_orderkey"), primary, default).groupBy("label").agg(F.count("*").alias("n"))


@query(f"""WITH {ROWS_SQL} SELECT k AS o_orderkey, CASE WHEN n_lines >= 2 THEN CAST(k % n_lines + 1 AS INTEGER) END AS primary_sense, CASE WHEN k = min(k) OVER (PARTITION BY w) AND count(*) OVER (PARTITION BY w) > 1 THEN true END AS default_row FROM c""")
def patch_applied(spark: SparkSession, d: str) -> DataFrame:
    """Rows with the primary sense and default row of records that fit."""
    rows = materialise(order_rows(spark, d))  # read several times
    several = rows.where(F.size("senses") >= 2)
    sense = (F.col("o_orderkey") % F.size("senses") + 1).cast("int")
    primary = several.select("word", "trad", "pinyin", sense.alias("sense"), F.get("senses", sense - 1)["ja"].alias("ja"))
    first = rows.groupBy("word").agg(F.min("o_orderkey").alias("o_orderkey"), F.count("*").alias("n")).where("n > 1").select("o_orderkey")
    done = P.apply_primary(rows, primary, rows.join(first, "o_orderkey").select("word", "trad", "pinyin"))
    return done.select("o_orderkey", F.col("primary").alias("primary_sense"), F.col("default").alias("default_row"))


@query("""WITH h AS (SELECT user_id, event_type, min(event_id) AS k FROM events WHERE event_id % 2 = 0 GROUP BY 1, 2), a AS (SELECT user_id, event_type, min(event_id) AS k FROM events WHERE event_id % 2 = 1 GROUP BY 1, 2),
u AS (SELECT user_id, event_type, 0 AS s, k FROM h UNION ALL SELECT a.user_id, a.event_type, 1, a.k FROM a LEFT JOIN h ON h.user_id = a.user_id AND h.event_type = a.event_type WHERE h.user_id IS NULL)
SELECT user_id, string_agg(event_type, ',' ORDER BY s, k) AS pos, count(*) FILTER (s = 1) AS n_added FROM u GROUP BY user_id""")
def pos_additive(spark: SparkSession, d: str) -> DataFrame:
    """Elements appended where they are missing; a second time changes nothing."""
    events = read(spark, d, "events", "event_id", "user_id", "event_type").withColumn("t", F.array("event_type"))
    have = M.ordered_union(events.where("event_id % 2 = 0"), ["user_id"], "t", "event_id", "have")
    add = M.ordered_union(events.where("event_id % 2 = 1"), ["user_id"], "t", "event_id", "add")
    none = F.array().cast("array<string>")
    joined = have.join(add, "user_id", "full_outer").select("user_id", F.coalesce("have", none).alias("have"), F.coalesce("add", none).alias("add"))
    once = joined.withColumn("pos", M.append_missing(M.append_missing(F.col("have"), F.col("add")), F.col("add")))
    return once.select("user_id", F.array_join("pos", ",").alias("pos"), whole(F.size("pos") - F.size("have")).alias("n_added"))


@query("""SELECT c_custkey AS key, CASE WHEN c_custkey % 10 = 0 THEN 'BUILDING' END AS expected, c_mktsegment AS actual FROM customer WHERE c_custkey % 10 = 0 AND c_mktsegment <> 'BUILDING'""")
def value_mismatch(spark: SparkSession, d: str) -> DataFrame:
    """Values that are not what is expected; null expects nothing."""
    rows = read(spark, d, "customer", "c_custkey", "c_mktsegment").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("segment"))
    wanted = rows.select("key", F.when(F.col("key") % 10 == 0, "BUILDING").alias("segment"))
    return M.value_mismatch(wanted, rows, "key", "segment")


@query("""WITH a AS (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS ordinal, o_orderkey AS k FROM orders), b AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS ordinal, o_orderkey AS k FROM orders WHERE o_orderkey % 50 <> 0)
SELECT coalesce(a.ordinal, b.ordinal) AS ordinal, a.k AS left_key, b.k AS right_key FROM a FULL JOIN b ON a.ordinal = b.ordinal WHERE a.k IS DISTINCT FROM b.k""")
def positional_full_outer(spark: SparkSession, d: str) -> DataFrame:
    """Where two ordered streams differ, or one has ended."""
    orders = read(spark, d, "orders", "o_orderkey", "o_orderdate")
    a, b = O.global_ordinal(orders, "o_orderdate", "o_orderkey"), O.global_ordinal(orders.where("o_orderkey % 50 <> 0"), "o_orderkey")
    return D.positional_difference(a, b, "ordinal", ["o_orderkey"]).select("ordinal", F.col("l.o_orderkey").alias("left_key"), F.col("r.o_orderkey").alias("right_key"))


@query("""SELECT 'removed' AS change, ordinal, key FROM (SELECT o_orderkey AS key, row_number() OVER (ORDER BY o_orderkey) AS ordinal FROM orders) WHERE key % 997 = 5
UNION ALL SELECT 'inserted', ordinal, key FROM (SELECT key, row_number() OVER (ORDER BY abs(key), key) AS ordinal FROM (SELECT o_orderkey AS key FROM orders WHERE o_orderkey % 997 <> 5 UNION ALL SELECT -o_orderkey FROM orders WHERE o_orderkey % 1009 = 7)) WHERE key < 0""")
def inserted_rows(spark: SparkSession, d: str) -> DataFrame:
    """What was inserted into an ordered table and removed from it, though places move."""
    keys = read(spark, d, "orders", "o_orderkey").select(F.col("o_orderkey").alias("key"))
    new = keys.where("key % 997 <> 5").unionByName(keys.where("key % 1009 = 7").select((-F.col("key")).alias("key")))
    before, after = O.global_ordinal(keys, "key"), O.global_ordinal(new, F.abs("key"), "key")
    return D.row_changes(before, after, "ordinal", ["key"], 64).select("change", "ordinal", "key")


@query("""WITH o AS (SELECT o_custkey, CAST(count(*) AS BIGINT) AS k, count(*) FILTER (o_orderstatus IN ('O', 'F')) AS by_model FROM orders GROUP BY 1)
SELECT row_number() OVER (ORDER BY c_custkey) - 1 AS ordinal, c_name AS word, k AS n_senses, by_model FROM customer JOIN o ON o_custkey = c_custkey""")
def shared_deref(spark: SparkSession, d: str) -> DataFrame:
    """Entries out of key-value stores that many tasks write and read, with what their shared ids stand for put back and
    kinds checked (J25, J26, S20)."""
    place = working_folder(spark, "store")
    ST.write_parts(C.to_common(native_rows(spark, d)), place, {"format": "common"})
    kind = "struct<headwords: array<struct<text: string>>, senses: array<struct<translations: array<struct<provenance: struct<method: string>>>>>>"
    rows = ST.parts_frame(spark, place).select("ordinal", F.from_json("value", kind).alias("e"))
    methods = F.transform("e.senses", lambda t: F.get(t["translations"], F.lit(0))["provenance"]["method"])
    return rows.select("ordinal", F.get("e.headwords", F.lit(0))["text"].alias("word"), whole(F.size("e.senses")).alias("n_senses"), whole(F.size(F.filter(methods, lambda m: m == "llm"))).alias("by_model"))


SENSE_VALUES_SQL = """s AS (SELECT o_orderkey AS ord, CASE o_orderstatus WHEN 'O' THEN 'llm_ok' WHEN 'F' THEN 'llm_fixed' ELSE 'hand_fixed' END AS qa, '["' || o_orderpriority || '"]' AS glosses, o_custkey FROM orders),
r AS (SELECT ord, '{"method":"' || CASE qa WHEN 'hand_fixed' THEN 'manual_override' ELSE 'llm' END || '","source":"own-dict","source_value":"' || qa || '"}' AS provenance, glosses FROM s WHERE o_custkey IN (SELECT c_custkey FROM customer)),
v AS (SELECT kind, value, count(*) AS n, row_number() OVER (ORDER BY kind, value) AS id FROM (SELECT 'provenance' AS kind, provenance AS value FROM r UNION ALL SELECT 'glosses', glosses FROM r) GROUP BY kind, value)"""


def sense_values(spark: SparkSession, d: str) -> DataFrame:
    """The provenance and glosses of each translated sense of the common entries, as JSON."""
    t = C.to_common(native_rows(spark, d)).select("ord", F.posexplode("senses").alias("at", "s"))
    return t.select("ord", "at", F.to_json(F.get("s.translations", F.lit(0))["provenance"]).alias("provenance"), F.to_json("s.glosses.text").alias("glosses"))


@query(f"WITH {SENSE_VALUES_SQL} SELECT id, kind, value, n FROM v")
def shared_dictionary(spark: SparkSession, d: str) -> DataFrame:
    """What recurs in the entries' senses, once under an id."""
    return V.shared_values(sense_values(spark, d), ["provenance", "glosses"])


@query(f"WITH {SENSE_VALUES_SQL} SELECT p.id AS provenance_id, g.id AS glosses_id, provenance, glosses, count(*) AS n FROM r JOIN v p ON p.kind = 'provenance' AND p.value = provenance JOIN v g ON g.kind = 'glosses' AND g.value = glosses GROUP BY ALL")
def shared_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """Senses with ids for what they share, and the values put back, their kinds checked."""
    rows, kinds = sense_values(spark, d), ["provenance", "glosses"]
    values = V.shared_values(rows, kinds)
    coded = V.with_ids(rows, values, kinds)
    kept = coded.select("*", *(F.col(k).alias(f"{k}_id") for k in kinds))
    return V.with_values(kept, values, kinds).groupBy("provenance_id", "glosses_id", *kinds).agg(F.count("*").alias("n"))


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_shipdate) AS r FROM lineitem
WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O')) WHERE r = 1 AND l_linenumber <= 2""")
def accept_requested(spark: SparkSession, d: str) -> DataFrame:
    """Requested answers, of repeated ones the first."""
    wanted = read(spark, d, "orders").where("o_orderstatus = 'O'").select(F.col("o_orderkey").alias("l_orderkey"), F.explode(F.array(F.lit(1), F.lit(2))).alias("l_linenumber"))
    lines = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return M.accepted(lines, wanted, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_shipdate"]).drop("l_shipdate")


@query("SELECT user_id FROM events GROUP BY user_id HAVING count(DISTINCT event_type) = (SELECT count(DISTINCT event_type) FROM events)")
def relational_division(spark: SparkSession, d: str) -> DataFrame:
    """Keys that have every item."""
    events = read(spark, d, "events", "user_id", "event_type")
    return M.divided(events, "user_id", "event_type", events.select("event_type").distinct())


# --- order, windows, chunks ---------------------------------------------------------------


@query("""WITH r AS (SELECT s_suppkey, row_number() OVER (ORDER BY s_acctbal DESC, s_suppkey) AS rank FROM supplier WHERE s_nationkey % 2 = 0)
SELECT s_suppkey, row_number() OVER (ORDER BY r.rank IS NULL, r.rank, s_suppkey) AS position FROM supplier LEFT JOIN r USING (s_suppkey)""")
def ranked_first_order(spark: SparkSession, d: str) -> DataFrame:
    """Ranked rows first, then the others."""
    supplier = read(spark, d, "supplier", "s_suppkey", "s_acctbal", "s_nationkey")
    ranks = O.global_ordinal(supplier.where("s_nationkey % 2 = 0"), F.desc("s_acctbal"), "s_suppkey", name="rank").select("s_suppkey", "rank")
    return O.ranked_first(supplier.select("s_suppkey"), ranks, "s_suppkey", "s_suppkey").select("s_suppkey", "position")


@query("""WITH n AS (SELECT l_orderkey, l_returnflag, l_linestatus, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS p FROM lineitem),
f AS (SELECT l_orderkey, l_returnflag, l_linestatus, l_suppkey, min(p) AS p FROM n GROUP BY ALL), g AS (SELECT l_orderkey, l_returnflag, l_linestatus, string_agg(CAST(l_suppkey AS VARCHAR), ',' ORDER BY p) AS supps FROM f GROUP BY ALL)
SELECT g.l_orderkey, g.l_returnflag, g.l_linestatus, min(n.p) AS place, count(*) AS merged, any_value(supps) AS supps FROM g JOIN n ON n.l_orderkey = g.l_orderkey AND n.l_returnflag = g.l_returnflag AND n.l_linestatus = g.l_linestatus GROUP BY ALL""")
def collapse_equal(spark: SparkSession, d: str) -> DataFrame:
    """Equal rows become one, with what the later ones add."""
    w = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey")
    rows = read(spark, d, "lineitem", "l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber", "l_partkey", "l_suppkey")
    rows = rows.select("l_orderkey", "l_returnflag", "l_linestatus", whole(F.row_number().over(w)).alias("p"), F.array(F.col("l_suppkey").cast("string")).alias("s"))
    done = M.collapse_equal(rows, ["l_orderkey"], ["l_returnflag", "l_linestatus"], "p", "s", "supps")
    return done.withColumn("supps", F.array_join("supps", ","))


@query("""WITH c AS (SELECT o_orderkey, count(l_orderkey) AS n FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1)
SELECT CASE WHEN n = 0 THEN 'none' WHEN n = 1 THEN 'one' WHEN n <= 4 THEN 'few' ELSE 'many' END AS class, n AS n_lines, count(*) AS n_orders FROM c GROUP BY ALL""")
def counts_partition(spark: SparkSession, d: str) -> DataFrame:
    """Exclusive classes and a histogram."""
    lines = read(spark, d, "lineitem", "l_orderkey").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0).cast("bigint"))
    kind = F.when(n == 0, "none").when(n == 1, "one").when(n <= 4, "few").otherwise("many")
    return read(spark, d, "orders", "o_orderkey").join(lines, "o_orderkey", "left").groupBy(kind.alias("class"), n.alias("n_lines")).agg(F.count("*").alias("n_orders"))


@query("""WITH t AS (SELECT event_id, user_id, event_type, min(event_id) OVER (PARTITION BY user_id, event_type) AS first_line FROM events)
SELECT event_id, user_id, event_type, first_line FROM t WHERE event_id <> first_line""")
def group_rules(spark: SparkSession, d: str) -> DataFrame:
    """Repeated keys with the place of the first."""
    return O.repeats_with_first(read(spark, d, "events", "event_id", "user_id", "event_type"), ["user_id", "event_type"], "event_id")


@query("""WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS k FROM events)
SELECT event_type AS label, count(*) AS n, string_agg(CAST(event_id AS VARCHAR), ',' ORDER BY k) FILTER (k <= 3) AS examples FROM r GROUP BY event_type""")
def rollup_errors(spark: SparkSession, d: str) -> DataFrame:
    """Kinds with counts and three examples each."""
    return M.examples(read(spark, d, "events", "event_type", "event_id").withColumnRenamed("event_type", "label"), "label", "event_id")


@query("""SELECT l_partkey, max(q) AS most FROM (SELECT l_partkey, l_orderkey, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY ALL) GROUP BY l_partkey""")
def max_sum_by_title(spark: SparkSession, d: str) -> DataFrame:
    """The greatest sum of a group's groups."""
    sums = read(spark, d, "lineitem", "l_partkey", "l_orderkey", "l_quantity").groupBy("l_partkey", "l_orderkey").agg(F.sum(whole(F.col("l_quantity"))).alias("q"))
    return sums.groupBy("l_partkey").agg(F.max("q").alias("most"))


@query("""WITH RECURSIVE l AS (SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS q, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity) AS p FROM lineitem),
c AS (SELECT l_orderkey, p, q AS held, 1 AS rows, 0 AS chunk, q FROM l WHERE p = 1
UNION ALL SELECT l.l_orderkey, l.p, CASE WHEN c.held + l.q > 60 OR c.rows >= 3 THEN l.q ELSE c.held + l.q END, CASE WHEN c.held + l.q > 60 OR c.rows >= 3 THEN 1 ELSE c.rows + 1 END,
c.chunk + CASE WHEN c.held + l.q > 60 OR c.rows >= 3 THEN 1 ELSE 0 END, l.q FROM c JOIN l ON l.l_orderkey = c.l_orderkey AND l.p = c.p + 1)
SELECT l_orderkey, CAST(chunk AS INTEGER) AS chunk, count(*) AS n, CAST(sum(q) AS BIGINT) AS total FROM c GROUP BY l_orderkey, chunk""")
def budget_chunks(spark: SparkSession, d: str) -> DataFrame:
    """Chunks within a budget and a row limit."""
    lines = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    done = K.budget_chunks(lines, ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity"], "l_quantity", 60, 3)
    return done.groupBy("l_orderkey", "chunk").agg(F.count("*").alias("n"), F.sum(whole(F.col("l_quantity"))).alias("total"))


@query("""WITH RECURSIVE l AS (SELECT l_returnflag AS g, CAST(l_quantity AS BIGINT) AS q, row_number() OVER w AS p, CAST(sum(l_quantity) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS s FROM lineitem
WINDOW w AS (PARTITION BY l_returnflag ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity)),
n AS (SELECT a.g, a.p, greatest(a.p + 1, least(a.p + 200, b.p + 1)) AS next FROM l a ASOF JOIN l b ON a.g = b.g AND a.s - a.q + 4000 >= b.s),
c AS (SELECT g, p, next, 0 AS chunk FROM n WHERE p = 1 UNION ALL SELECT n.g, n.p, n.next, c.chunk + 1 FROM c JOIN n ON n.g = c.g AND n.p = c.next)
SELECT c.g AS l_returnflag, c.chunk, count(*) AS n, CAST(sum(q) AS BIGINT) AS total, min(l.p) AS first_row FROM c JOIN l ON l.g = c.g AND l.p >= c.p AND l.p < c.next GROUP BY c.g, c.chunk""")
def budget_chunks_hot(spark: SparkSession, d: str) -> DataFrame:
    """Chunks of groups that each hold a third of all rows, by many tasks a group."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    done = K.budget_chunks(read(spark, d, "lineitem", "l_returnflag", *order), ["l_returnflag"], order, "l_quantity", 4000, 200)
    sums = done.groupBy("l_returnflag", "chunk").agg(F.count("*").alias("n"), F.sum(whole(F.col("l_quantity"))).alias("total"))
    before = Window.partitionBy("l_returnflag").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    return sums.withColumn("first_row", F.coalesce(F.sum("n").over(before), F.lit(0)) + 1)


@query("""SELECT CAST((n - 1) // 500 AS BIGINT) AS batch, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders) GROUP BY 1""")
def fixed_batches(spark: SparkSession, d: str) -> DataFrame:
    """Batches of a fixed size."""
    done = O.fixed_batches(read(spark, d, "orders", "o_orderkey"), 500, "o_orderkey")
    return done.groupBy("batch").agg(F.count("*").alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


@query("""SELECT (n - 1) % 8 AS shard, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS keys FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS n FROM orders) GROUP BY 1""")
def modulo_shard(spark: SparkSession, d: str) -> DataFrame:
    """Rows dealt to shards in turn."""
    done = O.modulo_shard(read(spark, d, "orders", "o_orderkey", "o_orderdate"), 8, "o_orderdate", "o_orderkey")
    return done.groupBy("shard").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys"))


@query("""WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS ordinal FROM orders), s AS (SELECT DISTINCT CAST(round_even(i * ((SELECT count(*) - 1 FROM n) / 96.0), 0) AS BIGINT) + 1 AS ordinal FROM range(97) t(i))
SELECT o_orderkey, ordinal FROM n JOIN s USING (ordinal)""")
def even_sample(spark: SparkSession, d: str) -> DataFrame:
    """An even sample with both ends."""
    return O.even_sample(read(spark, d, "orders", "o_orderkey"), 97, "o_orderkey").select("o_orderkey", "ordinal")


@query("""WITH n AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS ordinal FROM orders), s AS (SELECT DISTINCT CAST(round_even(i * ((SELECT count(*) - 41 FROM n) / 59.0), 0) AS BIGINT) + 41 AS ordinal FROM range(60) t(i))
SELECT o_orderkey, ordinal, 'head' AS part FROM n WHERE ordinal <= 40 UNION ALL SELECT o_orderkey, ordinal, 'sample' FROM n JOIN s USING (ordinal)""")
def pilot_plan(spark: SparkSession, d: str) -> DataFrame:
    """The head and an even sample of the rest."""
    return O.pilot_plan(read(spark, d, "orders", "o_orderkey", "o_orderdate"), 100, 40, "o_orderdate", "o_orderkey").select("o_orderkey", "ordinal", "part")


@query("""WITH e AS (SELECT event_id, user_id, epoch(ts)::BIGINT AS s, CAST(round(value * 100) AS BIGINT) AS v FROM events),
m AS (SELECT *, max(s) OVER (PARTITION BY user_id, s) AS x FROM e), o AS (SELECT a.event_id, a.user_id, a.v, (SELECT arg_max(b.v, (b.s, b.v, b.event_id)) FROM e b WHERE b.user_id = a.user_id AND b.s <= a.s - 3600) AS old FROM e a)
SELECT event_id, user_id, coalesce(v <= old, false) AS stalled FROM o""")
def stall_detect(spark: SparkSession, d: str) -> DataFrame:
    """No growth against the newest sample of an hour ago or more; of samples in one second the largest counts."""
    events = read(spark, d, "events", "event_id", "user_id", "ts", "value").withColumn("v", cents("value"))
    return N.stalled(events.withColumn("s", seconds("ts")), ["user_id"], "s", "v", 3600, ["v", "event_id"]).select("event_id", "user_id", "stalled")


@query("""WITH c AS (SELECT event_id, user_id, CAST(coalesce(sum(CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spent_before FROM events)
SELECT event_id, user_id, spent_before FROM c WHERE spent_before < 20000""")
def token_budget(spark: SparkSession, d: str) -> DataFrame:
    """Rows that start within a budget."""
    events = read(spark, d, "events", "event_id", "user_id", "value").withColumn("cost", cents("value"))
    return N.token_budget(events, ["user_id"], ["event_id"], "cost", 20000).select("event_id", "user_id", "spent_before")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, spent_before FROM (SELECT *, CAST(coalesce(sum(CAST(l_quantity AS BIGINT)) OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS spent_before FROM lineitem)
WHERE spent_before < 400000""")
def token_budget_hot(spark: SparkSession, d: str) -> DataFrame:
    """Rows that start within a budget of all rows together: one group, many tasks."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    done = N.token_budget(read(spark, d, "lineitem", *order), [], order, "l_quantity", 400000)
    return done.select("l_orderkey", "l_linenumber", "l_partkey", "spent_before")


@query("""WITH f AS (SELECT l_partkey, count(*) AS freq FROM lineitem GROUP BY 1), p AS (SELECT (CASE WHEN p_size % 2 = 0 THEN 'c' ELSE 'x' END) || p_partkey AS id, p_size % 5 = 0 AS has_level, coalesce(freq, 0) AS freq FROM part LEFT JOIN f ON l_partkey = p_partkey)
SELECT id, row_number() OVER (ORDER BY has_level DESC, freq DESC, id) AS position FROM p""")
def gen_order(spark: SparkSession, d: str) -> DataFrame:
    """Levels first, then by frequency, then by id as text."""
    parts = part_ids(spark, d)
    freq = read(spark, d, "lineitem", "l_partkey").groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("freq"))
    joined = parts.join(freq, "p_partkey", "left")
    return O.global_ordinal(joined, *O.generation_order(F.col("p_size") % 5 == 0, F.col("freq"), "id"), name="position").select("id", "position")


def part_ids(spark: SparkSession, d: str) -> DataFrame:
    letter = F.when(F.col("p_size") % 2 == 0, "c").otherwise("x")
    return read(spark, d, "part", "p_partkey", "p_size").withColumn("id", F.concat(letter, F.col("p_partkey")))


@query("""WITH p AS (SELECT (CASE WHEN p_size % 2 = 0 THEN 'c' ELSE 'x' END) || p_partkey AS id FROM part)
SELECT id, row_number() OVER (ORDER BY substr(id, 1, 1), CAST(substr(id, 2) AS BIGINT), id) AS position FROM p""")
def natural_id_order(spark: SparkSession, d: str) -> DataFrame:
    """Ids by letter and number."""
    return O.global_ordinal(part_ids(spark, d), *O.natural_id_order("id"), name="position").select("id", "position")


@query("SELECT o_orderkey, ordinal FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS ordinal FROM orders) WHERE ordinal <= 250")
def limit_by_ordinal(spark: SparkSession, d: str) -> DataFrame:
    """A limit by place, the same each time."""
    return O.global_ordinal(read(spark, d, "orders", "o_orderkey", "o_totalprice"), F.desc("o_totalprice"), "o_orderkey").where("ordinal <= 250").select("o_orderkey", "ordinal")


# --- sets and aggregates --------------------------------------------------------------------


@query("""SELECT src, key, nation FROM (SELECT 'skeleton' AS src, c_custkey AS key, c_nationkey AS nation FROM customer UNION ALL SELECT 'supplement', s_suppkey, s_nationkey FROM supplier) WHERE nation < 12""")
def union_supplement(spark: SparkSession, d: str) -> DataFrame:
    """One source after another."""
    a = read(spark, d, "customer").select(F.lit("skeleton").alias("src"), F.col("c_custkey").alias("key"), F.col("c_nationkey").alias("nation"))
    b = read(spark, d, "supplier").select(F.lit("supplement").alias("src"), F.col("s_suppkey").alias("key"), F.col("s_nationkey").alias("nation"))
    return a.unionByName(b).where("nation < 12")


@query("""SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_quantity > 45 AND l_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_quantity > 30)""")
def set_diff(spark: SparkSession, d: str) -> DataFrame:
    """A difference of sets."""
    lines = read(spark, d, "lineitem", "l_partkey", "l_quantity", "l_returnflag").withColumnRenamed("l_partkey", "key")
    return M.stale(lines.where("l_quantity > 45").select("key").distinct(), lines.where("l_returnflag = 'R' AND l_quantity > 30"), ["key"])


@query("""SELECT coalesce(a.k, b.k) AS nation, a.k IS NOT NULL AS of_customers, b.k IS NOT NULL AS of_suppliers FROM (SELECT DISTINCT c_nationkey AS k FROM customer WHERE c_acctbal > 9900) a
FULL JOIN (SELECT DISTINCT s_nationkey AS k FROM supplier WHERE s_acctbal > 5000) b ON a.k = b.k""")
def intersect_keys(spark: SparkSession, d: str) -> DataFrame:
    """What is in both sets, or in one only."""
    a = read(spark, d, "customer").where("c_acctbal > 9900").select(F.col("c_nationkey").alias("nation"), F.lit(True).alias("a")).distinct()
    b = read(spark, d, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("nation"), F.lit(True).alias("b")).distinct()
    return a.join(b, "nation", "full_outer").select("nation", F.col("a").isNotNull().alias("of_customers"), F.col("b").isNotNull().alias("of_suppliers"))


@query("""SELECT CASE WHEN n_nationkey % 3 = 0 THEN 'missing-file' ELSE 'unlisted-file' END AS what, n_name AS name FROM nation WHERE (n_nationkey % 3 = 0) <> (n_nationkey % 2 = 0)""")
def manifest_files(spark: SparkSession, d: str) -> DataFrame:
    """Files that a manifest names against those that are there, both ways."""
    folder, nations = local_folder(spark), [tuple(r) for r in read(spark, d, "nation", "n_nationkey", "n_name").collect()]  # a fixed list of 25
    for k, name in nations:
        if k % 2 == 0:
            (folder / name).write_text("x", encoding="utf-8")
    (folder / "manifest.json").write_text(json.dumps({"files": {name: {} for k, name in nations if k % 3 == 0}}), encoding="utf-8")
    return spark.createDataFrame(A.check_files(folder / "manifest.json", folder), "what string, name string")


@query("""SELECT event_type, count(*) AS n_calls, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS spent, CAST(floor(avg(CAST(round(value * 100) AS BIGINT))) AS BIGINT) AS per_call,
CAST(sum(coalesce(CAST(json_extract_string(props, '$.k') AS BIGINT), 0)) AS BIGINT) AS k_sum FROM events GROUP BY event_type""")
def usage_sum(spark: SparkSession, d: str) -> DataFrame:
    """Sums of counters and averages for each call."""
    events = read(spark, d, "events", "event_type", "value", "props").withColumn("c", cents("value"))
    k = F.coalesce(F.get_json_object("props", "$.k").try_cast("bigint"), F.lit(0))
    return events.groupBy("event_type").agg(F.count("*").alias("n_calls"), F.sum("c").alias("spent"), F.floor(F.avg("c")).alias("per_call"), F.sum(k).alias("k_sum"))


@query("""SELECT event_type, key, count(*) AS calls, CAST(sum(v) AS BIGINT) AS total, CAST(floor(sum(v) * 1.0 / count(*)) AS BIGINT) AS per_call FROM
(SELECT event_type, unnest([{'key': 'input_tokens', 'v': event_id % 100}, {'key': 'output_tokens', 'v': user_id}], recursive := true) FROM events) GROUP BY event_type, key""")
def usage_totals(spark: SparkSession, d: str) -> DataFrame:
    """What calls used in all and each, of the whole numbers in their usage."""
    usage = F.to_json(F.struct((F.col("event_id") % 100).alias("input_tokens"), F.col("user_id").alias("output_tokens"), F.lit(True).alias("cached"), F.lit(0.5).alias("seconds"), F.lit("x").alias("model")))
    totals = I.usage_totals(read(spark, d, "events", "event_id", "user_id", "event_type").withColumn("usage", usage), ["event_type"])
    return totals.withColumn("per_call", F.floor("per_call"))


@query("""WITH t AS (SELECT user_id, count(*) AS done, CAST(max(epoch(ts)::BIGINT) - min(epoch(ts)::BIGINT) AS BIGINT) AS seconds FROM events GROUP BY 1)
SELECT user_id, done, CAST(floor(100.0 * done / 500) AS BIGINT) AS percent, CASE WHEN seconds > 0 THEN CAST(floor(done * 3600000.0 / seconds) AS BIGINT) ELSE 0 END AS per_thousand_hours FROM t""")
def progress_rate(spark: SparkSession, d: str) -> DataFrame:
    """Percent done and rate."""
    s = seconds("ts")
    t = read(spark, d, "events", "user_id", "ts").groupBy("user_id").agg(F.count("*").alias("done"), (F.max(s) - F.min(s)).alias("seconds"))
    p = O.progress(F.col("done"), F.lit(500), F.col("seconds"))
    return t.select("user_id", "done", F.floor(p["percent"]).alias("percent"), F.when(F.col("seconds") > 0, F.floor(F.col("done") * F.lit(3600000.0) / F.col("seconds"))).otherwise(0).alias("per_thousand_hours"))


# --- readings, grammar, texts ---------------------------------------------------------------

# Sample syllables, with their tone-marked forms and keys.
SYLLABLES = ["shang4", "ji2", "nu:3", "liu2", "gui4", "xue2", "gou3", "yi1", "bu4", "ge5", "lu:e4", "ang2", "ou3", "hm5"]
MARKED = ["shàng", "jí", "nǚ", "liú", "guì", "xué", "gǒu", "yī", "bù", "ge", "lüè", "áng", "ǒu", "hm"]
KEYS = ["sha4ng", "ji2", "nv3", "liu2", "gui4", "xue2", "go3u", "yi1", "bu4", "ge", "lve4", "a2ng", "o3u", "hm"]
VALUES = ", ".join(f"({n}, '{s}', '{m}', '{k}')" for n, (s, m, k) in enumerate(zip(SYLLABLES, MARKED, KEYS)))
SYLLABLES_SQL = f"WITH s(n, syllable, marked, key) AS (VALUES {VALUES}), p AS (SELECT p_partkey, p_size % {len(SYLLABLES)} AS a, p_partkey % {len(SYLLABLES)} AS b FROM part)"


def two_syllables(spark: SparkSession, d: str) -> DataFrame:
    """(p_partkey, reading): a numbered reading of two sample syllables."""
    at = lambda c: F.element_at(F.array(*(F.lit(s) for s in SYLLABLES)), (F.col(c) % len(SYLLABLES) + 1).cast("int"))
    return read(spark, d, "part", "p_partkey", "p_size").select("p_partkey", F.concat_ws(" ", at("p_size"), at("p_partkey")).alias("reading"))


@query(f"{SYLLABLES_SQL} SELECT p_partkey, x.marked || ' ' || y.marked AS marked FROM p JOIN s x ON x.n = a JOIN s y ON y.n = b")
def reading_marks(spark: SparkSession, d: str) -> DataFrame:
    """Tone-marked readings."""
    return two_syllables(spark, d).select("p_partkey", B.to_marks("reading").alias("marked"))


@query(f"{SYLLABLES_SQL} SELECT p_partkey, x.key || y.key AS key FROM p JOIN s x ON x.n = a JOIN s y ON y.n = b")
def reading_key(spark: SparkSession, d: str) -> DataFrame:
    """Keys of readings, the same from numbers and from marks."""
    both = two_syllables(spark, d).withColumn("key", B.reading_key("reading")).withColumn("other", B.reading_key(B.to_marks("reading")))
    return both.where("key = other").select("p_partkey", "key")


@query(f"{SYLLABLES_SQL} SELECT regexp_replace(x.key || y.key, '[1-4]', '', 'g') AS key, count(*) AS n FROM p JOIN s x ON x.n = a JOIN s y ON y.n = b GROUP BY 1")
def toneless_key(spark: SparkSession, d: str) -> DataFrame:
    """Keys without tones."""
    return two_syllables(spark, d).groupBy(B.toneless_key("reading").alias("key")).agg(F.count("*").alias("n"))


@query(f"""{SYLLABLES_SQL}, r AS (SELECT p_partkey, p_brand, x.syllable AS first, x.key || y.key AS key FROM p JOIN part USING (p_partkey) JOIN s x ON x.n = a JOIN s y ON y.n = b), n AS (SELECT * FROM r WHERE p_partkey % 3 = 0),
o AS (SELECT p_partkey AS ord, p_brand, key FROM r), loose AS (SELECT DISTINCT p_brand, regexp_replace(key, '^(yi|bu)[1-4]', '\\1') AS key FROM n WHERE first IN ('yi1', 'bu4'))
SELECT ord, p_brand AS word FROM o WHERE NOT EXISTS (SELECT 1 FROM n WHERE n.p_brand = o.p_brand AND n.key = o.key) AND NOT EXISTS (SELECT 1 FROM loose WHERE loose.p_brand = o.p_brand AND loose.key = regexp_replace(o.key, '^(yi|bu)[1-4]', '\\1'))""")
def coverage_missing(spark: SparkSession, d: str) -> DataFrame:
    """Earlier rows that no row stands for, by spelling and reading."""
    rows = two_syllables(spark, d).join(read(spark, d, "part", "p_partkey", "p_brand"), "p_partkey").select(F.col("p_partkey").alias("ord"), F.col("p_brand").alias("word"), F.lit(None).cast("string").alias("trad"), B.to_marks("reading").alias("pinyin"))
    return B.uncovered(rows.where("ord % 3 = 0"), rows.select("ord", "word", "pinyin")).select("ord", "word")


@query(f"""{SYLLABLES_SQL}, r AS (SELECT p_partkey, x.syllable AS first, x.key || y.key AS key FROM p JOIN s x ON x.n = a JOIN s y ON y.n = b),
l AS (SELECT DISTINCT regexp_replace(key, '^(yi|bu)[1-4]', '\\1' || '2') AS heard FROM r), k AS (SELECT heard, regexp_replace(heard, '^(yi|bu)[1-4]', '\\1') AS loose FROM l),
e AS (SELECT heard, count(*) AS n FROM k JOIN r ON key = heard GROUP BY 1), f AS (SELECT heard, count(*) AS n FROM k JOIN r ON regexp_replace(key, '^(yi|bu)[1-4]', '\\1') = loose AND first IN ('yi1', 'bu4') WHERE heard NOT IN (SELECT heard FROM e) GROUP BY 1)
SELECT heard, 1 AS tier, n FROM e UNION ALL SELECT heard, 2, n FROM f""")
def sandhi_match(spark: SparkSession, d: str) -> DataFrame:
    """Readings that agree, else agree but for the tone of a first yi or bu."""
    rows = two_syllables(spark, d)
    index = rows.select("p_partkey", B.reading_key("reading").alias("key"), F.when(B.sandhi_first("reading"), B.sandhi_key("reading")).alias("sandhi"))
    heard = index.select(F.regexp_replace("key", "^(yi|bu)[1-4]", "$1" + "2").alias("heard")).distinct().withColumn("loose", F.regexp_replace("heard", "^(yi|bu)[1-4]", "$1"))
    found = M.tiered_match(heard, index, "heard", [([F.col("heard")], [F.col("key")]), ([F.col("loose")], [F.col("sandhi")])])
    return found.groupBy("heard", "tier").agg(F.count("*").alias("n"))


@query("""SELECT p_partkey, list_aggregate(list_filter(list_transform(string_split(regexp_replace(t, '\\[[^\\]]*\\]', '', 'g'), ','), lambda x: trim(x)), lambda x: x <> ''), 'string_agg', '|') AS parts FROM
(SELECT p_partkey, p_brand || '[a, b], ' || p_type || ',, ' || p_name || '[x]' AS t FROM part)""")
def split_outside_brackets(spark: SparkSession, d: str) -> DataFrame:
    """Parts between commas outside brackets."""
    text = F.concat("p_brand", F.lit("[a, b], "), "p_type", F.lit(",, "), "p_name", F.lit("[x]"))
    parts = F.transform(T.outside_brackets(text, ","), lambda p: F.trim(F.regexp_replace(p, r"\[[^\]]*\]", "")))
    return read(spark, d, "part", "p_partkey", "p_brand", "p_type", "p_name").select("p_partkey", F.array_join(parts, "|").alias("parts"))


def sample_lines(spark: SparkSession, d: str) -> DataFrame:
    """(ord, value): source lines made of parts, one form for each remainder of 6."""
    bodies = ["/(coll.) {n}; other (a; b)/CL:個|个[ge4]/", "/old variant of 峰[feng1]/{n}/", "/(bound form)/{n}/see 北京[Bei3 jing1] and 天津[Tian1 jin1]/", "/{n} (Tw, HK)/Taiwan pr. [ji2]/", "/(loanword from Malay 峇迪, batik) {n}/", "/abbr. for Brazil 巴西[Ba1 xi1]/(Tw, biology) {n}/"]
    text = F.element_at(F.array(*(F.lit(b) for b in bodies)), (F.col("p_partkey") % len(bodies) + 1).cast("int"))
    body = F.replace(text, F.lit("{n}"), F.col("p_name"))
    return read(spark, d, "part", "p_partkey", "p_name").select(F.col("p_partkey").alias("ord"), F.concat(F.lit("詞 词 [ci2] "), body).alias("value"))


@query("""SELECT p_partkey AS ord, '词' AS simp, CASE p_partkey % 6 WHEN 1 THEN 2 WHEN 2 THEN 2 WHEN 5 THEN 2 ELSE 1 END AS n_senses, CASE p_partkey % 6 WHEN 0 THEN '个' END AS measure, CASE p_partkey % 6 WHEN 3 THEN 'ji2' END AS tw_pr FROM part""")
def line_parse(spark: SparkSession, d: str) -> DataFrame:
    """Lines as entries."""
    return parse_lines(sample_lines(spark, d)).select("ord", "simp", F.size("senses").alias("n_senses"), F.get("cl", F.lit(0))["w"].alias("measure"), "tw_pr")


@query("""SELECT ord, no, misc, en FROM (SELECT p_partkey AS ord, unnest(CASE p_partkey % 6
WHEN 0 THEN [{'no': 1, 'misc': 'coll', 'en': p_name || '|other (a; b)'}] WHEN 1 THEN [{'no': 1, 'misc': '', 'en': ''}, {'no': 2, 'misc': '', 'en': p_name}]
WHEN 2 THEN [{'no': 1, 'misc': 'bound', 'en': p_name}, {'no': 2, 'misc': '', 'en': ''}] WHEN 3 THEN [{'no': 1, 'misc': 'tw,hk', 'en': p_name}]
WHEN 4 THEN [{'no': 1, 'misc': 'loan', 'en': p_name}] ELSE [{'no': 1, 'misc': '', 'en': 'abbr. for Brazil 巴西[Ba1 xi1]'}, {'no': 2, 'misc': '', 'en': '(Tw, biology) ' || p_name}] END, recursive := true) FROM part)""")
def sense_grammar(spark: SparkSession, d: str) -> DataFrame:
    """Typed senses of lines."""
    senses = parse_lines(sample_lines(spark, d)).select("ord", F.posexplode("senses").alias("p", "s"))
    return senses.select("ord", (F.col("p") + 1).alias("no"), F.array_join("s.misc", ",").alias("misc"), F.array_join("s.en", "|").alias("en"))


@query("""SELECT text, count(*) AS n FROM (SELECT unnest(CASE p_partkey % 6 WHEN 1 THEN ['峰（fēng）の旧字体'] WHEN 2 THEN ['北京（Běi jīng）・天津（Tiān jīn）に同じ'] ELSE [] END) AS text FROM part) GROUP BY text""")
def derived_text(spark: SparkSession, d: str) -> DataFrame:
    """Texts made from references."""
    parsed = parse_lines(sample_lines(spark, d))
    refs = F.flatten(F.transform("senses", lambda s: F.concat(s["variant_of"], s["see_also"])))
    marked = B.marked_map(parsed, F.concat(F.transform(refs, lambda r: r["py"]), F.array(F.col("pinyin"))))
    texts = marked.select(F.explode(F.transform("senses", lambda s: B.derived_text(s, F.col("__marks")))).alias("text"))
    return texts.where("text is not null").groupBy("text").agg(F.count("*").alias("n"))



def event_base(spark: SparkSession, d: str) -> DataFrame:
    """Users as base rows with a sense for each of their events; even events lack a text."""
    fields = {"en": F.array("event_type"), "ja": F.when(F.col("event_id") % 2 == 1, "済"), "misc": F.when(F.col("event_id") % 5 == 0, F.array(F.lit("coll"), F.lit("fig")))}
    sense = F.to_json(F.struct(*(v.alias(k) for k, v in fields.items())))
    rows = read(spark, d, "events", "user_id", "event_id", "event_type").groupBy("user_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("event_id", sense.alias("s")))), lambda x: F.from_json(x["s"], S.SENSE)).alias("senses"))
    given = {"id": F.concat(F.lit("u"), "user_id"), "word": F.concat(F.lit("w"), "user_id"), "pinyin": F.lit("p"), "senses": F.col("senses"), "ord": F.col("user_id"), "seed_gloss": F.when(F.col("user_id") % 2 == 0, F.array(F.lit("甲"), F.lit("乙")))}
    return rows.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], S.BASE).schema))


BASE_SQL = "b AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events), o AS (SELECT * FROM b WHERE event_id % 2 = 0)"


@query(f"""WITH {BASE_SQL}, g AS (SELECT user_id, string_agg('"' || n || '":"' || event_type || '"', ',' ORDER BY n) AS s, string_agg('"' || n || '":"coll,fig"', ',' ORDER BY n) FILTER (event_id % 5 = 0) AS m FROM o GROUP BY 1)
SELECT user_id, '{{"id":"u' || user_id || '","w":"w' || user_id || '","py":"p","s":{{' || s || '}}' || CASE WHEN m IS NULL THEN '' ELSE ',"m":{{' || m || '}}' END || CASE WHEN user_id % 2 = 0 THEN ',"h":"甲、乙"' ELSE '' END || '}}' AS payload FROM g""")
def json_payload(spark: SparkSession, d: str) -> DataFrame:
    """Compact payloads of all senses without a text."""
    open_ = event_base(spark, d).where(F.size(I.pending_numbers(F.col("senses"))) > 0)
    return open_.select(F.col("ord").alias("user_id"), F.to_json(I.payload_item()).alias("payload"))


@query(f"""WITH {BASE_SQL} SELECT user_id, CAST(n AS INTEGER) AS sense, '訳w' || user_id || n AS ja FROM o""")
def inference_run(spark: SparkSession, d: str) -> DataFrame:
    """Calls, answers and their log, run twice: the first run meets a backend that breaks
    off for some, the second asks for the rest (J27, J28, J31, R03, R04, W05, K10)."""
    base, log = materialise(event_base(spark, d)), f"{working_folder(spark, 'log')}/log"  # read several times
    I.run(base, I.FakeBackend(broken="7"), log)
    I.run(base, I.FakeBackend(), log)
    texts = read_log(spark, log)
    merged = I.merge_glosses(base, texts)
    if merged.where(F.size(I.pending_numbers(F.col("senses"))) > 0).count():
        raise ValueError("a sense was left without a text")
    senses = merged.select("ord", F.posexplode("senses").alias("p", "s")).where("s.ja <> '済'")
    return senses.select(F.col("ord").alias("user_id"), (F.col("p") + 1).alias("sense"), F.col("s.ja").alias("ja"))


@query(f"""WITH {BASE_SQL} SELECT user_id, CAST(n AS INTEGER) AS sense, CASE WHEN event_id % 20 = 0 THEN 'third' WHEN event_id % 4 = 0 THEN 'second' ELSE 'first' END AS ja FROM o WHERE NOT event_id % 12 = 0 OR event_id % 20 = 0""")
def log_last_wins(spark: SparkSession, d: str) -> DataFrame:
    """A log of three passes in files of unequal size: of repeated texts the one written last
    holds, whatever order the files are read in; some are taken back (J12, J31, S16)."""
    base, log = event_base(spark, d), f"{working_folder(spark, 'log')}/log"
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = read(spark, d, "events", "user_id", "event_id").withColumn("sense", number).withColumn("id", F.concat(F.lit("u"), "user_id")).where("event_id % 2 = 0")
    keys = ["id", "sense", F.pmod("event_id", F.lit(3)).alias("shard"), F.col("sense").alias("chunk")]
    passes = [(1, "first", rows, 3), (2, "second", rows.where("event_id % 4 = 0"), 1), (3, "third", rows.where("event_id % 20 = 0"), 2)]
    for n, text, own, files in reversed(passes):  # later passes first, so the order of files says nothing
        own.select(*keys, F.lit(text).alias("ja"), F.lit(n).alias("pass")).repartition(files).write.mode("append").json(log)
    rows.where("event_id % 12 = 0").select(*keys, F.lit(2).alias("pass"), F.lit(1).alias("place")).write.mode("append").json(log)
    merged = I.merge_glosses(base, I.log_texts(spark, [log]))
    senses = merged.select("ord", F.posexplode("senses").alias("p", "s")).where("s.ja <> '済' and s.ja <> ''")
    return senses.select(F.col("ord").alias("user_id"), (F.col("p") + 1).alias("sense"), F.col("s.ja").alias("ja"))


def read_log(spark: SparkSession, log: str) -> DataFrame:
    return I.log_texts(spark, [log])


@query(f"""WITH {BASE_SQL}, t AS (SELECT user_id, n, CASE event_id % 6 WHEN 0 THEN '語' WHEN 2 THEN event_type ELSE 'odd' END AS ja FROM o WHERE event_id % 10 <> 0), w AS (SELECT DISTINCT user_id, unnest(regexp_extract_all(lower(event_type), '[a-z]+')) AS token FROM b),
v AS (SELECT 'u' || user_id AS id, CAST(n AS INTEGER) AS sense, CASE WHEN ja <> '語' THEN CASE WHEN EXISTS (SELECT 1 FROM w WHERE w.user_id = t.user_id AND w.token = regexp_extract(ja, '[a-z]+')) THEN 'english-left' ELSE 'latin' END END AS detail FROM t)
SELECT 'violation' AS kind, id, sense, detail FROM v WHERE detail IS NOT NULL UNION ALL SELECT 'missing', 'u' || user_id, CAST(min(n) AS INTEGER), NULL FROM o WHERE event_id % 10 = 0 GROUP BY user_id UNION ALL SELECT 'unknown', 'nobody', NULL, NULL UNION ALL SELECT 'repeated', 'nobody', 1, '2'""")
def inference_verify(spark: SparkSession, d: str) -> DataFrame:
    """What a log lacks, has too much, or has wrong."""
    base, text = event_base(spark, d), event_texts(spark, d)
    extra = spark.createDataFrame([("nobody", 1, "語")] * 2, S.GLOSS)
    return I.verify(base, text.unionByName(extra))[1]


def event_texts(spark: SparkSession, d: str) -> DataFrame:
    """(id, sense, ja): texts of most open senses of event_base(), some of them bad."""
    k = F.col("event_id")
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    ja = F.when(k % 6 == 0, "語").when(k % 6 == 2, F.col("event_type")).otherwise("odd")
    rows = read(spark, d, "events", "user_id", "event_id", "event_type").withColumn("n", number).where((k % 2 == 0) & (k % 10 != 0))
    return rows.select(F.concat(F.lit("u"), "user_id").alias("id"), F.col("n").alias("sense"), ja.alias("ja"))


@query(f"""WITH {BASE_SQL}, t AS (SELECT user_id, n, event_id % 6 <> 0 AS bad FROM o WHERE event_id % 10 <> 0) SELECT CASE WHEN bad AND user_id % 3 = 0 THEN 'dropped' ELSE 'kept' END AS what, count(*) AS n FROM t GROUP BY 1""")
def drop_invalid(spark: SparkSession, d: str) -> DataFrame:
    """Texts that break a rule are taken out of a log, of one's own entries only."""
    base = event_base(spark, d).where("ord % 3 = 0")
    kept, dropped = I.drop_invalid(event_texts(spark, d), own=base)
    return kept.select(F.lit("kept").alias("what")).unionByName(dropped.select(F.lit("dropped").alias("what"))).groupBy("what").agg(F.count("*").alias("n"))


@query(f"""WITH {BASE_SQL} SELECT 'u' || user_id AS id, CAST(n AS INTEGER) AS n, CASE WHEN event_id % 2 = 1 THEN '済' WHEN event_id % 4 = 0 THEN 'new' ELSE 'old' END AS ja, CASE WHEN event_id % 2 = 0 THEN CASE WHEN event_id % 3 = 0 THEN 'llm_fixed' ELSE 'llm_ok' END END AS qa FROM b""")
def gloss_fill(spark: SparkSession, d: str) -> DataFrame:
    """Texts go where there is none, of several the last, and rewritten ones are marked."""
    base, k = event_base(spark, d), F.col("event_id")
    number = F.row_number().over(Window.partitionBy("user_id").orderBy("event_id"))
    rows = read(spark, d, "events", "user_id", "event_id").withColumn("sense", number).withColumn("id", F.concat(F.lit("u"), "user_id"))
    first = rows.select("id", "sense", F.lit("old").alias("ja"), F.lit(1).alias("ord"))
    later = rows.where(k % 4 == 0).select("id", "sense", F.lit("new").alias("ja"), F.lit(2).alias("ord"))
    none = spark.createDataFrame([], "word string, pinyin string, sense int, ja string")
    filled = Z.filled_senses(base, later.unionByName(first), rows.where(k % 3 == 0).select("id", "sense"), none)
    return filled.select("id", "n", F.col("s.ja").alias("ja"), F.col("s.qa").alias("qa"))


@query("""SELECT CASE event_id % 5 WHEN 1 THEN 'ja is of another type' WHEN 2 THEN 'unknown key' WHEN 3 THEN 'no object' ELSE 'the identity is given twice' END AS error, count(*) AS n FROM events WHERE event_id % 5 IN (1, 2, 3) OR event_id % 5 = 4 GROUP BY 1""")
def strict_patch_records(spark: SparkSession, d: str) -> DataFrame:
    """Errors of patch records, an identity given twice among them."""
    word = F.when(F.col("event_id") % 5 == 4, F.concat(F.col("event_id") - 4)).otherwise(F.col("event_id")).cast("string")
    forms = ['{"word":"{w}","ja":"x"}', '{"word":"{w}","ja":1}', '{"word":"{w}","ja":"x","odd":1}', "[{w}]", '{"word":"{w}","ja":"y"}']
    lines = read(spark, d, "events", "event_id").select(F.col("event_id").alias("ord"), F.replace(sample_of("event_id", forms), F.lit("{w}"), word).alias("value"))
    return strict_records(lines, {"word": "STRING", "ja": "STRING"}, {}, ("word",))[1].groupBy("error").agg(F.count("*").alias("n"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL ELSE CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""")
def json_extract_reply(spark: SparkSession, d: str) -> DataFrame:
    """JSON out of fenced, wrapped and broken replies."""
    r = F.col("event_id") % 4
    reply = F.when(r == 0, F.concat(F.lit("text\n```json\n"), "props", F.lit("\n``` more"))).when(r == 1, F.concat(F.lit("so: "), "props", F.lit(" ."))).when(r == 2, F.col("props")).otherwise("{no json")
    value = F.try_variant_get(T.json_from_reply(reply), "$.k", "bigint")
    return read(spark, d, "events", "event_id", "props").select("event_id", value.alias("k"))



@query("SELECT event_id, unnest(string_split(event_type, '_')) AS part, length(event_type) AS n FROM events")
def explode_parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts of all events as rows."""
    return read(spark, d, "events", "event_id", "event_type").select("event_id", F.explode(F.split("event_type", "_")).alias("part"), whole(F.length("event_type")).alias("n"))


# --- the common format and rules ----------------------------------------------------------------


def native_rows(spark: SparkSession, d: str) -> DataFrame:
    """Customers as native rows, with one sense for each of their orders."""
    orders = read(spark, d, "orders", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    n = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    qa = F.when(F.col("o_orderstatus") == "O", "llm_ok").when(F.col("o_orderstatus") == "F", "llm_fixed").otherwise("hand_fixed")
    fields = {"en": F.array("o_orderpriority"), "ja": F.concat(F.lit("訳"), F.col("n")), "qa": qa, "unsure": F.when(F.col("o_orderkey") % 2 == 0, True)}
    senses = orders.withColumn("n", n).select("o_custkey", "n", F.from_json(F.to_json(F.struct(*(v.alias(k) for k, v in fields.items()))), S.SENSE).alias("s"))
    whole_rows = senses.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.transform(F.array_sort(F.collect_list(F.struct("n", F.to_json("s").alias("s")))), lambda x: x["s"]).alias("j"))
    typed = F.transform("j", lambda j: F.from_json(j, S.SENSE))
    rows = read(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey").join(whole_rows, "c_custkey")
    given = {"word": F.col("c_name"), "trad": F.when(F.col("c_nationkey") % 2 == 0, F.col("c_mktsegment")), "pinyin": F.lower("c_mktsegment"), "hsk2": F.when(F.col("c_nationkey") % 3 == 0, F.col("c_nationkey") % 6 + 1).cast("int"), "senses": typed, "ord": F.col("c_custkey")}
    empty = spark.createDataFrame([], S.NATIVE)
    return rows.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in empty.schema))


@query("""SELECT c_custkey AS ord, '["' || c_name || '",' || CASE WHEN c_nationkey % 2 = 0 THEN '"' || c_mktsegment || '"' ELSE 'null' END || ',"' || lower(c_mktsegment) || '"]' AS id FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)""")
def common_ids(spark: SparkSession, d: str) -> DataFrame:
    """Ids of the common format."""
    return C.to_common(native_rows(spark, d)).select("ord", F.col("id.value").alias("id"))



@query("""WITH o AS (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) SELECT c_custkey AS ord, CASE WHEN c_nationkey % 2 = 0 THEN c_name || '|' || c_mktsegment ELSE c_name END AS headwords, lower(c_mktsegment) AS readings,
CASE WHEN c_nationkey % 3 = 0 THEN 'HSK 2.0 ' || (c_nationkey % 6 + 1) ELSE '' END AS levels, k AS n_senses FROM customer JOIN o ON o_custkey = c_custkey""")
def common_map(spark: SparkSession, d: str) -> DataFrame:
    """Headwords, readings, levels and all senses of the common format."""
    c = C.to_common(native_rows(spark, d))
    join = lambda a, f: F.array_join(F.transform(a, f), "|")
    return c.select(
        "ord",
        join("headwords", lambda h: h["text"]).alias("headwords"),
        join("readings", lambda r: r["text"]).alias("readings"),
        join("levels", lambda v: F.concat_ws(" ", v["system"], v["version"], v["value"])).alias("levels"),
        whole(F.size("senses")).alias("n_senses"),
    )





@query("""SELECT CASE o_orderstatus WHEN 'O' THEN 'llm' WHEN 'F' THEN 'llm' ELSE 'manual_override' END AS method, CASE o_orderstatus WHEN 'O' THEN 'llm_ok' WHEN 'F' THEN 'llm_fixed' ELSE 'hand_fixed' END AS qa,
'script_and_length' AS evidence, o_orderkey % 2 = 0 AS uncertain, count(*) AS n FROM orders GROUP BY ALL""")
def provenance_dim(spark: SparkSession, d: str) -> DataFrame:
    """Origins and evidence of all translations."""
    return provenance_counts(C.to_common(native_rows(spark, d)))


def provenance_counts(common: DataFrame) -> DataFrame:
    t = common.select(F.explode("senses").alias("s")).select(F.explode("s.translations").alias("t"))
    return t.groupBy(F.col("t.provenance.method").alias("method"), F.col("t.provenance.source_value").alias("qa"), F.get("t.verification", F.lit(0))["method"].alias("evidence"), F.col("t.uncertain").alias("uncertain")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey AS ord, 'different' AS error FROM customer WHERE c_custkey % 97 = 0 AND c_custkey IN (SELECT o_custkey FROM orders)")
def preservation_proof(spark: SparkSession, d: str) -> DataFrame:
    """Common rows that are not what the native ones map to."""
    native = native_rows(spark, d)
    damaged = C.to_common(native).withColumn("levels", F.when(F.col("ord") % 97 == 0, F.array(F.struct(F.lit("X").alias("system"), F.lit("1").alias("version"), F.lit("1").alias("value")))).otherwise(F.col("levels")))
    return C.preservation_errors(native, damaged)


@query("""WITH v AS (SELECT 'long-text' AS kind, doc_id AS line FROM documents WHERE n_chars > 5000 UNION ALL SELECT 'repeated-text', doc_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(text)) AS f FROM documents) WHERE doc_id > f
UNION ALL SELECT 'card-number', doc_id FROM documents WHERE regexp_matches(text, '[0-9]{16}') UNION ALL SELECT 'unknown-value', doc_id FROM documents WHERE lang NOT IN ('en', 'de', 'fr'))
SELECT kind, count(*) AS n, min(line) AS first_line FROM v GROUP BY kind""")
def violations_report(spark: SparkSession, d: str) -> DataFrame:
    """A registry of rules over rows and groups, as violations (section 2.13, A07)."""
    documents = read(spark, d, "documents", "doc_id", "lang", "text", "n_chars").withColumn("h", F.md5("text"))
    rules = [R.when(F.col("n_chars") > 5000, "long-text", F.col("n_chars")), R.when(F.rlike("text", F.lit("[0-9]{16}")), "card-number", "text"), R.when(~F.col("lang").isin("en", "de", "fr"), "unknown-value", F.col("lang"))]
    rows = R.explode_rules(documents, "documents", "doc_id", "lang", rules)
    repeated = O.repeats_with_first(documents.select("doc_id", "lang", "h"), ["h"], "doc_id").select(*R.violation("documents", F.col("doc_id"), F.col("lang"), F.lit("repeated-text"), F.col("first_line")))
    return rows.unionByName(repeated).groupBy("kind").agg(F.count("*").alias("n"), F.min("line").alias("first_line"))


# Sample readings with the rule each breaks.
READINGS = [("shàng jí", None), ("", "empty-pinyin"), (" hǎo", "whitespace"), ("yījǐnr645guī", "bad-pinyin"), ("rт", "bad-pinyin"), ("Shuāng 11", None), ("a:b", None), (":a", None), ("nu:3", "bad-pinyin"), ("LU:e4", "bad-pinyin"), ("F1 zá", None), ("F2 zá", "bad-pinyin"), ("yī １", "bad-pinyin"), ("β nèi", None)]
READINGS_SQL = ", ".join(f"({n}, {'NULL' if k is None else repr(k)})" for n, (_, k) in enumerate(READINGS))


@query(f"SELECT kind, count(*) AS n, min(event_id) AS first_line FROM events JOIN (VALUES {READINGS_SQL}) r(n, kind) ON n = event_id % {len(READINGS)} WHERE kind IS NOT NULL GROUP BY kind")
def reading_whitelist(spark: SparkSession, d: str) -> DataFrame:
    """What readings may hold."""
    rows = read(spark, d, "events", "event_id").withColumn("pinyin", sample_of("event_id", [r for r, _ in READINGS]))
    return R.explode_rules(rows, "events", "event_id", "pinyin", R.reading_rules("pinyin")).groupBy("kind").agg(F.count("*").alias("n"), F.min("line").alias("first_line"))


def plain_rows(spark: SparkSession, d: str, **changed: Column) -> DataFrame:
    """Customers as native rows that break no rule, with some columns changed."""
    letters = F.translate(F.col("c_custkey").cast("string"), "0123456789", "abcdefghij")
    sense = F.from_json(F.lit('{"ja": "語", "qa": "llm_ok", "en": ["word"]}'), S.SENSE)
    given = {"word": F.concat("c_mktsegment", "c_nationkey", F.lit(" ")), "pinyin": letters, "senses": F.array(sense), "ord": F.col("c_custkey"), "default": F.when(F.col("c_custkey") % 50 == 0, True)}
    given["word"] = F.concat("c_mktsegment", F.lit("-"), F.col("c_nationkey").cast("string"))
    given |= changed
    rows = read(spark, d, "customer", "c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    return rows.select(*(given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in spark.createDataFrame([], S.NATIVE).schema))


@query("""WITH w AS (SELECT c_mktsegment || '-' || c_nationkey AS word, count(*) AS n, min(c_custkey) AS line, count(*) FILTER (c_custkey % 50 = 0) AS defaults FROM customer GROUP BY 1)
SELECT word, line, CASE WHEN n > 1 AND defaults = 0 THEN 'missing-default' ELSE 'duplicate-default' END AS kind FROM w WHERE n > 1 AND defaults = 0 OR defaults > 1""")
def default_rules(spark: SparkSession, d: str) -> DataFrame:
    """Words of several rows without a default, or with several."""
    return R.native_violations(plain_rows(spark, d)).select("word", "line", "kind")


# Faults of the rows whose number leaves the first value by 29, with the rule.
FAULTS_SQL = "(1, 'bad-hsk'), (2, 'redundant-trad'), (3, 'unknown-value'), (4, 'duplicate-item'), (5, 'bad-ja'), (6, 'bad-qa'), (7, 'explicit-false'), (8, 'missing-primary'), (9, 'bad-primary'), (10, 'bad-pinyin'), (11, 'whitespace'), (12, 'text-in-ref'), (13, 'bad-kind'), (14, 'missing-key'), (15, 'bad-default'), (16, 'empty-array')"


@query(f"SELECT kind, count(*) AS n, min(c_custkey) AS first_line FROM customer JOIN (VALUES {FAULTS_SQL}) f(k, kind) ON k = c_custkey % 29 GROUP BY kind")
def native_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules of native rows, each broken by some (section 2.13)."""
    k = F.col("c_custkey") % 29
    sense = lambda **more: F.from_json(F.lit(json.dumps({"ja": "語", "qa": "llm_ok", **more})), S.SENSE)
    one = lambda s: F.array(s)
    senses = {5: one(sense(ja="hello")), 6: one(sense(qa="odd")), 7: one(sense(unsure=False)), 8: F.array(sense(), sense(ja="別")), 13: one(sense(see_also=[{"kind": "odd", "w": "a"}])), 14: one(sense(ja=None)), 16: one(sense(en=[]))}
    chosen = one(sense())
    for n, value in senses.items():
        chosen = F.when(k == n, value).otherwise(chosen)
    letters = F.translate(F.col("c_custkey").cast("string"), "0123456789", "abcdefghij")
    rows = plain_rows(
        spark, d, word=F.col("c_name"), senses=chosen, hsk2=F.when(k == 1, 9), trad=F.when(k == 2, F.col("c_name")), pos=F.when(k == 3, F.array(F.lit("zz"))).when(k == 4, F.array(F.lit("n"), F.lit("n"))), primary=F.when(k == 9, 1),
        pinyin=F.when(k == 10, F.concat(letters, F.lit("u:"))).when(k == 11, F.concat(letters, F.lit(" "))).otherwise(letters), cl=F.when(k == 12, F.array(F.from_json(F.lit('{"w": "a b"}'), S.CL))), default=F.when(k == 15, False),
    )
    return R.native_violations(rows).groupBy("kind").agg(F.count("*").alias("n"), F.min("line").alias("first_line"))


@query("""WITH w AS (SELECT c_mktsegment || '-' || c_nationkey AS word, c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 3 ELSE 2 END AS hsk2 FROM customer), seed AS (SELECT DISTINCT word FROM w UNION ALL SELECT 'lost-' || n_nationkey FROM nation)
SELECT 'hsk-not-kept' AS kind, word, count(*) AS n FROM w WHERE hsk2 <> 2 GROUP BY word UNION ALL SELECT 'hsk-word-missing', word, 1 FROM seed WHERE word LIKE 'lost-%'
UNION ALL SELECT 'skeleton-count-mismatch', NULL, 1""")
def level_rules(spark: SparkSession, d: str) -> DataFrame:
    """Levels of a seed that rows lost, and the number of rows (section 2.13, J23)."""
    rows = plain_rows(spark, d, hsk2=F.when(F.col("c_custkey") % 7 == 0, 3).otherwise(2))
    lost = read(spark, d, "nation", "n_nationkey").select(F.concat(F.lit("lost-"), "n_nationkey").alias("word"))
    seed = rows.select("word").distinct().unionByName(lost).withColumns({"hsk2": F.lit(2), "hsk3": F.lit(None).cast("int")})
    found = R.level_violations(rows, seed).unionByName(R.skeleton_violations(rows, -1))
    return found.groupBy("kind", "word").agg(F.count("*").alias("n"))


@query("""SELECT kind, count(*) AS n FROM (SELECT unnest(CASE event_id % 4 WHEN 0 THEN ['unknown-key', 'retired-key'] WHEN 1 THEN ['unknown-key', 'missing-key', 'bad-ja'] WHEN 2 THEN ['bad-hsk', 'bad-primary', 'bad-type'] ELSE [] END) AS kind FROM events) GROUP BY kind""")
def key_rules(spark: SparkSession, d: str) -> DataFrame:
    """Keys and types of raw lines, down to senses and references (section 2.13)."""
    sense = '{"ja": "語", "qa": "llm_ok"}'
    lines = [f'{{"word": "a", "pinyin": "a", "odd": 1, "gloss": 2, "senses": [{sense}]}}', '{"word": "a", "pinyin": "a", "senses": [{"ja": 3, "see_also": [{"kind": "see", "w": "b", "x": 1}]}]}', f'{{"word": "a", "pinyin": "a", "hsk2": "1", "primary": 1.5, "pos": "n", "senses": [{sense}]}}', f'{{"word": "a", "pinyin": "a", "senses": [{sense}]}}']
    raw = read(spark, d, "events", "event_id").select(F.col("event_id").alias("line"), sample_of("event_id", lines).alias("value"))
    return R.key_violations(raw).groupBy("kind").agg(F.count("*").alias("n"))


@query("""SELECT kind, count(*) AS n FROM (SELECT unnest(CASE event_id % 4 WHEN 0 THEN ['foreign-latin', 'foreign-latin'] WHEN 1 THEN ['kana-in-chinese', 'no-han', 'bad-pinyin'] WHEN 2 THEN ['no-han', 'missing-key'] ELSE [] END) AS kind FROM events) GROUP BY kind""")
def reverse_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules of the other direction with its allowlists (section 2.13)."""
    candidates = ['[{"s": "word别odd", "pinyin": "a"}]', '[{"s": "かな", "pinyin": "u:"}]', '[{"s": "☰"}]', '[{"s": "の字", "pinyin": "a"}, {"s": "DNA", "pinyin": "b"}]']
    zh = F.from_json(sample_of("event_id", candidates), "array<struct<s: string, pinyin: string>>")
    rows = read(spark, d, "events", "event_id").select(F.col("event_id").alias("ord"), F.col("event_id").cast("string").alias("word"), zh.alias("zh"), F.lit(None).cast("boolean").alias("unsure"))
    return R.reverse_violations(rows, allowed_latin=["DNA"], allowed_kana=["の字"]).groupBy("kind").agg(F.count("*").alias("n"))


@query("""WITH c AS (SELECT count(*) AS n FROM events) SELECT kind, detail FROM (VALUES ('bad-schema-version', '1'), ('sources-mismatch', 'sources'), ('unknown-file', 'other'), ('missing-key', 'events: senses'), ('retired-file', 'old')) v(kind, detail)
UNION ALL SELECT 'line-count-mismatch', 'events: 0 of ' || n FROM c""")
def manifest_rules(spark: SparkSession, d: str) -> DataFrame:
    """Rules of a manifest (section 2.13)."""
    n = read(spark, d, "events", "event_id").count()
    held = {"schema_version": 1, "generated": "today", "sources": {}, "files": {"events": {"lines": 0}, "other": {}}}
    found = R.manifest_violations(json.dumps(held), {"events": n}, {"events": {"senses": n}}, {"a": 1}, lambda f: True, ("old",))
    return spark.createDataFrame([(v[3], v[4]) for v in found], "kind string, detail string")


# --- logs, streams, containers --------------------------------------------------------------


@query("""WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS r FROM lineitem)
SELECT count(*) FILTER (r = 1) AS merged, count(*) FILTER (r > 1) AS repeated, CAST(sum(l_partkey) FILTER (r = 1) AS BIGINT) AS parts, (SELECT count(*) FROM lineitem WHERE l_linenumber = 7) AS broken FROM a""")
def merge_logs(spark: SparkSession, d: str) -> DataFrame:
    """Logs read though lines are cut off, and merged: the first of repeated rows wins."""
    lines, place = read(spark, d, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"), working_folder(spark, "logs")
    text = F.to_json(F.struct(*lines.columns))
    lines.where("l_linenumber % 2 = 0").select(text.alias("value")).write.text(f"{place}/even")
    cut = lines.where("l_linenumber = 7").select(F.substring(text, 1, 20).alias("value"))
    lines.where("l_linenumber % 2 = 1").select(text.alias("value")).unionByName(cut).write.text(f"{place}/odd")
    rows, broken = log_rows(spark, [f"{place}/even", f"{place}/odd", f"{place}/absent"], "l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint")
    merged = rows.groupBy("l_orderkey", "l_linenumber").agg(F.min(F.struct("l_partkey", "l_suppkey"))["l_partkey"].alias("part"), F.count("*").alias("n"))
    totals = merged.agg(F.count("*").alias("merged"), (F.sum("n") - F.count("*")).alias("repeated"), F.sum("part").alias("parts"))
    return totals.join(F.broadcast(broken.agg(F.count("*").alias("broken"))))  # one row each


CHOICES_SQL = """n AS (SELECT event_id, user_id, event_id % 3 + 1 AS k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS row FROM events), c AS (SELECT event_id AS ord, user_id, event_id % 5 + 1 AS row, event_id % 3 + 1 AS sense, event_id % 4 = 0 AS d FROM events),
m AS (SELECT c.ord, n.user_id, n.event_id, n.row, c.sense, n.k, c.d FROM c JOIN n USING (user_id, row)), p AS (SELECT *, row_number() OVER (PARTITION BY user_id, row ORDER BY ord) AS r FROM m WHERE sense <= k AND k > 1)"""


def event_choices(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """(native rows, choices): a row an event, with up to three senses, under its user."""
    e = read(spark, d, "events", "event_id", "user_id")
    senses = F.transform(F.sequence(F.lit(1), (F.col("event_id") % 3 + 1).cast("int")), lambda i: F.struct(F.concat(F.lit("s"), i).alias("ja"), F.array().cast("array<string>").alias("en")))
    word = F.concat(F.lit("u"), "user_id").alias("word")
    native = e.select(word, F.lit(None).cast("string").alias("trad"), F.concat(F.lit("p"), "event_id").alias("pinyin"), senses.alias("senses"), F.col("event_id").alias("ord"))
    k = F.col("event_id")
    choices = e.select(k.alias("ord"), word, (k % 5 + 1).cast("int").alias("row"), (k % 3 + 1).cast("int").alias("sense"), (k % 4 == 0).alias("default"))
    return native, choices


@query(f"WITH {CHOICES_SQL} SELECT 'u' || user_id AS word, 'p' || event_id AS pinyin, CAST(sense AS INTEGER) AS sense, 's' || sense AS ja FROM p WHERE r = 1")
def model_choice(spark: SparkSession, d: str) -> DataFrame:
    """Choices whose word, row and sense exist, the first for each."""
    native, choices = event_choices(spark, d)
    return I.accept_choices(choices, native)[0].select("word", "pinyin", "sense", "ja")


@query("""WITH n AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS r, (SELECT string_agg('{"ja":"s' || i || '"}', ',' ORDER BY i) FROM range(1, event_id % 3 + 2) t(i)) AS s, event_id % 3 + 1 AS k FROM events WHERE user_id % 3 = 0)
SELECT 'u' || user_id AS word, min(event_id) AS at, '{"w":"u' || user_id || '","rows":[' || string_agg('{"r":' || r || ',"pinyin":"p' || event_id || '","s":[' || s || ']}', ',' ORDER BY event_id) || ']}' AS payload FROM n GROUP BY user_id HAVING count(*) > 1 OR max(k) > 1""")
def choice_payloads(spark: SparkSession, d: str) -> DataFrame:
    """What is asked for words of a list that have several rows or senses."""
    native, _ = event_choices(spark, d)
    listed = read(spark, d, "events", "user_id").where("user_id % 3 = 0").select(F.concat(F.lit("u"), "user_id").alias("word"))
    return I.choose_groups(native, listed).select("word", F.col("at").cast("bigint").alias("at"), "payload")


@query(f"""WITH {CHOICES_SQL}, w AS (SELECT user_id FROM n WHERE k >= 2 AND NOT EXISTS (SELECT 1 FROM p WHERE p.r = 1 AND p.event_id = n.event_id AND p.event_id % 7 <> 0)
UNION SELECT user_id FROM n GROUP BY user_id HAVING count(*) >= 2 AND user_id NOT IN (SELECT user_id FROM m WHERE d)) SELECT 'u' || user_id AS word FROM w""")
def choice_resume(spark: SparkSession, d: str) -> DataFrame:
    """Words to ask about again: choices that are lacking, or whose text has changed."""
    native, choices = event_choices(spark, d)
    primary, default = I.accept_choices(choices, native)
    changed = F.substring("pinyin", 2, 20).cast("bigint") % 7 == 0
    return I.pending_choices(native, primary.withColumn("ja", F.when(changed, "old").otherwise(F.col("ja"))), default)


def changed_events(native: DataFrame, d: str) -> tuple[DataFrame, DataFrame]:
    """Native rows before and after a change: some words come, rows go, texts differ."""
    user, event = F.substring("word", 2, 20).cast("bigint"), F.col("ord")
    before = native.where(user % 50 != 5)
    other = F.transform("senses", lambda s: s.withField("ja", F.concat(s["ja"], F.lit("!"))))
    after = native.where(~((user % 10 == 4) & (event % 13 == 5))).withColumn("senses", F.when((user % 10 == 3) & (event % 11 == 0), other).otherwise(F.col("senses")))
    return before, after


@query(f"""WITH {CHOICES_SQL}, a AS (SELECT * FROM n WHERE NOT (user_id % 10 = 4 AND event_id % 13 = 5)), s AS (SELECT event_id FROM p WHERE r = 1 AND user_id % 50 <> 5 AND NOT (user_id % 10 = 3 AND event_id % 11 = 0)),
f AS (SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ord) AS q FROM m WHERE d AND user_id % 50 <> 5) WHERE q = 1),
w AS (SELECT user_id FROM a WHERE k >= 2 AND event_id NOT IN (SELECT event_id FROM s) UNION SELECT user_id FROM a GROUP BY user_id HAVING count(*) >= 2 AND count(*) FILTER (event_id IN (SELECT event_id FROM f)) = 0) SELECT 'u' || user_id AS word FROM w""")
def choices_again(spark: SparkSession, d: str) -> DataFrame:
    """Words to ask about after a change, out of what was to be asked before it and the digests of
    then; only words that the change touches are looked at (J33, R03)."""
    native, choices = event_choices(spark, d)
    before, after = changed_events(native, d)
    primary, default = (materialise(df) for df in I.accept_choices(choices, before))
    kept, state = materialise(I.pending_choices(before, primary, default)), materialise(I.choice_state(before, primary, default))
    return I.pending_choices_again(after, primary, default, kept, state)[0]


@query("""SELECT event_id AS ord, 'u' || user_id AS word FROM events WHERE NOT (user_id % 10 = 4 AND event_id % 13 = 5) AND user_id IN (SELECT user_id FROM events
WHERE user_id % 50 = 5 OR (user_id % 10 = 4 AND event_id % 13 = 5) OR (user_id % 10 = 3 AND event_id % 11 = 0) OR (user_id % 10 = 6 AND event_id % 17 = 2))""")
def entries_again(spark: SparkSession, d: str) -> DataFrame:
    """Entries to validate again: all of words of which an entry or a text is new, changed or gone
    (R03, R04)."""
    native, _ = event_choices(spark, d)
    before, after = (df.select("pinyin", "word", "senses", "ord").withColumnRenamed("pinyin", "id") for df in changed_events(native, d))
    texts = before.select("id", F.lit(1).alias("sense"), F.lit("a").alias("ja"))
    user, event = F.substring("word", 2, 20).cast("bigint"), F.substring("id", 2, 20).cast("bigint")
    fixed = before.where((user % 10 == 6) & (event % 17 == 2)).select("id", F.lit(2).alias("sense"), F.lit("b").alias("ja"))
    state = materialise(I.entry_state(before, texts))
    still = texts.join(after.select("id"), "id", "left_semi")
    return I.to_validate_again(after, still.unionByName(fixed), before, state).select("ord", "word")


@query("SELECT user_id, event_type, coalesce(min(event_id) FILTER (event_id % 2 = 0), min(event_id)) AS first_event FROM events GROUP BY user_id, event_type")
def stream_resume(spark: SparkSession, d: str) -> DataFrame:
    """An appended log followed by a stream that ends and goes on; of keys that come again, in
    one batch or a later one, the first row wins (R03, K10)."""
    place = working_folder(spark, "stream")
    events = read(spark, d, "events", "event_id", "user_id", "event_type")
    for part in (0, 1):
        events.where(F.col("event_id") % 2 == part).repartition(2, "event_id").write.mode("append").json(f"{place}/log")
        stream = follow_log(spark, f"{place}/log", "event_id bigint, user_id bigint, event_type string")
        append_once(stream, ["user_id", "event_type"], ["event_id"], f"{place}/held", f"{place}/checkpoint").awaitTermination()
    return held(spark, f"{place}/held").select("user_id", "event_type", F.col("event_id").alias("first_event"))


@query("""WITH c AS (SELECT click_id, client_id, kind, CAST(floor(epoch(ts)) AS BIGINT) AS s, arrived_at >= TIMESTAMP '2024-03-15' AS later FROM clicks WHERE ts IS NOT NULL AND client_id IS NOT NULL AND kind IS NOT NULL AND click_id IS NOT NULL AND arrived_at IS NOT NULL),
d AS (SELECT *, s - s % 86400 AS day_s FROM c), k AS (SELECT * FROM d WHERE NOT later OR day_s + 86400 > coalesce((SELECT max(s) FROM d WHERE NOT later) - 7200, 0))
SELECT client_id, kind, day_s, arg_min(click_id, (later, s, click_id)) AS first_click FROM k GROUP BY client_id, kind, day_s""")
def stream_days(spark: SparkSession, d: str) -> DataFrame:
    """The first click of a kind of each client and day, out of a log that is read twice; days are
    forgotten two hours after their end, and what comes for them later is dropped (R03, K10)."""
    place = working_folder(spark, "stream")
    whole_clicks = read(spark, d, "clicks", "click_id", "client_id", "kind", "ts", "arrived_at").dropna()
    seconds = lambda c: F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(c).cast("timestamp_ntz"))
    clicks = whole_clicks.select("click_id", "client_id", "kind", seconds("ts").alias("at"), (seconds("arrived_at") >= 1710460800).alias("later"))
    for later in (False, True):
        clicks.where(F.col("later") == later).drop("later").write.mode("append").json(f"{place}/log")
        stream = follow_log(spark, f"{place}/log", "click_id bigint, client_id bigint, kind string, at bigint").withColumn("time", F.timestamp_seconds("at"))
        append_once(stream, ["client_id", "kind"], ["at", "click_id"], f"{place}/held", f"{place}/checkpoint", at="time", late="2 hours").awaitTermination()
    return held(spark, f"{place}/held").select("client_id", "kind", (F.col("at") - F.col("at") % 86400).alias("day_s"), F.col("click_id").alias("first_click"))


@query("SELECT row_number() OVER (ORDER BY user_id, event_id) AS line, event_id, user_id, event_type FROM events")
def dump_in_parts(spark: SparkSession, d: str) -> DataFrame:
    """An ordered dump that many tasks write and digest, which takes the place of an earlier one
    once its parts are found to be what the manifest says (K03, K05-K08, U06, C12)."""
    events, place = read(spark, d, "events", "event_id", "user_id", "event_type"), working_folder(spark, "dump")
    lines = A.json_line(events.withColumn("ord", F.struct("user_id", "event_id")), ["event_id", "user_id", "event_type"])
    PT.publish(lines.where("ord.event_id % 3 = 0"), place)
    PT.publish(lines, place, part_bytes=1 << 20)
    if (wrong := PT.faults(spark, place).first()) is not None:
        raise ValueError(f"{wrong.part}: {wrong.fault}")
    return PT.lines_of(spark, place).select(F.col("ord").alias("line"), F.from_json("value", "event_id bigint, user_id bigint, event_type string").alias("r")).select("line", "r.*")


@query("SELECT event_id, user_id, event_type FROM events")
def raw_deflate_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    """All events compressed in order by many tasks and read by as many."""
    events, place = read(spark, d, "events", "event_id", "user_id", "event_type"), working_folder(spark, "container")
    lines = A.json_line(events.withColumn("ord", F.col("event_id")), ["event_id", "user_id", "event_type"])
    write_segments(lines, place, "ord")
    if segment_sizes(spark, place).expanded != lines.agg(F.sum(F.octet_length("value") + 1)).first()[0]:
        raise ValueError("the container is not of the size that was written")
    return read_segments(spark, place).select(F.from_json("value", "event_id bigint, user_id bigint, event_type string").alias("r")).select("r.*")


@query("""SELECT CASE WHEN s = 2 THEN 'lost' ELSE 'read' END AS what, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids, min(line) AS first_line, max(line) AS last_line
FROM (SELECT event_id, event_id % 4 AS s, row_number() OVER (ORDER BY event_id % 4, event_id) AS line FROM events) GROUP BY 1""")
def container_damage(spark: SparkSession, d: str) -> DataFrame:
    """A container in four parts, the segments of one of them damaged: their places are told, the others are read."""
    events, place = read(spark, d, "events", "event_id").withColumn("s", F.col("event_id") % 4), working_folder(spark, "container")
    for s in range(4):
        own = events.where(F.col("s") == s).select("event_id", F.col("event_id").alias("ord"))
        write_segments(A.json_line(own, ["event_id"]), f"{place}/{s}", "ord", segment_bytes=1 << 16)
    every = functools.reduce(DataFrame.unionByName, [spark.read.parquet(f"{place}/{s}").withColumn("part", F.lit(s << 20) + F.col("part")) for s in range(4)])
    torn = F.when(F.shiftright("part", 20) == 2, F.concat(F.expr("substring(content, 1, cast(bytes / 2 as int))"), F.unhex(F.lit("FFFF")))).otherwise(F.col("content"))
    every.withColumn("content", torn).write.parquet(f"{place}/torn")
    lines = read_segments(spark, f"{place}/torn", permissive=True)
    told = F.regexp_extract("detail", "lines ([0-9]+) to ([0-9]+):", 1).cast("bigint"), F.regexp_extract("detail", "lines ([0-9]+) to ([0-9]+):", 2).cast("bigint")
    lost = R.archive_violations(lines).where("kind = 'broken-archive'").agg(F.min(told[0]).alias("first_line"), F.max(told[1]).alias("last_line")).join(events.where("s = 2").agg(F.count("*").alias("n"), F.sum("event_id").alias("ids")))
    held = lines.where("error is null").select("ord", F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"))
    kept = held.agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"), F.min("ord").alias("first_line"), F.max("ord").alias("last_line"))
    return kept.select(F.lit("read").alias("what"), "n", "ids", "first_line", "last_line").unionByName(lost.select(F.lit("lost").alias("what"), "n", "ids", "first_line", "last_line"))


@query("SELECT sha256(text) AS digest, count(*) AS n, min(doc_id) AS first_doc FROM documents GROUP BY 1")
def content_digests(spark: SparkSession, d: str) -> DataFrame:
    """Digests of contents."""
    return read(spark, d, "documents", "doc_id", "text").groupBy(F.sha2(F.col("text"), 256).alias("digest")).agg(F.count("*").alias("n"), F.min("doc_id").alias("first_doc"))


@query("""WITH l AS (SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' || chr(10) AS line FROM events) SELECT count(*) AS n, sha256(string_agg(line, '' ORDER BY event_id)) AS digest FROM l""")
def ordered_dump(spark: SparkSession, d: str) -> DataFrame:
    """An ordered dump of JSON lines and its digest."""
    path = local_folder(spark) / "dump.jsonl"
    n = A.dump(read(spark, d, "events", "event_id", "event_type").withColumn("ord", F.col("event_id")), ["event_id", "event_type"], path)
    return spark.createDataFrame([(n, A.digest(path))], "n bigint, digest string")


@query("""SELECT rank, id, (SELECT count(*) FROM part) AS declared FROM (SELECT 'c' || p_partkey AS id, row_number() OVER (ORDER BY p_size DESC, p_partkey) AS rank FROM part)""")
def order_table(spark: SparkSession, d: str) -> DataFrame:
    """An order written as a table and a list of ids and read again, beside a file whose header declares its entries."""
    folder, parts = local_folder(spark), read(spark, d, "part", "p_partkey", "p_size", "p_name")
    plan = O.global_ordinal(parts.select(F.concat(F.lit("c"), "p_partkey").alias("id"), F.col("p_name").alias("word"), F.lit(1).alias("senses"), "p_size", "p_partkey"), F.desc("p_size"), "p_partkey", name="position")
    A.write_order(plan, folder / "order.tsv")
    A.write_ids(plan, folder / "ids.txt")
    table, listed = (ids(text_lines(spark, f"file://{folder / name}")) for name in ("order.tsv", "ids.txt"))
    lines = sample_lines(spark, d)
    A.write_rows(folder / "lines.txt", lines, "ord", F.col("value"), ["# parts", f"#! entries={parts.count()}"])
    written = text_lines(spark, f"file://{folder / 'lines.txt'}")
    declared = check_declared(written, parse_lines(written))
    return table.select("id", (F.col("rank") - 1).alias("rank")).join(listed, ["id", "rank"]).withColumn("declared", F.lit(declared).cast("bigint"))


@query("SELECT CAST(split_part(s, '/', 1) AS INTEGER) AS index, CAST(split_part(s, '/', 2) AS INTEGER) AS total, count(*) AS n FROM (SELECT (o_orderkey % 4) || '/4' AS s FROM orders) GROUP BY ALL")
def shard_specs(spark: SparkSession, d: str) -> DataFrame:
    """Shard specifications, which count from 0."""
    index, total = O.parse_shard(F.concat(F.col("o_orderkey") % 4, F.lit("/4")))
    return read(spark, d, "orders", "o_orderkey").groupBy(index.alias("index"), total.alias("total")).agg(F.count("*").alias("n"))


# Messages of a service, and whether they say that its limit is reached.
MESSAGES = [("Error: Rate limit reached", True), ("fine", False), ("At capacity, try later", True), ("rate-limit", False), ("RATE_LIMIT", True), ("code 429", True), ("Usage Limit", True), ("overload", False)]
MESSAGES_SQL = ", ".join(f"({n}, {limited})" for n, (_, limited) in enumerate(MESSAGES))


@query(f"SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'a、b' WHEN 1 THEN 'c、d' ELSE 'e' END AS text, limited FROM events JOIN (VALUES {MESSAGES_SQL}) m(n, limited) ON n = event_id % {len(MESSAGES)}")
def normalised_texts(spark: SparkSession, d: str) -> DataFrame:
    """Commas unified, ends trimmed, limit messages recognised."""
    r = F.col("event_id") % 3
    raw = F.when(r == 0, " a,b ").when(r == 1, "c，d　").otherwise("e")
    return read(spark, d, "events", "event_id").select("event_id", T.normalised(raw).alias("text"), T.looks_rate_limited(sample_of("event_id", [m for m, _ in MESSAGES])).alias("limited"))


# --- scans and sinks of whole files -----------------------------------------------------------


@query("""SELECT 'seed' AS source, p_brand AS word, arg_max_null(CASE WHEN p_size <= 6 THEN p_size END, p_partkey) AS level, min(p_partkey) AS first_at FROM part GROUP BY p_brand
UNION ALL SELECT 'frequency', p_brand, CAST(max_by(p_size, p_partkey) AS INTEGER), NULL FROM part GROUP BY p_brand""")
def seed_scans(spark: SparkSession, d: str) -> DataFrame:
    """A seed in one JSON document and a table of frequencies with odd lines; the last value
    of a word holds (S10, S11, A10)."""
    place, parts = working_folder(spark, "seeds"), read(spark, d, "part", "p_partkey", "p_brand", "p_size")
    level = F.when(F.col("p_size") <= 6, F.col("p_size"))
    entry = F.to_json(F.struct(F.col("p_brand").alias("word"), F.lit("p").alias("pinyin"), F.lit("n, unknown,n").alias("pos"), F.struct(level.alias("2.0")).alias("hsk_levels")))
    write_document(parts.select(F.col("p_partkey").alias("ord"), entry.alias("value")), f"{place}/seed", '{"metadata": {"version": "1"}, "entries": [', "]}")
    parts.repartitionByRange("p_partkey").sortWithinPartitions("p_partkey").select(F.concat(F.lit("odd line\nalone\n"), F.concat_ws(" ", "p_brand", F.col("p_size").cast("string"), F.lit("n")))).write.text(f"{place}/words")
    first = parts.groupBy("p_brand").agg(F.min("p_partkey").alias("first_at"))
    seed = hsk_seed(spark, f"{place}/seed").where(F.array_join("pos", ",") == "n")
    both = seed.join(first, seed.word == first.p_brand).select(F.lit("seed").alias("source"), "word", F.col("hsk2").alias("level"), "first_at")
    freq = frequencies(text_lines(spark, f"{place}/words")).where("word <> 'odd'")
    return both.unionByName(freq.select(F.lit("frequency").alias("source"), "word", F.col("freq").cast("int").alias("level"), F.lit(None).cast("bigint").alias("first_at")))


def write_document(rows: DataFrame, place: str, head: str, tail: str) -> None:
    """Rows (ord, value) as one JSON document in files by name, written by as many tasks."""
    ends = rows.agg(F.min("ord").alias("first"), F.max("ord").alias("last"))
    placed = rows.join(F.broadcast(ends)).repartitionByRange("ord").sortWithinPartitions("ord")  # one row is broadcast
    write_placed(placed, F.col("ord") == F.col("first"), F.col("ord") == F.col("last"), place, head, tail)


def write_placed(rows: DataFrame, first: Column, last: Column, place: str, head: str, tail: str) -> None:
    """Values as one JSON document in the order in which tasks hold them."""
    rows.select(F.concat(F.when(first, head).otherwise(","), "value", F.when(last, tail).otherwise("")).alias("value")).write.text(place)


@query("""WITH s AS (SELECT l_partkey, l_orderkey, CAST(sum(CAST(l_quantity AS BIGINT) % 4) AS BIGINT) AS n FROM lineitem GROUP BY ALL)
SELECT 'p' || l_partkey AS title, max(n) AS definitions FROM s GROUP BY l_partkey""")
def reference_definitions(spark: SparkSession, d: str) -> DataFrame:
    """The greatest number of definitions of each title, from one JSON array that ranges of its bytes are read of."""
    lines, place, keys = read(spark, d, "lineitem", "l_partkey", "l_orderkey", "l_quantity"), working_folder(spark, "reference"), ["l_partkey", "l_orderkey"]
    texts = [F.struct(F.lit(t).alias("type"), F.lit("[{,").alias("def")) for t in ("n", "v,]", 'q"\\"')]
    # rows are sent once, where their entry is grouped, put in order and written; a line has 0 to 3 definitions or none known
    n = (F.col("l_quantity") % 4).cast("int")
    n = F.when(n < 0, F.raise_error(F.lit("a negative number of definitions"))).otherwise(n)
    kinds = [*(F.slice(F.array(*texts), 1, k) for k in range(4)), F.lit(None)]
    placed = lines.select(*keys, n.alias("n")).repartitionByRange(*keys)
    entries = placed.groupBy(*keys).agg(*(F.count_if(F.col("n").eqNullSafe(F.lit(k))).cast("int").alias(f"n{i}") for i, k in enumerate((0, 1, 2, 3, None)))).sortWithinPartitions(*keys)
    heteronyms = F.concat(*(F.array_repeat(F.struct(k.alias("definitions")), F.col(f"n{i}")) for i, k in enumerate(kinds)))
    value = F.to_json(F.struct(F.concat(F.lit("p"), "l_partkey").alias("title"), heteronyms.alias("heteronyms")))
    ends = lines.agg(*(f(F.struct(*keys)) for f in (F.min, F.max))).first()
    first, last = (F.struct(*keys) == F.struct(*(F.lit(end[k] if end else None).cast("bigint").alias(k) for k in keys)) for end in ends)
    write_placed(entries.select(*keys, value.alias("value")), first, last, place, "[", "]")
    return reference_counts(spark, place).withColumn("definitions", F.col("definitions").cast("bigint"))


@query("""WITH e AS (SELECT event_type, event_id % 5 AS r, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS line FROM events)
SELECT event_type, CASE r WHEN 4 THEN 'blank-line' WHEN 3 THEN 'broken-json' WHEN 2 THEN 'not-object' WHEN 1 THEN 'replacement-char' ELSE 'row' END AS kind, count(*) AS n, CAST(sum(line) AS BIGINT) AS lines FROM e GROUP BY ALL
UNION ALL SELECT event_type, kind, 1, NULL FROM (SELECT DISTINCT event_type FROM events), (VALUES ('bom'), ('crlf')) k(kind)""")
def forensic_scan(spark: SparkSession, d: str) -> DataFrame:
    """Faults of the bytes and lines of files that ranges are read of, with the numbers of the lines (S05, section 2.13)."""
    place = working_folder(spark, "raw")
    forms = ['{"word": "{n}"}', '{"word": "\ufffd{n}"}', "[{n}]", "{broken {n}", " "]
    lines = read(spark, d, "events", "event_id", "event_type").withColumn("value", F.replace(sample_of("event_id", forms), F.lit("{n}"), F.col("event_id").cast("string")))
    heads = lines.groupBy("event_type").agg(F.min("event_id").alias("event_id"), F.lit("\ufeff").alias("mark"))
    marked = lines.join(heads, ["event_type", "event_id"], "left").withColumn("value", F.concat(F.coalesce("mark", F.lit("")), "value"))
    marked.repartition("event_type").sortWithinPartitions("event_type", "event_id").select("event_type", "value").write.partitionBy("event_type").option("lineSep", "\r\n").text(place)
    rows, found = forensic_lines(spark, place, "raw")
    plain = rows.where(~F.col("value").contains("\ufffd")).select("file", F.lit("row").alias("kind"), "line")
    every = found.select("file", "kind", "line").unionByName(plain)
    return every.groupBy(F.regexp_extract("file", "event_type=([^/]*)/", 1).alias("event_type"), "kind").agg(F.count("*").alias("n"), F.sum("line").alias("lines"))


@query("""SELECT 'entries' AS what, CAST(count(DISTINCT o_custkey) AS BIGINT) AS n FROM orders UNION ALL SELECT 'senses', count(*) FROM orders UNION ALL SELECT 'skeleton', count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'supplement', 0
UNION ALL SELECT 'with_trad', count(DISTINCT o_custkey) FROM orders JOIN customer ON c_custkey = o_custkey AND c_nationkey % 2 = 0 UNION ALL SELECT 'faults', 0 UNION ALL SELECT 'faults after a change', 2""")
def published_artifact(spark: SparkSession, d: str) -> DataFrame:
    """An artifact with its manifest, published whole, read back and checked."""
    folder, rows = local_folder(spark), native_rows(spark, d)
    artifact, manifest, source = folder / "entries.deflate", folder / "manifest.json", folder / "source.txt"
    A.write_lines(source, ["made from this"])
    counts = A.publish(rows, [c for c in rows.columns if c != "ord"], artifact, manifest, {"schema_version": 3}, source=source)["counts"]
    check = lambda: len(A.check_artifact(artifact, manifest, source, {"schema_version": 3}, rows))
    faults = check()
    A.update_manifest(manifest, {"schema_version": True, "bytes": 0})
    found = {**{k: counts[k] for k in ("entries", "senses", "skeleton", "supplement", "with_trad")}, "faults": faults, "faults after a change": check()}
    return spark.createDataFrame(list(found.items()), "what string, n bigint")


@query(f"""WITH {BASE_SQL} SELECT 'u' || user_id AS id, CAST(n AS INTEGER) AS sense FROM o WHERE event_id % 10 <> 0 AND event_id % 6 <> 0""")
def repaired_log(spark: SparkSession, d: str) -> DataFrame:
    """Texts that break a rule are taken out, recorded beside the log and asked for again."""
    base, log = materialise(event_base(spark, d)), f"{working_folder(spark, 'log')}/log"  # read several times
    event_texts(spark, d).write.json(log)
    I.repair(base, I.FakeBackend(), log)
    if I.drop_invalid(read_log(spark, log), ["w"])[1].count():
        raise ValueError("a text still breaks a rule")
    return repaired(spark, [f"{log}.repaired", f"{log}.absent"])


@query(f"""WITH {BASE_SQL}, c AS (SELECT user_id, count(*) AS cost FROM o GROUP BY 1), r AS (SELECT user_id, cost, user_id % 2 AS shard, row_number() OVER (PARTITION BY user_id % 2 ORDER BY user_id) AS k FROM c)
SELECT user_id, cost FROM r WHERE k <= 3""")
def budgeted_run(spark: SparkSession, d: str) -> DataFrame:
    """Calls of two shards while each still has tokens: it is looked at before a call."""

    class Spending(I.FakeBackend):
        def __call__(self, prompt: str, system: str) -> I.Reply:
            if not prompt.startswith("rules\n[") or system != "system":
                raise ValueError(prompt)
            return I.Reply(super().__call__(prompt, system).text, {"input_tokens": 30, "output_tokens": 10})

    base, log = event_base(spark, d), f"{working_folder(spark, 'log')}/log"
    I.run(base, Spending(), log, batch=1, shards=2, token_budget=200, rules="rules", system="system")
    return read_log(spark, log).groupBy(F.substring("id", 2, 20).cast("bigint").alias("user_id")).agg(F.count("*").alias("cost"))
