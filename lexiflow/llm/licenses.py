"""Licences named in texts, by ordered signature rules and DataFrame functions only.

Texts in which none of a few stems occurs are not looked at again. Of the others the words are
set apart (" released  under  the  mit  license "), so that a rule's pattern, with a space on
both sides of each word, matches whole words only. Rules are grouped by keyword; only rules whose
keyword occurs are tried. What a rule matches is set between marks, and the places of the
marks among the words give the intervals. An interval that lies within one of higher priority,
or of the same priority and longer, or equal and of an earlier rule, is suppressed; base rules
are exempt. In order of their starts, what can contain an interval stands close before
it, so each is compared only with those that start no more than the longest interval before it.

Everything is computed within a document's row: nothing is sent, and rows with equal or null
ids stay rows. Time is in proportion to a text's length for each rule whose keyword occurs.

Defined cases: a null text is the empty text, which has no words and no places. Of an
identifier line with more than two licences the first and the last are found. A text without
a place has a score of 0. An empty table gives an empty table.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import let, text_of
from lexiflow.llm.license_rules import STEMS, WORTH, Rule, all_rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Runs of letters, digits and characters outside ASCII, and what lies between them in lower-case texts.
WORD, BETWEEN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Marks before and after a match; no word holds them. All tokens of a marked text.
OPEN, CLOSE = "\x01", "\x02"
MARKED = r"[\x01\x02]|[^ \x01\x02]+"
RULE = "struct<n:int,base:boolean,priority:int,label:string,pattern:string>"
JUMP_BITS = 31
#: Places as they are sorted: ends and priorities negated.
PLACE = "array<struct<start:bigint,back:bigint,after:int,n:int,base:boolean,label:string>>"


def apart(pattern: str) -> str:
    """A pattern or phrase, with each word between spaces of its own."""
    return " " + pattern.replace(" ", "  ") + " "


def rule_table(rules: Sequence[Rule]) -> Column:
    """array<struct<keyword, rules>> as one literal."""
    groups: dict[str, list[dict]] = {}
    for n, r in enumerate(rules):
        assert any(stem in r.keyword for stem in STEMS), r
        groups.setdefault(r.keyword.replace(" ", "  "), []).append({"n": n, "base": r.base, "priority": r.priority, "label": r.label, "pattern": apart(r.pattern)})
    return F.from_json(F.lit(json.dumps([{"keyword": k, "rules": v} for k, v in groups.items()])), F.lit(f"array<struct<keyword:string,rules:array<{RULE}>>>"))


def places(normal: Column, rule: Column) -> Column:
    """The intervals (words from 0, end excluded) of a rule's matches."""
    marked = F.regexp_replace(normal, rule["pattern"], F.lit(f"{OPEN}$0{CLOSE}"))
    tokens = F.regexp_extract_all(marked, F.lit(MARKED), F.lit(0))
    marks = F.filter(F.transform(tokens, lambda t, i: F.when(t.isin(OPEN, CLOSE), i)), lambda i: i.isNotNull())
    words_before = F.transform(marks, lambda at, number: at - number)

    def pairs(w: Column) -> Column:
        """Each start with the end that follows it, in the form that sorts as wanted."""
        end, own = lambda i: F.get(w, i + 1).cast("bigint"), {n: rule[n].alias(n) for n in ("n", "base", "label")}
        place = lambda start, i: F.struct(start.cast("bigint").alias("start"), (-end(i)).alias("back"), (-rule["priority"]).alias("after"), *own.values())
        return F.filter(F.transform(w, lambda start, i: F.when(i % 2 == 0, place(start, i))), lambda x: x.isNotNull())

    return let(words_before, pairs)


def unsuppressed(found: Column) -> Column:
    """Those of the sorted places (start, -end, -priority, rule) that stay."""

    def earliest(s: Column, i: Column, least: Column) -> Column:
        """The first place before i from where on all start at `least` or later, by halving."""
        jumps = F.array(*(F.lit(1 << bit) for bit in reversed(range(JUMP_BITS))))
        return i - F.aggregate(jumps, F.lit(0), lambda n, jump: F.when((n + jump <= i) & (F.get(s, i - n - jump)["start"] >= least), n + jump).otherwise(n))

    def wins(e: Column, d: Column) -> Column:
        """Whether e, which starts no later, contains d and precedes it."""
        longer = (d["back"] + d["start"]) > (e["back"] + e["start"])  # lengths, negated
        tie = (e["start"] == d["start"]) & (e["back"] == d["back"]) & (e["n"] < d["n"])
        return (e["back"] <= d["back"]) & ((e["after"] < d["after"]) | ((e["after"] == d["after"]) & (longer | tie)))

    def kept(s: Column, longest: Column) -> Column:
        def stays(d: Column, i: Column) -> Column:
            first = earliest(s, i, d["start"] - longest)
            return d["base"] | ~F.exists(F.slice(s, first + 1, i - first), lambda e: wins(e, d))

        return F.filter(s, stays)

    longest = F.array_max(F.transform(found, lambda d: -d["back"] - d["start"]))
    return let(longest, lambda most: kept(found, most))


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """(id, n_words, places, score): places is array<struct<start, end, label, priority, rule,
    base>> in order, start and end (excluded) in words; score is the worth of the best."""
    worth = F.create_map(*(F.lit(x) for pair in WORTH.items() for x in pair))
    low = F.lower("text")  # may only add letters to those of A-Z
    gate = F.contains(low, F.lit(STEMS[0]))
    for stem in STEMS[1:]:
        gate = gate | F.contains(low, F.lit(stem))

    def detected(normal: Column) -> Column:
        groups = F.filter(rule_table(all_rules() if rules is None else rules), lambda g: F.contains(normal, g["keyword"]))
        tried = F.filter(F.flatten(F.transform(groups, lambda g: g["rules"])), lambda r: F.regexp_like(normal, r["pattern"]))
        return F.sort_array(F.flatten(F.transform(tried, lambda r: places(normal, r))))

    normal = F.concat(F.lit(" "), F.regexp_replace(F.translate("text", UPPER, LOWER), BETWEEN, "  "), F.lit(" "))
    found = F.when(gate, let(let(normal, detected), unsuppressed))
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text")).select("id", F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("n_words"), F.coalesce(found, F.array().cast(PLACE)).alias("found"))
    shown = F.transform("found", lambda d: F.struct(d["start"].alias("start"), (-d["back"]).alias("end"), d["label"].alias("label"), (-d["after"]).alias("priority"), d["n"].alias("rule"), d["base"].alias("base")))
    score = F.coalesce(F.array_max(F.transform("found", lambda d: F.element_at(worth, -d["after"]))), F.lit(0.0))
    return rows.select(F.col("id").alias(id_col), "n_words", shown.alias("places"), score.alias("score"))


def license_report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] | None = None) -> DataFrame:
    """Each document's number of words, its places of base phrases, all labels and a score."""
    base = lambda c: F.filter(c, lambda d: d["base"])
    labels = lambda c: F.array_join(F.array_sort(F.array_distinct(F.transform(c, lambda d: d["label"]))), ",")
    starts = F.transform(base("places"), lambda d: d["start"])
    return scan(df, id_col, text_col, rules).select(
        id_col,
        "n_words",
        F.size(starts).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base("places")).alias("base_labels"),
        labels("places").alias("labels"),
        "score",
    )
