"""Resumable, budgeted inference through a pluggable backend.

Requests are built as columns, chunked by a budget, sent chunk by chunk from the
tasks that hold them, and answers are accepted only for what was asked. What was
accepted is appended to a log, so a run that stops is continued by running again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexiflow.functions.text import english_tokens, first_failure, json_from_reply, normalised
from lexiflow.operators.changes import closure, only, state_of, step, touched
from lexiflow.operators.chunking import budget_chunks
from lexiflow.operators.ordering import last_value_per_key
from lexiflow.operators.patches import identity
from lexiflow.operators.rules import tokens_of
from lexiflow.schemas import GLOSS

#: Seconds to wait before each further try of a call.
WAITS = (30, 60, 120, 240, 480, 600, 600, 600)
#: Longest text that a backend may give; keys of a reply's usage that count as tokens.
MOST_CHARACTERS = 24
TOKENS = ("input_tokens", "output_tokens", "cache_creation_input_tokens", "cache_read_input_tokens")


@dataclass
class Reply:
    text: str
    usage: dict[str, int] = field(default_factory=dict)


class RateLimited(RuntimeError):
    """The backend's limit is reached; the call may be tried again later."""


class Backend(Protocol):
    def __call__(self, prompt: str, system: str) -> Reply: ...


@dataclass
class FakeBackend:
    """Deterministic answers: each asked sense is answered by its own words, reversed.
    Ids that contain a letter of `broken` get a reply that is no JSON."""

    broken: str = ""

    def __call__(self, prompt: str, system: str) -> Reply:
        asked = json.loads(prompt[prompt.rindex("\n") + 1 :] if "\n" in prompt else prompt)
        if any(self.broken and self.broken in item["id"] for item in asked):
            return Reply("no answer", {"calls": 1})
        glosses = [{"id": item["id"], "sense": int(n), "ja": f"訳{item['w']}{n}"} for item in asked for n in item["s"]]
        return Reply("```json\n" + json.dumps({"glosses": glosses}, ensure_ascii=False) + "\n```", {"calls": 1, "output": len(glosses)})


def pending_numbers(senses: Column) -> Column:
    """Numbers, from 1, of the senses without a text."""
    return F.filter(F.transform(senses, lambda s, i: F.when(F.coalesce(s["ja"], F.lit("")) == "", i + 1)), lambda n: n.isNotNull())


def payload_item() -> Column:
    """What a backend needs to know of an entry, with short keys: id, w, py, s (senses to
    translate), m (their labels, if any), h (earlier texts, if any)."""
    numbers = pending_numbers(F.col("senses"))
    at = lambda n: F.get("senses", n - 1)
    none = F.array().cast("array<string>")
    texts = F.map_from_entries(F.transform(numbers, lambda n: F.struct(n.cast("string"), F.array_join(F.coalesce(at(n)["en"], none), "; "))))
    labelled = F.filter(numbers, lambda n: F.size(F.coalesce(at(n)["misc"], none)) > 0)
    labels = F.map_from_entries(F.transform(labelled, lambda n: F.struct(n.cast("string"), F.array_join(at(n)["misc"], ","))))
    return F.struct(
        "id",
        F.col("word").alias("w"),
        F.col("pinyin").alias("py"),
        texts.alias("s"),
        F.when(F.size(labelled) > 0, labels).alias("m"),
        F.when(F.size(F.coalesce("seed_gloss", none)) > 0, F.array_join("seed_gloss", "、")).alias("h"),
    )


def requests(base: DataFrame, batch: int, senses_per_call: int, shards: int = 1, position: str = "ord") -> DataFrame:
    """(shard, chunk, payload): the calls to make for all pending senses, in the order of
    `position`. A shard is a sequence of chunks; its rows are chunked by many tasks."""
    rows = base.withColumn("cost", F.size(pending_numbers(F.col("senses")))).where("cost > 0").withColumn("shard", F.pmod(F.col(position), F.lit(shards)))
    items = rows.select("shard", F.col(position).alias("at"), "cost", F.to_json(payload_item()).alias("item"))
    chunked = budget_chunks(items, ["shard"], ["at"], "cost", senses_per_call, batch)
    gathered = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "item"))), lambda x: x["item"]), ",")
    return chunked.groupBy("shard", "chunk").agg(F.concat(F.lit("["), gathered, F.lit("]")).alias("payload"))


def prompt_of(rules: str, payload: str) -> str:
    """What is sent: the rules, if there are any, a line feed, and the payload."""
    return f"{rules}\n{payload}" if rules else payload


def retrying(call: Backend, waits: Iterable[int] = WAITS, sleep: Callable[[float], None] = time.sleep) -> Backend:
    """The backend, tried again after each wait while its limit is reached."""

    def tried(prompt: str, system: str) -> Reply:
        for wait in waits:
            try:
                return call(prompt, system)
            except RateLimited:
                sleep(wait)
        return call(prompt, system)

    return tried


def spent(usage: dict[str, int]) -> int:
    return sum(usage.get(k, 0) for k in TOKENS)


def usage_totals(calls: DataFrame, group: list[str] = (), usage: str = "usage") -> DataFrame:
    """(group, key, calls, total, per_call): sums over all calls of the whole numbers in their
    usage, and what a call took of each; true and false are no numbers, nor are fractions."""
    fields = F.from_json(usage, "map<string, string>")
    each = calls.select(*group, F.explode(fields).alias("key", "value")).where(F.col("value").rlike("^-?[0-9]+$"))
    sums = each.groupBy(*group, "key").agg(F.sum(F.col("value").cast("bigint")).alias("total"))
    counts = calls.groupBy(*group).agg(F.count("*").alias("calls"))
    joined = sums.join(counts, list(group)) if group else sums.join(F.broadcast(counts))  # a single row
    return joined.select(*group, "key", "calls", "total", (F.col("total") / F.col("calls")).alias("per_call"))


def call_backend(calls: DataFrame, backend: Backend, system: str = "", rules: str = "", tokens: int | None = None) -> DataFrame:
    """(shard, chunk, payload, reply, usage, error): one row a call, in the order of chunks
    in each shard. A call that fails leaves its chunk pending and the run goes on; where
    the backend's limit holds after all tries, the rest of the shard is left for another
    run. `tokens` is what a shard may spend: it is looked at before each call."""
    schema = "shard bigint, chunk int, payload string, reply string, usage string, error string"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, used, stop = None, 0, None
        for pdf in batches:
            rows = []
            for r in pdf.itertuples(index=False):
                if r.shard != shard:
                    shard, used, stop = r.shard, 0, None
                if tokens is not None and used >= tokens:
                    stop = "the token budget is spent"
                reply, error = Reply(""), stop
                if stop is None:
                    try:
                        reply = backend(prompt_of(rules, r.payload), system)
                        used += spent(reply.usage)
                    except RateLimited as problem:
                        error = stop = f"RateLimited: {problem}"
                    except Exception as problem:  # noqa: BLE001 - whatever a backend raises is this chunk's alone
                        error = f"{type(problem).__name__}: {problem}"
                rows.append((r.shard, r.chunk, r.payload, reply.text, json.dumps(reply.usage), error))
            yield pd.DataFrame(rows, columns=["shard", "chunk", "payload", "reply", "usage", "error"])

    ordered = calls.select(F.col("shard").cast("bigint").alias("shard"), F.col("chunk").cast("int").alias("chunk"), "payload").repartition("shard").sortWithinPartitions("shard", "chunk")
    return ordered.mapInPandas(run, schema)


ITEM = "array<struct<id: string, w: string, s: map<string, string>>>"
ANSWERS = "struct<glosses: array<map<string, string>>>"


def accept_replies(replies: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted (id, sense, ja, shard, chunk, place), counts (status, n)): of each reply what
    its call asked for, the first of repeated answers; other answers are counted as rejected. A reply
    that is no JSON, or has an answer without one of its keys, is bad as a whole and its
    chunk stays pending."""
    asked = replies.select("shard", "chunk", F.explode(F.from_json("payload", ITEM)).alias("i")).select("shard", "chunk", F.col("i.id").alias("id"), F.explode(F.map_keys("i.s")).alias("sense")).select("shard", "chunk", "id", F.col("sense").cast("int").alias("sense"))
    read = replies.withColumn("v", F.from_json(json_from_reply(F.col("reply")).cast("string"), ANSWERS)["glosses"])
    keys = F.array(F.lit("id"), F.lit("sense"), F.lit("ja"))
    whole = F.coalesce(F.forall("v", lambda g: F.coalesce(F.size(F.array_except(keys, F.map_keys(g))) == 0, F.lit(False))), F.lit(False))
    read = read.withColumn("whole", whole)
    field = lambda k: F.element_at("g", k)
    answers = read.where("whole").select("shard", "chunk", F.posexplode("v").alias("at", "g")).select("shard", "chunk", "at", field("id").alias("id"), field("sense").try_cast("int").alias("sense"), normalised(field("ja")).alias("ja"))
    met = answers.join(asked.withColumn("asked", F.lit(True)), ["shard", "chunk", "id", "sense"], "left")
    order = F.row_number().over(Window.partitionBy("id", "sense").orderBy(F.col("asked").desc_nulls_last(), "shard", "chunk", "at"))
    ranked = met.withColumn("r", order)
    status = F.when(F.col("asked").isNotNull() & (F.col("r") == 1), "accepted").otherwise("rejected")
    bad = read.where("not whole").groupBy(F.when(F.col("error").isNull(), "bad reply").otherwise("no reply").alias("status")).agg(F.count("*").alias("n"))
    counts = ranked.groupBy(status.alias("status")).agg(F.count("*").alias("n")).unionByName(bad)
    return ranked.where(status == "accepted").select("id", "sense", "ja", "shard", "chunk", F.col("at").alias("place")), counts


def finished(base: DataFrame, glosses: DataFrame) -> DataFrame:
    """(id): entries of which every pending sense has a text in the log."""
    wanted = base.select("id", F.explode(pending_numbers(F.col("senses"))).alias("sense"))
    open_ = wanted.join(glosses.select("id", "sense").distinct(), ["id", "sense"], "left_anti").select("id").distinct()
    return wanted.select("id").distinct().join(open_, "id", "left_anti")


#: Where an answer stands in a log: the pass that wrote it, and its place there.
WRITTEN = "pass bigint, shard bigint, chunk int, place int"


def last_texts(glosses: DataFrame, order: str | None = None) -> DataFrame:
    """(id, sense, ja): of repeated answers the one written last, by the column `order`, or
    else by those of WRITTEN and the line in the log, as far as they are there. Where
    nothing tells which it is, different texts for one sense stop the job."""
    names = [order] if order else [c for c in ("pass", "shard", "chunk", "place", "ord", "written") if c in glosses.columns]
    if names:
        return last_value_per_key(glosses.select("id", "sense", "ja", F.struct(*names).alias("__at")), ["id", "sense"], ["ja"], "__at", only_known=False)
    stop = F.raise_error(F.concat(F.lit("texts of one sense without an order: "), F.col("id"))).cast("string")
    found = glosses.groupBy("id", "sense").agg(F.count_distinct("ja").alias("n"), F.max("ja").alias("ja"))
    return found.select("id", "sense", F.when(F.col("n") > 1, stop).otherwise(F.col("ja")).alias("ja"))


def log_texts(spark: SparkSession, logs: list[str]) -> DataFrame:
    """(id, sense, ja) that logs hold now: of each sense the text written last, unless it has been
    taken back, which a line without a text says."""
    from lexiflow.sources.scans import log_rows

    rows, _ = log_rows(spark, logs, f"{GLOSS}, {WRITTEN}")
    return last_texts(rows).where("ja is not null")


def next_pass(spark: SparkSession, log: str) -> int:
    """The number of the pass that writes to the log now."""
    from lexiflow.sources.scans import log_rows

    last = log_rows(spark, [log], f"{GLOSS}, {WRITTEN}")[0].agg(F.max("pass")).first()[0]
    return 1 if last is None else last + 1


def merge_glosses(base: DataFrame, glosses: DataFrame, order: str | None = None) -> DataFrame:
    """Base rows with the texts of the log in their senses; of repeated answers the last
    holds, unknown ids are ignored, and a number that an entry does not have stops the job."""
    texts = last_texts(glosses, order).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("sense", "ja"))).alias("__t"))
    joined = base.join(texts, "id", "left")
    outside = F.exists("__t", lambda t: t["sense"].isNull() | (t["sense"] < 1) | (t["sense"] > F.size("senses")))
    # a text a sense, by place, in one pass: a map would be searched for each of the senses
    gap = lambda t, i: t["sense"] - F.coalesce(F.get("__t", i - 1)["sense"], F.lit(0)) - 1
    placed = F.flatten(F.transform("__t", lambda t, i: F.concat(F.array_repeat(F.lit(None).cast("string"), gap(t, i)), F.array(t["ja"]))))
    put = F.zip_with("senses", placed, lambda s, t: s.withField("ja", F.coalesce(t, s["ja"])))
    stop = F.raise_error(F.concat(F.lit("a sense that the entry does not have: "), F.col("id"))).cast(base.schema["senses"].dataType)
    return joined.withColumn("senses", F.when(F.col("__t").isNull(), F.col("senses")).when(outside, stop).otherwise(put)).drop("__t")


def failures(glosses: DataFrame, allowed_latin: list[str] = (), english: DataFrame | None = None) -> DataFrame:
    """`glosses` with `failure`: the rule that a text breaks, or null. `english` (id,
    tokens) tells words that are left over from the source."""
    rows, words = glosses, None
    if english is not None:
        rows, words = glosses.join(english.select("id", F.col("tokens").alias("__tokens")), "id", "left"), F.coalesce("__tokens", F.array().cast("array<string>"))
    return rows.withColumn("failure", first_failure(F.col("ja"), MOST_CHARACTERS, tokens_of(allowed_latin), words)).drop("__tokens")


def drop_invalid(glosses: DataFrame, allowed_latin: list[str] = (), own: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, dropped) texts: those that break no rule, and those that do. With `own` (id)
    texts of other entries are kept unseen."""
    checked = failures(glosses, allowed_latin)
    mine = F.lit(True)
    if own is not None:
        checked = checked.join(own.select("id").distinct().withColumn("__own", F.lit(True)), "id", "left")
        mine = F.col("__own").isNotNull()
    bad = mine & F.col("failure").isNotNull()
    return checked.where(~bad).select(*glosses.columns), checked.where(bad).select(*glosses.columns)


def verify(base: DataFrame, glosses: DataFrame, allowed_latin: list[str] = ()) -> tuple[dict[str, int], DataFrame]:
    """(counts, problems (kind, id, sense, detail)) of a log: entries that lack a text of a
    pending sense (missing), answers for entries nobody knows (unknown), answers given
    again (repeated), and texts that break a rule, words left over from the source
    among them (violation)."""
    wanted = base.select("id", F.explode(pending_numbers(F.col("senses"))).alias("sense"))
    got = glosses.groupBy("id", "sense").agg(F.count("*").alias("k"))
    none = F.lit(None).cast
    missing = wanted.join(got, ["id", "sense"], "left_anti").groupBy("id").agg(F.min("sense").alias("sense")).select(F.lit("missing").alias("kind"), "id", "sense", none("string").alias("detail"))
    unknown = got.join(base.select("id"), "id", "left_anti").select("id").distinct().select(F.lit("unknown").alias("kind"), "id", none("int").alias("sense"), none("string").alias("detail"))
    repeated = got.where("k > 1").select(F.lit("repeated").alias("kind"), "id", "sense", F.col("k").cast("string").alias("detail"))
    english = base.select("id", english_tokens(F.flatten(F.transform("senses", lambda s: F.coalesce(s["en"], F.array().cast("array<string>"))))).alias("tokens"))
    broken = failures(glosses, allowed_latin, english).where("failure is not null").select(F.lit("violation").alias("kind"), "id", "sense", F.col("failure").alias("detail"))
    problems = missing.unionByName(unknown).unionByName(repeated).unionByName(broken)
    counts = {"entries": wanted.select("id").distinct().count(), "senses": wanted.count(), "translated": got.count(), "missing": 0, "unknown": 0, "repeated": 0, "violation": 0}
    return counts | {r["kind"]: r["n"] for r in problems.groupBy("kind").agg(F.count("*").alias("n")).collect()}, problems


def run(
    base: DataFrame, backend: Backend, log: str, batch: int = 200, senses_per_call: int = 200, shards: int = 4, system: str = "", rules: str = "", limit: int | None = None,
    max_calls: int | None = None, token_budget: int | None = None, waits: Iterable[int] = WAITS, sleep: Callable[[float], None] = time.sleep,
) -> dict[str, int]:
    """One pass: asks for what the log does not hold yet, of the first `limit` entries by
    at most `max_calls` calls, and appends what is accepted. While the backend's limit
    is reached a call waits and is made again. A token budget is shared by the shards."""
    from lexiflow.session import discard, materialise

    held, number = materialise(log_texts(base.sparkSession, [log])), next_pass(base.sparkSession, log)
    rest = base.join(finished(base, held), "id", "left_anti")
    if limit is not None:
        rest = rest.where(F.size(pending_numbers(F.col("senses"))) > 0).orderBy("ord").limit(limit)
    calls = requests(rest, batch, senses_per_call, shards)
    if max_calls is not None:
        calls = calls.orderBy("chunk", "shard").limit(max_calls)
    tokens = None if token_budget is None else -(-token_budget // shards)
    replies = materialise(call_backend(calls, retrying(backend, tuple(waits), sleep), system, rules, tokens))
    taken, counts = accept_replies(replies)
    fresh = taken.join(held.select("id", "sense"), ["id", "sense"], "left_anti").withColumn("pass", F.lit(number))
    fresh.write.mode("append").json(log)
    out = {r["status"]: r["n"] for r in counts.collect()}
    discard(replies, held)
    return out


#: Seconds to wait before each further pass that follows one without an answer.
RESTARTS = (60, 120, 300, 600, 900)


class Stalled(RuntimeError):
    """Passes no longer add anything, and senses are still without a text."""


def supervise(base: DataFrame, backend: Backend, log: str, restarts: Iterable[int] = RESTARTS, sleep: Callable[[float], None] = time.sleep, **options) -> int:
    """Runs passes until every pending sense has a text; how many it took. A pass that adds
    nothing is followed by a wait, one that adds something begins the waits anew; when
    they are used up the run has stalled."""
    waits, passes, added = list(restarts), 0, 0
    wanted = base.where(F.size(pending_numbers(F.col("senses"))) > 0).select("id")
    while True:
        held = log_texts(base.sparkSession, [log])
        if wanted.join(finished(base, held), "id", "left_anti").isEmpty():
            return passes
        if passes and not added:
            if not waits:
                raise Stalled(f"after {passes} passes")
            sleep(waits.pop(0))
        added = run(base, backend, log, sleep=sleep, **options).get("accepted", 0)
        passes += 1
        if added:
            waits = list(restarts)


#: What a second request says before its payload.
REPAIR_RULES = "An earlier text broke a rule: no words of the source language, no readings or tone marks, at most 24 characters, and Japanese characters. Give a new one."


def repair(base: DataFrame, backend: Backend, log: str, allowed_latin: list[str] = (), **options) -> dict[str, int]:
    """Takes back texts that break a rule, by lines without a text that are appended to the log,
    records their senses beside it (`<log>.repaired`) and asks for them again. Nothing that is
    written is changed, so a run that stops anywhere is continued by another one. Without
    such texts nothing is asked."""
    from lexiflow.session import discard, materialise

    number = next_pass(base.sparkSession, log)
    dropped = materialise(drop_invalid(log_texts(base.sparkSession, [log]), allowed_latin, base)[1].select("id", "sense"))
    n = dropped.count()
    if n:
        dropped.write.mode("append").json(f"{log}.repaired")
        dropped.withColumn("pass", F.lit(number)).write.mode("append").json(log)
    discard(dropped)
    return {"repaired": n} | (run(base, backend, log, rules=REPAIR_RULES, **options) if n else {})


def choose_groups(native: DataFrame, words: DataFrame | None = None) -> DataFrame:
    """(word, payload): for each headword of several rows or senses its rows in order, as
    the payload for choosing a primary sense and a default row; of `words` (word) only,
    if given."""
    if words is not None:
        native = native.join(words.select("word").distinct(), "word", "left_semi")
    rows = native.withColumn("row", F.struct("ord", "trad", "pinyin", F.transform("senses", lambda s: F.struct(s["ja"].alias("ja"), F.get(s["en"], F.lit(0)).alias("en"))).alias("s")))
    grouped = rows.groupBy("word").agg(F.array_sort(F.collect_list("row")).alias("rows"), F.min("ord").alias("at"), F.max(F.size("senses")).alias("most")).where((F.size("rows") > 1) | (F.col("most") > 1))
    numbered = F.transform("rows", lambda r, i: F.struct((i + 1).alias("r"), r["trad"].alias("trad"), r["pinyin"].alias("pinyin"), r["s"].alias("s")))
    return grouped.select("word", "at", F.to_json(F.struct(F.col("word").alias("w"), numbered.alias("rows"))).alias("payload"))


def pending_choices(native: DataFrame, primary: DataFrame, default: DataFrame) -> DataFrame:
    """(word): headwords of which a row of several senses has no primary record that still
    holds (the sense is there and has the recorded text), or that have several rows and
    no default record naming one. A record whose text has changed is asked for again."""
    rows = native.select("word", identity(native).alias("key"), "senses")
    held = primary.select(identity(primary).alias("key"), "sense", F.col("ja").alias("recorded"))
    sound = rows.join(held, "key").where(F.col("sense").between(1, F.size("senses")) & F.get("senses", F.col("sense") - 1)["ja"].eqNullSafe(F.col("recorded"))).select("key").distinct()
    senses = rows.where(F.size("senses") >= 2).join(sound, "key", "left_anti").select("word")
    several = rows.groupBy("word").agg(F.count("*").alias("n")).where("n >= 2").select("word")
    named = rows.join(default.select(identity(default).alias("key")).distinct(), "key", "left_semi").select("word")
    return senses.unionByName(several.join(named.distinct(), "word", "left_anti")).distinct()


def choice_state(native: DataFrame, primary: DataFrame, default: DataFrame) -> DataFrame:
    """What the choices of each word depend on, as digests (see operators.changes)."""
    return state_of(bearing_on_choices(native, primary, default), "word")


def bearing_on_choices(native: DataFrame, primary: DataFrame, default: DataFrame) -> dict[str, DataFrame]:
    texts = native.select("word", identity(native).alias("key"), F.transform("senses", lambda s: F.coalesce(s["ja"], F.lit(""))).alias("texts"))
    return {"native": texts, "primary": primary.select("word", identity(primary).alias("key"), "sense", "ja"), "default": default.select("word", identity(default).alias("key"))}


def pending_choices_again(native: DataFrame, primary: DataFrame, default: DataFrame, kept: DataFrame, kept_state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pending, state): pending_choices() by way of what it gave before and the state of then:
    only words of which a row or a record has changed since are looked at again."""
    tables = {"native": native, "primary": primary, "default": default}
    return step(kept, kept_state, "word", tables, bearing_on_choices(**tables), lambda own: pending_choices(**own))


def to_validate_again(base: DataFrame, glosses: DataFrame, base_before: DataFrame, kept_state: DataFrame) -> DataFrame:
    """Entries to be looked at again after a change of entries or texts: all of a word of which
    an entry is not what it was, as rules hold of all rows of a word. `kept_state` is that of
    entry_state() before."""
    ids = touched(kept_state, entry_state(base, glosses), "id")
    return only(base, closure(ids, [base_before, base], "id", "word"), "word")


def entry_state(base: DataFrame, glosses: DataFrame) -> DataFrame:
    """Each entry and its texts, as digests by id."""
    return state_of({"base": base, "glosses": glosses}, "id")


def accept_choices(choices: DataFrame, native: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(primary records, default records) of choices (ord, word, row, sense, default): those
    whose word, row and sense exist, the first for each; others are dropped."""
    numbered = native.withColumn("row", F.row_number().over(Window.partitionBy("word").orderBy("ord"))).select("word", "trad", "pinyin", "senses", "row")
    met = choices.join(numbered, ["word", "row"])
    sound = met.where(F.col("sense").between(1, F.size("senses")) & (F.size("senses") > 1))
    first = F.row_number().over(Window.partitionBy("word", "row").orderBy("ord"))
    primary = sound.withColumn("n", first).where("n = 1").select("word", "trad", "pinyin", "sense", F.get("senses", F.col("sense") - 1)["ja"].alias("ja"))
    once = F.row_number().over(Window.partitionBy("word").orderBy("ord"))
    default = met.where("default").withColumn("n", once).where("n = 1").select("word", "trad", "pinyin")
    return primary, default
