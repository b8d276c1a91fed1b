"""Licence scans, rolling windows and ranked search against plain loops and SQL."""

import math
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexiflow.llm import lexical, license_rules, licenses, queries, rolling

DATA = os.environ.get("TEST_DATA", "/root/testdata/sf0.001")
DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.mark.parametrize("name", ["op11_licenses", "op12_rolling", "op13_lexical"])
def test_query_equals_its_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    if not os.path.isdir(DATA):
        pytest.skip("no test tables")
    db = duckdb.connect()
    for t in ("documents", "benchmark"):
        db.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    found, expected = queries.queries()[name](spark, DATA), db.sql(queries.oracle_sql()[name])
    rows = sorted(repr(tuple(r[c] for c in expected.columns)) for r in found.collect())
    assert rows and rows == sorted(map(repr, expected.fetchall()))


# --- op11 --------------------------------------------------------------------------------------


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain_places(text, rules):
    """All rules over all texts, without keywords, and every place against every other."""
    own, found = words(text), []
    normal = " " + "  ".join(own) + " "
    for n, r in enumerate(rules):
        for m in re.finditer(licenses.apart(r.pattern), normal):
            start = len(normal[: m.start()].split())
            found.append((start, start + len(m[0].split()), r.label, r.priority, n, r.base))
    stays = lambda d, e: (e[3], e[1] - e[0]) > (d[3], d[1] - d[0]) or ((e[3], e[0], e[1]) == (d[3], d[0], d[1]) and e[4] < d[4])
    kept = [d for d in found if d[5] or not any(e[0] <= d[0] and e[1] >= d[1] and stays(d, e) for e in found)]
    return len(own), sorted(kept, key=lambda d: (d[0], -d[1], -d[3], d[4]))


def examples(pattern, rng):
    """A text that a pattern matches: optional groups at random, first or any alternatives."""
    for _ in range(9):
        pattern = re.sub(r"\[\^ \]\+ ", "name ", pattern)
        pattern = re.sub(r"\[([0-9a-z])[^\]]*\]\+?", r"\1", pattern)
        pattern = re.sub(r"\(\?:([^()]*)\)(\?|\{\d+,\d+\})?", lambda m: "" if m[2] == "?" and rng.random() < 0.5 else rng.choice(m[1].split("|")), pattern)
        pattern = re.sub(r"([a-z])\?", lambda m: rng.choice([m[1], ""]), pattern)
    return pattern


def licence_texts():
    rng, rules, texts = random.Random(4), license_rules.all_rules(), [None, "", "no words of that kind", "\x00\x01\x02", "K license Kİ Ünder the MİT license"]
    for r in rules:
        said = examples(r.pattern, rng)
        assert re.search(licenses.apart(r.pattern), licenses.apart(said)), (r, said)
        assert r.keyword.replace(" ", "  ") in licenses.apart(said), (r, said)  # what the gate relies on
        cased = "".join(c.upper() if rng.random() < 0.3 else c for c in said)
        texts.append(f"Été {re.sub(' ', lambda _: rng.choice([' ', '-', ', ', chr(10), ' (']), cased)}. Fin")
    for _ in range(60):
        texts.append(" ".join(examples(rng.choice(rules).pattern, rng) for _ in range(rng.randint(2, 6))))
    return texts + [" und ".join(["under the mit license", "CC BY-NC-SA 4.0", "Apache License, Version 2"] * 300)]


def test_licences_equal_every_rule_over_every_text(spark):
    texts = licence_texts()
    df = spark.createDataFrame([(i, t, "x", i) for i, t in enumerate(texts)], "doc_id bigint, text string, label string, start int").repartition(4)
    found = {r["doc_id"]: r for r in licenses.scan(df).collect()}
    rules = license_rules.all_rules()
    for i, text in enumerate(texts):
        n, kept = plain_places(text, rules)
        assert (found[i]["n_words"], [tuple(p) for p in found[i]["places"]]) == (n, kept), text
        assert found[i]["score"] == max((license_rules.WORTH[d[3]] for d in kept), default=0.0)
    assert len(rules) > 300 and {d.label for d in rules} == {p["label"] for r in found.values() for p in r["places"]}


def test_base_phrases_stay_inside_longer_ones(spark):
    rows = [(1, "Released under the MIT License. Licensed under the Apache License, Version 2.0; CC BY-NC"), (1, "under the mit license"), (None, "under the mit-license"), (2, "underthe mit license"), (3, None)]
    report = licenses.license_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    digest = sorted((r["doc_id"] or 0, r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in report)
    assert digest == [(0, 1, 0, 0, "mit"), (1, 1, 0, 0, "mit"), (1, 3, 1, 13, "apache-2,cc-by-nc,mit"), (2, 0, None, None, ""), (3, 0, None, None, "")]
    assert licenses.license_report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_a_very_long_text_of_licences(spark):
    text = "licensed under the mit license and " * 30_000
    row = licenses.license_report(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert (row["n_words"], row["n_base"], row["first_word"], row["last_word"], row["labels"]) == (180_000, 30_000, 1, 179_995, "mit")


def test_licences_run_no_python(spark):
    plan = licenses.license_report(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)


# --- op12 --------------------------------------------------------------------------------------


def plain_windows(rows, spans):
    out = []
    for d, text, _lang, source, _ in rows:
        now = None if d is None else 60 * ((d + crc(d)) // 6)
        for w in spans:
            own = [] if now is None else [r for r in rows if r[0] is not None and r[3] == source and now - w <= 60 * ((r[0] + crc(r[0])) // 6) < now]
            sizes = sorted(len(r[1]) for r in own if r[1] is not None)
            at = lambda a, b: sizes[math.ceil(len(sizes) * a / b) - 1] if sizes else None
            out.append((d, w, now, len(own), sum(sizes), len({r[2] for r in own} - {None}), at(1, 2), at(99, 100)))
    return Counter(out)


def crc(d):
    import zlib

    return zlib.crc32(str(d).encode()) % 1000


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_loops_over_all_rows(spark, seed):
    rng = random.Random(seed)
    pick = lambda values, none=0.1: None if rng.random() < none else rng.choice(values)
    rows = [(pick(range(-50, 3000), 0.03), pick(["", "ä" * rng.randint(1, 9), "b" * rng.randint(1, 300), "𝄞x"]), pick(["en", "de", ""]), pick(["s1", "s1", "s1", "", "s2"]), 7) for _ in range(700)]
    rows += [rows[5]] * 40
    df = spark.createDataFrame(rows, DOCUMENTS).withColumn("event_s", F.lit("clash")).withColumn("__t", F.lit(1))
    for spans in ((1800, 86400), (60, 7)):
        found = Counter(tuple(r) for r in rolling.document_windows(df, spans).collect())
        assert found == plain_windows(rows, spans)


def test_windows_of_nothing_and_of_one_time(spark):
    assert rolling.document_windows(spark.createDataFrame([], DOCUMENTS)).count() == 0
    rows = [(5, "abc", None, None, 0)] * 3
    assert Counter(tuple(r) for r in rolling.document_windows(spark.createDataFrame(rows, DOCUMENTS)).collect()) == plain_windows(rows, (1800, 86400))


def test_the_tree_finds_every_rank():
    rng, tree, held = random.Random(3), rolling.Fenwick(37), []
    for _ in range(300):
        at, n = rng.randrange(37), rng.randint(1, 3)
        tree.add(at, n)
        held += [at] * n
        if len(held) > 60 and (gone := rng.choice(held)) is not None:
            tree.add(gone, -1)
            held.remove(gone)
        assert [tree.find(k) for k in range(1, len(held) + 1)] == sorted(held)


# --- op13 --------------------------------------------------------------------------------------


def plain_search(docs, items, k):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    texts = [(d, Counter(split(t))) for d, t in docs]
    sizes = [n for _, c in texts if (n := sum(c.values()))]
    count, total = len(sizes), sum(sizes)
    df = Counter(t for _, c in texts for t in c)
    out = []
    for item, text in items:
        scores = []
        for d, c in texts:
            m = 50 + (50 * sum(c.values()) * count) // total if total else 0
            score = sum(math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(split(text)) if c[t])
            scores += [(-score, d is None, d or 0)] * (score > 0)
        out += [(item, r, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(scores)[:k], 1)]
    return Counter(out)


def search_tables(seed):
    rng = random.Random(seed)
    vocabulary = ["The", "the", "and", *(f"w{n}" for n in range(60)), "é", "Ünd", "x-y", "a.b", "日本"]
    text = lambda n: rng.choice([" ", "\n", "_", "--"]).join(rng.choices(vocabulary, [40, 40, 30, *(60 / (n + 1) for n in range(60)), 1, 1, 1, 1, 1], k=n))
    docs = [(rng.choice([None, *range(400)]) if rng.random() < 0.05 else i, rng.choice([None, "", "!!"]) if rng.random() < 0.05 else text(rng.randint(1, 80))) for i in range(300)]
    docs += [(1000 + n, "the w7 w9 w9 é") for n in range(80)] + [docs[3]] * 3
    items = [(n, text(rng.randint(1, 30))) for n in range(12)] + [(50, None), (51, ""), (52, "nowhere"), (53, "the"), (None, "w7 w9"), (3, "w5 w6"), (3, "w5 w6"), (54, " ".join(vocabulary))]
    return docs, items


@pytest.mark.parametrize(("seed", "k", "limit"), [(1, 5, 10**6), (2, 50, 10**6), (3, 7, 0)])
def test_search_equals_scoring_every_document(spark, seed, k, limit):
    docs, items = search_tables(seed)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").withColumn("doc", F.lit("clash")).withColumn("n", F.lit(1)).repartition(5)
    asked = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit(9))
    found = Counter(tuple(r) for r in lexical.search(frame, asked, k, broadcast_terms=limit).collect())
    assert found == plain_search(docs, items, k)


def test_search_of_and_in_nothing(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"), spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.search(docs.where("false"), items).collect() == []
    assert lexical.search(docs, items.where("false")).collect() == []
    assert lexical.search(docs.withColumn("text", F.lit(None).cast("string")), items).collect() == []
    assert lexical.search(docs, items).dtypes == lexical.search(docs.where("false"), items).dtypes


def test_terms_of_a_long_text_in_pieces(monkeypatch):
    text = "Äb C9_dé\tx " * 50
    whole = [w for piece in lexical.term_pieces(text.encode()) for w in piece]
    monkeypatch.setattr(lexical, "PIECE", 3)
    assert [w for piece in lexical.term_pieces(text.encode()) for w in piece] == whole == ["Äb".encode(), b"c9", "dé".encode(), b"x"] * 50
