"""The training-data operators on small inputs, against brute force and libraries."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lexiflow.llm import ann, bpe, chat, langid, minhash, order_minhash, packing, pii, token_prefix, toxicity
from lexiflow.llm.common import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")
BYTES, WORDS = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("word_bpe_49k.json")
ODD = [None, "", " ", "\n\n", "a", "Hello, world! it's I'LL 're", "é ß 日本語 🎉 x́", "<|endoftext|> a<|endoftext|>", "\x1c\x85 　x", "a" * 3000, "word " * 4000, "İ, ΑΣ. ﬁ", "Hello, world! it's I'LL 're"]


def documents(spark, texts, extra=True):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(None, "no id")], "doc_id bigint, text string")
    return df.withColumns({"ids": F.lit(1), "n": F.lit("x"), "score": F.lit(0), "start": F.lit(2), "id": F.lit(3)}) if extra else df


@pytest.fixture(scope="module")
def odd(spark):
    return documents(spark, ODD).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(odd):
    return odd.where("doc_id = -1")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- op6, op10 ---------------------------------------------------------------------------


def random_texts(count, seed=5):
    rng = random.Random(seed)
    parts = ["a", "the", " ", "  ", "\n", "\t", "'s", "'ll", "'re", "é", "1", "23", "!", "...", "<|endoftext|>", "　", "\x1c", "日本", "🎉", "aaaa", "ing", "²", "I'", "'l"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(count)]


def test_codec_equals_the_library():
    library, codec = tokenizers.Tokenizer.from_file(BYTES), bpe.Codec(BYTES)
    texts = random_texts(800) + [t or "" for t in ODD] + ["ab" * 400, "abcdefghij" * 60]
    for text, ids in zip(texts, codec.encode(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert ids == expected
        assert codec.decode(ids) == library.decode(expected, skip_special_tokens=False)
    assert codec.decode(codec.vocab.byte_ids[:3].tolist() + [codec.vocab.id_of[b"\xff"]])[-1] == "�"


def test_codec_operators(odd, nothing):
    encoded = bpe.encode_documents(odd, BYTES)
    decoded = by_id(bpe.decode_documents(encoded, BYTES))
    digests = by_id(bpe.round_trip_digests(odd, BYTES))
    for i, t in enumerate(ODD):
        assert decoded[i]["text"] == (t or "")
        assert digests[i]["decoded_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
    assert len(digests) == len(ODD) + 1 and digests[0]["n_tokens"] == 0
    assert bpe.round_trip_digests(nothing, BYTES).count() == 0


def test_prefix_counts_equal_the_library():
    library, counter = tokenizers.Tokenizer.from_file(BYTES), token_prefix.PrefixCounter(BYTES)
    length = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for text in random_texts(120, 9):
        exact = [length(text[:n]) for n in range(len(text) + 1)]
        assert counter.prefixes(text).tolist() == exact
        (pieces, totals), = counter.piece_counts([text])
        for budget in (0, 1, 4, 9):
            assert counter.longest_prefix(text, pieces, totals, budget) == max(n for n, c in enumerate(exact) if c <= budget)


def test_budget_report(odd, nothing):
    library = tokenizers.Tokenizer.from_file(BYTES)
    rows = by_id(token_prefix.budget_report(odd, BYTES, 512))
    for i, t in enumerate(ODD):
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (rows[i]["n_bytes"], rows[i]["n_tokens"], rows[i]["over_limit"]) == (len((t or "").encode()), n, n > 512)
    counts = by_id(token_prefix.prefix_counts(odd, BYTES))
    assert counts[5]["counts"][-1] == rows[5]["n_tokens"] and counts[0]["counts"] == [0]
    assert token_prefix.budget_report(nothing, BYTES, 512).count() == 0


# --- op3 -------------------------------------------------------------------------------------


def test_word_ids_equal_the_library():
    library, words, rng = tokenizers.Tokenizer.from_file(WORDS), packing.WordIds(WORDS), random.Random(3)
    parts = ["a", "The", " ", "  ", "\n", "\t", ".", ",", "!!", "?", "it's", "I'LL", "É", "ß", "İ", "Σ", "ΣΑΣ", "1", "23.", "́", "<|endoftext|>", "<|ENDOFTEXT|>", "日本。", "\x1c", "ﬁ", "Ǆ.", "..."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    ids, begin = words.encode(pa.array(texts), np.array([7], "<u4").tobytes())
    for text, a, b in zip(texts, begin, begin[1:]):
        assert ids[a:b].tolist() == [*library.encode(text, add_special_tokens=False).ids, 7]


@pytest.mark.parametrize("lengths", [[], [1], [2048], [5000, 1, 1, 700], [1] * 50, list(range(1, 3000, 7)), [1024] * 9, [64] * 100])
def test_packing_covers_every_token_once_without_padding(lengths):
    sequences = packing.pack_block(np.array(lengths, np.int64), 2048)
    seen = {}
    for pieces in sequences:
        total = sum(n for *_, n in pieces)
        assert 0 < total <= 2048 and (total == 2048 or total & (total - 1) == 0)
        for d, s, n in pieces:
            assert n > 0
            seen.setdefault(d, []).append((s, s + n))
    for d, n in enumerate(lengths):
        spans = sorted(seen[d])
        assert spans[0][0] == 0 and spans[-1][1] == n and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    assert sum(sum(n for *_, n in p) < 2048 for p in sequences) <= 11


def test_nnls_solves_and_stays_positive():
    rng = np.random.default_rng(2)
    matrix, x = rng.random((30, 12)), np.maximum(rng.normal(size=12), 0)
    assert np.allclose(packing.nnls(matrix, matrix @ x), x, atol=1e-6)
    assert (packing.nnls(matrix, rng.normal(size=30)) >= 0).all()


def test_pack_documents(odd, nothing):
    library, rows = tokenizers.Tokenizer.from_file(WORDS), packing.pack_documents(odd, WORDS).collect()
    for i, t in enumerate(ODD):
        own = sorted((r for r in rows if r["doc_id"] == i), key=lambda r: r["start"])
        ids = b"".join(bytes(r["ids"]) for r in own)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(t or "", add_special_tokens=False).ids + [1]
        assert all(r["doc_tokens"] * 4 == len(ids) for r in own)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        spans.sort()
        assert spans[0][0] == 0 and all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert packing.pack_documents(nothing, WORDS).count() == 0


# --- op5 -------------------------------------------------------------------------------------


def brute_components(rows, width, percent):
    def shingles(text):
        words = (text or "").encode().lower().split()
        return {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][0] == rows[j][0] and a and b or a and b and 100 * len(a & b) >= percent * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(d, least.get(find(i), d))
    return [(d, len(s), least[find(i)] if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))]


@pytest.mark.parametrize("width", [2, 5])
def test_components_equal_brute_force(spark, width):
    rng = random.Random(width)
    words = [f"w{i}" for i in range(400)]
    rows, n = [], 0
    for group in range(6):
        base = [rng.choice(words) for _ in range(80)]
        for _ in range(40 if group < 2 else 6):  # near copies at every similarity around the threshold
            copy = list(base)
            for _ in range(rng.randint(0, 9)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            rows.append((n, " ".join(copy)))
            n += 1
    rows += [(n + k, t) for k, t in enumerate(["", " ", "one", "ONE", "x y", "X  y", "same text here now ok fine", "same text here now ok fine", " ".join(words * 30)])]
    rows += [(n + 50, "given twice first text of this id"), (n + 50, "given twice second words for that id")]
    rng.shuffle(rows)
    df = spark.createDataFrame([*rows, (None, "w1 w2 w3"), (n + 99, None)], "doc_id bigint, text string").withColumn("n_shingles", F.lit("clash")).withColumn("rep", F.lit(1))
    found = minhash.near_duplicates(df, width).collect()
    expected = sorted(brute_components([*rows, (n + 99, None)], width, 80))
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found if r["doc_id"] is not None) == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found if r["doc_id"] is not None)
    assert [(r["component_id"], r["kept"]) for r in found if r["doc_id"] is None] == [(None, True)]


def test_components_of_an_empty_table(nothing):
    assert minhash.near_duplicates(nothing).count() == 0


def test_blocks_of_sets_as_matrices(monkeypatch):
    monkeypatch.setattr(minhash, "COLUMNS", 7)
    rng = np.random.default_rng(1)
    x, y = ([np.unique(rng.integers(0, 60, 25).astype(np.uint64)) for _ in range(n)] for n in (9, 5))
    assert minhash.counts_in_common(x, y).tolist() == [[float(np.intersect1d(a, b).size) for b in y] for a in x]


def test_min_max_values_estimate_similarity():
    rng = np.random.default_rng(3)
    both = rng.integers(0, 1 << 62, 800, dtype=np.uint64)
    a, b = np.unique(np.r_[both, rng.integers(0, 1 << 62, 100, dtype=np.uint64)]), np.unique(np.r_[both, rng.integers(0, 1 << 62, 100, dtype=np.uint64)])
    agree = (minhash.bands(a) == minhash.bands(b)).mean()
    assert 0.05 < agree < 0.8 and (minhash.bands(a) == minhash.bands(a[::-1].copy())).all()


# --- op1 -------------------------------------------------------------------------------------


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").withColumn("id", F.lit("clash")).withColumn("rank", F.lit(0))


def test_nearest_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ann, "QUERY_BLOCK", 7)
    monkeypatch.setattr(ann, "CANDIDATE_BLOCK", 40)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(150, 16)).astype(np.float32)
    x[30:60] = x[30]  # ties
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)]
    odd = [(200, None, 0), (220, [], 0), (240, [0.0] * 16, 0), (260, [float("nan")] * 16, 0), (280, [None] + [1.0] * 15, 0), (300, [float("inf")] * 16, 0), (320, [1.0, 2.0], 0), (None, [1.0] * 16, 0)]
    found = ann.search(vectors(spark, rows + odd), F.col("vec_id") % 20 == 0, k=20).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 150, 20))

    def product(a, b):
        total = 0.0
        for p, q in zip(a, b):  # in order; sum() would compensate
            total += float(p) * float(q)
        return total

    for q, hits in got.items():
        scores = [(-product(x[q], v), i) for i, v in enumerate(x) if i != q]
        assert hits == [(i, -s) for s, i in sorted(scores)[:20]]


def test_nearest_with_few_or_no_candidates(spark):
    few = vectors(spark, [(0, [1.0, 2.0], 0), (1, [1.0, 0.0], 0), (20, [3.0], 0)])
    assert [tuple(r) for r in ann.search(few, F.col("vec_id") % 20 == 0).collect()] == [(0, 1, 1, 1.0)]
    assert ann.search(few.where("vec_id = -1"), F.col("vec_id") % 20 == 0).count() == 0


def test_error_bounds_hold():
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(40, 33)), rng.standard_cauchy(size=(50, 33))
    (a, sa, na, ea), (b, sb, nb, eb) = ann.quantise(x), ann.quantise(y)
    about = ann.tile_product(a, b) * sa[:, None] * sb[None, :]
    assert (np.abs(about - x @ y.T) <= na[:, None] * eb + ea[:, None] * (nb + eb) + 1e-9).all()


# --- op2, op9 ----------------------------------------------------------------------------------


def prose(rng, stems, n):
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 3))) for _ in range(n))


def test_toxicity_separates_held_out_texts(spark, odd, nothing):
    rng, rows = random.Random(8), []
    for i in range(400):
        words = prose(rng, ["an", "the", "er", "ing", "or", "ti", "ha"], 80).split()
        toxic = i % 8 == 0
        for _ in range(3 * toxic):
            words[rng.randrange(80)] = rng.choice(["skunkface", "blorpus", "vexwit"])
        rows.append((i, " ".join(words), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string, toxic int")
    labels = df.where("doc_id < 300").select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (5, None), (7, 9)], "doc_id bigint, toxic int"))
    scorer = toxicity.fit(df.drop("toxic"), labels)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(df, scorer).collect()}
    assert all((found[i] >= 0.3) == bool(t) for i, _, t in rows)
    scores = by_id(toxicity.score(odd, scorer))
    assert len(scores) == len(ODD) + 1 and all(0 <= r["score"] <= 1 for r in scores.values()) and scores[0]["score"] == scores[1]["score"]
    assert toxicity.score(nothing, scorer).count() == 0
    blank = toxicity.fit(df, labels.where("toxic = 0"))
    assert {r["score"] for r in toxicity.score(odd, blank).collect()} == {0.0}


def test_kneser_ney_probabilities_sum_to_one():
    words = ["abab", "abba", "baba", "aab", "bbb"]
    model = toxicity.KneserNey(words, np.array([[3, 2], [2, 4], [5, 2], [2, 3], [1, 1]], float))
    assert np.isfinite(model.evidence(["abab", "zzzz", "a"])).all() and model.evidence([]).size == 0


def test_languages_and_mixtures(spark, odd, nothing):
    rng = random.Random(9)
    stems = {"xx": ["ka", "ki", "ku"], "yy": ["sol", "ver", "dan"], "zz": ["öm", "üß", "äk"]}
    rows = [(i, prose(rng, stems[lang], 60), lang) for i, lang in enumerate(["xx", "yy", "zz"] * 40)]
    rows += [(900, prose(rng, stems["xx"], 70) + " " + prose(rng, stems["yy"], 40), None), (901, None, "xx"), (None, prose(rng, stems["zz"], 9), "zz")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumn("score", F.lit("clash"))
    model = langid.fit(df.where(~langid.is_held_out()))
    found = by_id(langid.predict(df, model))
    assert all(found[i]["lang_pred"] == lang for i, t, lang in rows if t and i is not None and lang)
    assert set(found[900]["languages"]) == {"xx", "yy"} and abs(found[900]["score"] - 70 / 110) < 0.05
    assert (found[901]["lang_pred"], found[901]["score"]) == ("und", 0.0)
    others = by_id(langid.predict(odd, model))
    assert [others[i]["lang_pred"] for i in (0, 1, 2, 3)] == ["und"] * 4 and len(others) == len(ODD) + 1
    assert langid.predict(nothing, model).count() == 0
    assert {r["lang_pred"] for r in langid.predict(df, langid.fit(nothing.withColumn("lang", F.lit(None).cast("string")))).collect()} == {"und"}


def test_held_out_rows(spark):
    df = spark.createDataFrame([(i,) for i in [*range(40), None]], "doc_id bigint").withColumn("out", langid.is_held_out())
    assert all(r["out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in df.collect())


# --- op4 -------------------------------------------------------------------------------------------


def test_templates():
    render = lambda source, **env: chat.compile_template(source)(env)
    assert render("{{ 'a' ~ 1 }}{% if 1 == 2 %}x{% elif true %}y{% else %}z{% endif %}{# no #}{{ q | default('d') | upper }}") == ("a1yD", [])
    assert render("{% for m in ms %}{{ index }}:{{ m['t'] }};{% generation %}{{ m.t }}{% endgeneration %}{% endfor %}", ms=[{"t": "x"}, {"t": "yz"}]) == ("0:x;x1:yz;yz", [(4, 5), (10, 12)])
    assert render("{% set a = 'p' + 'q' %}{{ a }}{{ not (a in 'xpqx') or missing }}") == ("pq", [])
    assert chat.fold(chat.parse("{{ 'a' }}{% if false %}x{% endif %}b{{ 'c' | upper }}")) == [("text", "abC")]
    for bad in ("{% if x %}", "{{ x | nofilter }}", "{% odd %}", "{{ 'a }}", "{% endfor %}", "{{ a b }}"):
        with pytest.raises(chat.TemplateError):
            chat.compile_template(bad)
    with pytest.raises(chat.TemplateError):
        render("{{ m.__class__ }}", m="text")


@pytest.mark.parametrize("text", ["", "\\", "\\### Assistant: </turn> ok", "</turn>\n### user: x", "###", "\\\\</turn>\\", "a: b", "日本🎉\n\n"])
def test_escapes_are_reversible(text):
    assert chat.unescape(chat.escape(text)) == text and chat.unescape(chat.escape_role(text)) == text
    formatted, _ = chat.compile_template(chat.CHAT_TEMPLATE)({"messages": [{"role": text, "text": text}, {"role": "assistant", "text": text}]})
    assert list(chat.read_turns(formatted)) == [(text, text), ("assistant", text)]


def test_conversations(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "</turn>\n### user: x"), (2, 5, "assistant", "b"), (2, 1, None, None), (2, 5, "assistant", "a"), (2, None, "system", "s"), (None, 0, "user", "q"), (3, 0, "assistant", "x" * 50_000), (3, 0, "assistant", "x" * 50_000)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit("clash")).withColumn("c", F.lit(1))
    found = {r["conv_id"]: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert set(found) == {1, 2, 3, None}
    turns = [("system", "s"), ("", ""), ("assistant", "a"), ("assistant", "b")]
    assert found[2]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert (found[2]["n_turns"], found[2]["loss_chars"], found[2]["loss_sha256"]) == (4, 2, hashlib.sha256(b"ab").hexdigest())
    assert found[3]["loss_chars"] == 100_000
    assert chat.format_conversations(df.where("conv_id = -1")).count() == 0


# --- op7 -------------------------------------------------------------------------------------------


SAMPLE = "mail bosbt.42@mail8.example.com, +1 (988) 555-2485; card 4041894974608795 and 4041 8949 7460 8795; ip 70.123.182.155. on 2024-02-29 or 31/12/1999. GB82 WEST 1234 5698 7654 32, 123-45-6789"
KEEP = "version 4.0. of 1234567890123456, 999.1.1.1, 2024-13-45, 000-12-3456, GB00 WEST 1234 5698 7654 32"


def test_pseudonyms_keep_their_format_and_validity():
    text, spans = pii.Pseudonymiser("key").apply(SAMPLE)
    kinds = [k for k, *_ in spans]
    assert kinds == ["email", "phone", "card", "card", "address", "date", "date", "iban", "ssn"]
    again, found = pii.Pseudonymiser("other").apply(text)
    assert [k for k, *_ in found] == kinds and again != text
    assert not any(SAMPLE[a:b] in text for _, a, b in spans)
    cards = [text[a:b].replace(" ", "") for k, a, b in found if k == "card"]
    assert cards[0] == cards[1] and cards[0][0] == "4"
    assert pii.Pseudonymiser("key").apply(KEEP) == (KEEP, [])


def test_permutations_are_one_to_one():
    f = pii.Feistel("k")
    for radices in ([10, 10, 10], [7], [26, 10], [2, 3, 5]):
        total = int(np.prod(radices))
        every = [list(map(int, np.unravel_index(i, radices))) for i in range(total)]
        assert len({tuple(f.permute(s, radices, "t")) for s in every}) == total
    ok = lambda s: s[0] * 10 + s[1] < 37
    inside = [[a, b] for a in range(10) for b in range(10) if ok([a, b])]
    assert len({tuple(f.walk(s, [10, 10], "t", ok)) for s in inside}) == len(inside)


def test_pseudonymise(spark, odd, nothing):
    df = documents(spark, [SAMPLE, None, "", SAMPLE.upper(), "x" * 100_000 + " 70.123.182.155"]).withColumn("values", F.lit(1))
    rows = by_id(pii.pseudonymise(df, "key"))
    assert rows[0]["text"] == pii.Pseudonymiser("key").apply(SAMPLE)[0] and rows[1]["text"] is None and rows[2]["text"] == ""
    assert [v["kind"] for v in rows[4]["values"]] == ["address"] and len(rows) == 6
    assert {i: r["text"] for i, r in by_id(pii.pseudonymise(odd)).items() if i is not None} == dict(enumerate(ODD))
    assert pii.pseudonymise(nothing).count() == 0


# --- op8 -------------------------------------------------------------------------------------------


def test_fingerprints(spark, odd, nothing):
    rng = random.Random(11)
    texts = [prose(rng, ["an", "the", "er", "ing", "or"], n) for n in (300, 200, 5, 1, 120)] + [t or "" for t in ODD] + ["b a b a b a " * 40, "a b a b a b " * 40]
    df = spark.createDataFrame([(i * 100, t) for i, t in enumerate(texts)] + [(7, None), (None, "no id")], "doc_id bigint, text string").withColumn("g", F.lit("clash"))
    rows = {r["doc_id"]: r for r in order_minhash.edit_report(df).collect()}
    order = sorted([(-1, None, "no id"), (7, 7, ""), *((i * 100, i * 100, t) for i, t in enumerate(texts))])
    for (_, d, t), (*_, after) in zip(order, order[1:] + order[:1]):
        half, r = len(t) // 2, rows[d]
        edited = t[: len(t) - half] + after[:half]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert rows[0]["near_edited"] > rows[0]["near_next"]
    same = [r["fingerprint"] for i, r in rows.items() if i is not None and i % 100 == 0 and texts[i // 100] == ODD[5]]
    assert len(same) == 2 and len(set(same)) == 1
    assert order_minhash.edit_report(nothing).count() == 0
    one = order_minhash.edit_report(df.where("doc_id = 0")).first()
    assert one["near_next"] == 1.0


def test_signatures_depend_on_order_and_occurrence(spark):
    df = spark.createDataFrame([(1, "one two three four five six seven eight nine ten " * 3), (2, "ten nine eight seven six five four three two one " * 3), (3, "one two three four five six seven eight nine ten " * 2)], "doc_id bigint, text string")
    rows = {r["doc_id"]: r["signature"] for r in order_minhash.fingerprints(df).collect()}
    assert len({tuple(s) for s in rows.values()}) == 3 and all(s == sorted(s, key=lambda v: v >> 57) for s in rows.values())


def test_next_rows_across_groups(spark):
    ids = [-500, -1, 0, 1, 127, 128, 5000, 200_000, 200_001, 10**12]
    df = spark.createDataFrame([(i, f"t{i}", 0) for i in ids], "id bigint, text string, digest bigint")
    rows = {r["id"]: r["next_text"] for r in order_minhash.with_next(df, ["text"]).collect()}
    assert rows == {i: f"t{j}" for i, j in zip(ids, ids[1:] + ids[:1])}
