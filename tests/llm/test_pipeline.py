"""The pipeline's stages on a small table with planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng, place = random.Random(2), str(tmp_path_factory.mktemp("tables"))
    text = lambda n: " ".join("".join(rng.choice(["an", "the", "er", "ing", "or", "ti"]) for _ in range(rng.randint(1, 3))) for _ in range(n))
    rows = []
    for i in range(240):
        words = text(70).split()
        if i % 8 == 0:
            for _ in range(4):
                words[rng.randrange(70)] = rng.choice(["skunkface", "blorpus"])
        rows.append((i, " ".join(words)))
    rows += [(300, rows[1][1]), (301, rows[1][1] + " once"), (302, None), (303, "1 2 3 !"), (304, rows[3][1] + " call 70.123.182.155 now"), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({"lang": F.when(F.col("doc_id") < 290, "en"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")})
    docs.select(COLUMNS).write.parquet(f"{place}/documents.parquet")
    docs.where("doc_id < 200").select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 8 == 0).cast("int").alias("toxic")).distinct().write.parquet(f"{place}/labels.parquet")
    return place


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == COLUMNS
        kept[name] = {r["doc_id"] for r in docs.select("doc_id").collect()}
    clean = {i for i in range(240) if i % 8}
    assert kept["toxicity"] == clean | {300, 301, 302, 303, 304}
    assert kept["language"] == kept["toxicity"] - {302, 303}
    assert kept["near_duplicates"] == clean and docs.where("doc_id = 3").count() == 1
    assert docs.where("lang is null").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert pieces.agg(F.sum("length")).first()[0] == pieces.select("doc_id", "doc_tokens").distinct().agg(F.sum("doc_tokens")).first()[0]
    tokens = lambda df: sorted(tuple(r) for r in df.groupBy("doc_id").agg(F.sum("length")).collect())
    assert tokens(corpus_pipeline.run(spark, folder)) == tokens(pieces)


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 0")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
    assert docs.count() == 0


def test_run_equals_plain_loops(spark, folder):
    """All stages again, document by document and pair by pair."""
    from itertools import combinations

    import tokenizers

    from lexiflow.llm import langid, packing, pii, toxicity
    from lexiflow.llm.common import tokenizer_path

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    scorer = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    rows = [(i, t) for i, t in rows if next(iter(scorer.score([t or ""])))[0] < corpus_pipeline.TOXIC_FROM]
    kept = docs.join(spark.createDataFrame([(i,) for i, _ in rows], "doc_id bigint").distinct(), "doc_id", "left_semi")
    model = langid.fit(kept)
    rows = [(i, t) for i, t in rows if t and (found := model.infer([t])[0])[0] != "und" and found[1] >= corpus_pipeline.LEAST_SHARE]
    sets = [{tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for w in (t.lower().split() for _, t in rows)]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        if rows[a][0] == rows[b][0] or 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(i, least.get(find(k), i))
    by_id = {}
    for k, (i, t) in enumerate(rows):
        if least[find(k)] == i:
            by_id[i] = min(t, by_id.get(i, t))
    pseudonyms, library = pii.Pseudonymiser(pii.DEMO_KEY), tokenizers.Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    tokens = {i: [*library.encode(pseudonyms.apply(t)[0], add_special_tokens=False).ids, 1] for i, t in by_id.items()}
    pieces = corpus_pipeline.run(spark, folder).collect()
    import zlib

    assert {p["doc_id"]: p["doc_tokens"] for p in pieces} == {i: len(t) for i, t in tokens.items()}
    for p in pieces:
        part = tokens[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert len(part) == p["length"] and zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) == p["ids_crc32"]
    assert sum(p["length"] for p in pieces) == sum(map(len, tokens.values()))
    assert packing.UNITS_IN_WINDOW


def test_columns_of_any_name_and_rows_of_one_id(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id % 8 <> 0 or doc_id > 290")
    names = ["row", "of", "kept", "copies", "score", "evidence", "values", "__kept", "id", "languages", "a.b"]
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id")) for n in names})
    twice = wide.unionByName(wide.where("doc_id = 7").withColumn("of", F.lit("another"))).unionByName(wide.where("doc_id = 9").withColumn("text", F.lit("an or ti the ing er an an or ti the er")))
    chosen = []
    for parts in (1, 5):
        at = twice.repartition(parts, F.xxhash64("doc_id", "of", "text", F.lit(parts)))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            at = stage(spark, at, folder)
            assert at.columns == wide.columns
        rows = {r["doc_id"]: r.asDict() for r in at.collect()}
        assert len(rows) == at.count() and all(r[n] == f"{n}{i}" for i, r in rows.items() for n in names if n != "of")
        chosen.append((rows[7]["of"], rows[9]["text"]))
    assert chosen[0] == chosen[1] and chosen[0][1].startswith("an or ti")


def test_ordinary_and_odd_texts_stay_or_go(spark, folder):
    long = "the er ing or an ti " * 30_000
    df = spark.createDataFrame([(1000, long), (1001, ""), (1002, None), (None, "the er ing or an ti the er"), (1003, long + "the er ing")], "doc_id bigint, text string").withColumns({"lang": F.lit(None).cast("string"), "source": F.lit("s"), "n_chars": F.lit(0).cast("bigint")})
    docs = spark.read.parquet(f"{folder}/documents.parquet").unionByName(df)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
    rows = {r["doc_id"]: r for r in docs.where("doc_id >= 1000 or doc_id is null").collect()}
    assert set(rows) == {1000, None} and rows[1000]["lang"] == "en" and rows[1000]["n_chars"] == len(long)
