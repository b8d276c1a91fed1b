"""The corpus pipeline: stages that each apply one training-data operator to all
documents the stage before kept. Each takes (spark, docs, sf_dir) and returns a
DataFrame; all but the last return the columns of `documents`.

Defined cases: null and empty texts, and texts without letters, are not toxic and go in
the language stage; rows with a null id are never linked and stay as they are. Very
long texts are read whole. Of equal and near texts the one of the least id stays; of
several rows of one id one stays, that of the least text and then of the least hash of
the whole row, whatever their order. Extra columns, of any name, are carried along up
to the last stage. Empty tables give empty tables, and without labels nothing is toxic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexiflow.llm import langid, minhash, packing, pii, toxicity
from lexiflow.llm.common import discard, materialise, table, tokenizer_path
from lexiflow.llm.queries import SEQUENCE_TOKENS, TOXIC_FROM, packing_digest

#: Least share of its main language that a document must have.
LEAST_SHARE = 0.5


def whole_rows(docs: DataFrame) -> DataFrame:
    """(row, text): operators carry the row along as they would an id."""
    return docs.select(F.struct("*").alias("row"), F.col("text"))


def columns(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of `docs` out of the carried row, some of them changed."""
    return [changed.get(c, F.col("row")[c]).alias(c) for c in docs.columns]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the threshold go; the model learns from those that
    `labels` marks, and if a class has none every document stays."""
    scorer = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(whole_rows(docs), scorer, "row", "text")
    return scored.where(F.col("score") < TOXIC_FROM).select(columns(docs))


def reject_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters or without a main language go, so all do if no document
    names a language; an unknown `lang` is filled in."""
    found = langid.predict(whole_rows(docs), langid.fit(docs), "row", "text")
    known = found.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_SHARE))
    return known.select(columns(docs, lang=F.coalesce(F.col("row.lang"), F.col("lang_pred"))))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that of the least id, and one row of each id."""
    found = minhash.near_duplicates(docs).where("doc_id is not null")
    marks = found.groupBy(F.col("doc_id").alias("of")).agg(F.min("kept").alias("kept"), F.count("*").alias("copies"))
    rows = docs.select(F.struct("*").alias("row"))
    marked = rows.join(marks, F.col("row.doc_id") == F.col("of"), "left").where(F.coalesce("kept", F.lit(True)))
    repeated = F.coalesce(F.col("copies") > 1, F.lit(False))
    order = F.struct(F.col("row.text").alias("text"), F.xxhash64(F.to_json("row")).alias("hash"))
    chosen = marked.where(repeated).groupBy("of").agg(F.min_by("row", order).alias("row"))
    return marked.where(~repeated).select("row").unionByName(chosen.select("row")).select(columns(docs))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in texts become pseudonyms; no document goes; n_chars follows the text
    (null for a null text)."""
    found = pii.pseudonymise(whole_rows(docs), id_col="row")
    return found.select(columns(docs, text=F.col("text"), n_chars=F.length("text").cast("bigint")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each piece of the packed sequences; each token of each document, and its
    end, is in one piece; a null text has its end only."""
    return packing_digest(packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), SEQUENCE_TOKENS))


STAGES = [
    ("toxicity", reject_toxic),
    ("language", reject_unknown_language),
    ("near_duplicates", drop_near_duplicates),
    ("pii", pseudonymise),
    ("packing", pack),
]
#: Fitted models and hashes of shingles have no counterpart in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`, each written and read again."""
    docs, written = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
        if written is not None:
            discard(written)
        written = docs
    return STAGES[-1][1](spark, docs, sf_dir)
