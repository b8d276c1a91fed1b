"""Ranked lexical search: the k best documents of each item, exactly.

Documents are read once. A task splits texts into terms and keeps those that any item
has, with their numbers of occurrences; these postings, without texts, are written to the
shared folder. A term's impact in a document is its part of the score. For each term
the greatest and the kth greatest impact over all documents are stored. At least k
documents reach the kth impact of any one term of an item, so the greatest of
these is a threshold that the item's kth score can't be below. The documents stored for the
item's SEEDS terms of the greatest kth impacts are scored exactly, and the kth of these scores
is a better threshold. An item's terms stand in descending order of their greatest impacts; from where the sum of the greatest impacts of a
term and all after it (the suffix bound) is a tenth of the threshold, a document with none
but these terms can't be among the best, and they need not be joined. The join of
the other, essential terms with the postings gives candidates with partial scores;
those whose partial score and suffix bound together stay below the threshold go, and so do those
below the kth partial score. The rest are scored exactly over all terms.

Whatever an item or a term holds, all bounds are safe, so results are those of scoring every
document. Terms are broadcast only where there are at most BROADCAST_TERMS of them, and
joined by shuffle beyond it.

Defined cases: a null text has no terms and is in no result; documents without terms count
for nothing. An item without terms, or whose terms no document holds, has no result. Rows with
equal ids are documents (items) of their own; equal scores go by ascending id, a null id last. Very
long texts are read whole, a piece at a time. Empty tables give an empty table.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from lexiflow.llm.common import bounds_of, discard, materialise, release, text_of

#: Terms, or pairs of item and term, that may be broadcast.
BROADCAST_TERMS = 1_000_000
#: Terms of an item whose stored documents seed its threshold.
SEEDS = 4
#: The terms that need not be joined may make up so much of an item's threshold: the less, the
#: more of a document's score is known before it is scored exactly.
SLACK = 0.1
#: Bytes of a text that are split into terms at a time.
PIECE = 1 << 20
#: A-Z to a-z, digits and bytes of other characters as they are, all else to spaces.
FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def term_pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a piece at a time."""
    folded, start = data.translate(FOLD), 0
    while start < len(folded):
        end = start + PIECE
        if end < len(folded) and (end := folded.find(b" ", end)) < 0:
            end = len(folded)
        yield folded[start:end].split()
        start = end


def count_terms(df: DataFrame, id_col: str, text_col: str, known: dict[bytes, int] | None = None) -> DataFrame:
    """(id, n, terms, counts) of each row: the number of its terms with repeats, and the
    distinct ones with their occurrences; with `known`, only these, as their numbers."""
    source = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    out = StructType([source.schema["id"], *_parse_datatype_string(f"n bigint, terms array<{'string' if known is None else 'bigint'}>, counts array<bigint>").fields])
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in bounds_of(batch.column(1)):
                sizes, offsets, terms, counts = [], [0], [], []
                for data in pc.cast(batch.column(1).slice(a, b - a), pa.binary()).to_pylist():
                    n, held = 0, Counter()
                    for piece in term_pieces(data):
                        n += len(piece)
                        held.update(piece if known is None else map(known.get, piece))
                    held.pop(None, None)
                    sizes.append(n)
                    terms += held.keys()
                    counts += held.values()
                    offsets.append(len(terms))
                at = pa.array(offsets, pa.int32())
                held_terms = pa.array(terms, pa.binary()).cast(pa.string()) if known is None else pa.array(terms, pa.int64())
                lists = (pa.ListArray.from_arrays(at, x).cast(arrow.field(k).type) for k, x in ((2, held_terms), (3, pa.array(counts, pa.int64()))))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(sizes, pa.int64()), *lists], schema=arrow)
                release()

    return source.mapInArrow(run, out)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """Written out, with a number for each row."""
    return materialise(df.withColumn(name, F.monotonically_increasing_id()))


def unfolded(read: DataFrame, name: str, *more: str) -> DataFrame:
    """A row for each term of a document."""
    each = read.select(*more, "doc", "n", F.explode(F.arrays_zip("terms", "counts")).alias("p"))
    return each.select(*more, "doc", "n", F.col("p.terms").alias(name), F.col("p.counts").alias("tf"))


def impact(documents: int, terms: int, weight: str = "w", occurrences: str = "tf", size: str = "n") -> Column:
    """A term's part of the score of a document of `size` terms, in whole numbers."""
    m = F.expr(f"50 + (50 * {size} * {documents}L) div {terms}L")
    return F.col(weight) * F.call_function("div", F.col(occurrences) * 1_000_000_000, F.col(occurrences) * 1000 + m * 20)


def search(docs: DataFrame, items: DataFrame, k: int = 50, doc_id: str = "doc_id", item_id: str = "item_id", text_col: str = "text", item_text: str = "text", broadcast_terms: int = BROADCAST_TERMS) -> DataFrame:
    """(item id, rank from 1, doc id, score) of each item's k best documents."""
    asked = numbered(count_terms(items, item_id, item_text).select(F.col("id").alias("key"), "terms"), "item")
    pairs = asked.select("item", F.explode("terms").alias("term"))
    vocabulary = numbered(pairs.select("term").distinct(), "tid")
    small = pairs.count() <= broadcast_terms
    bounded = F.broadcast if small else (lambda df: df)
    if small:  # so is what comes to the driver here
        known = {r["term"].encode(): r["tid"] for r in vocabulary.toLocalIterator()}
        read = numbered(count_terms(docs, doc_id, text_col, known), "doc")
        postings, together = unfolded(read, "tid"), unfolded(read.repartition("doc"), "tid")
    else:
        read = numbered(count_terms(docs, doc_id, text_col), "doc")
        postings = together = materialise(unfolded(read, "term").join(vocabulary, "term").select("doc", "n", "tid", "tf"))
    n_docs, n_terms = read.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    if not n_docs:
        return docs.sparkSession.createDataFrame([], StructType([items.schema[item_id], *_parse_datatype_string("rank int").fields, docs.schema[doc_id], *_parse_datatype_string("score bigint").fields]))
    w = F.floor(1000 * F.log(F.lit(2.0 * n_docs + 2) / (2.0 * F.col("df") + 1)))
    weights = materialise(postings.groupBy("tid").agg(F.count("*").alias("df")).select("tid", w.alias("w")))
    scored = postings.join(bounded(weights), "tid").select("doc", "tid", impact(n_docs, n_terms).alias("impact"))

    def exact(kept: DataFrame) -> DataFrame:
        """(item, doc, id, score) of pairs of item and document, over all terms of the item."""
        if small:
            full = unfolded(read.join(kept, "doc"), "tid", "item", "id")
        else:
            full = postings.join(kept, "doc").join(read.select("doc", "id"), "doc")
        return full.join(bounded(terms), ["item", "tid"]).groupBy("item", "doc", "id").agg(F.sum(impact(n_docs, n_terms)).alias("score"))

    def kth_of(pairs: DataFrame, score: str) -> DataFrame:
        """(item, floor): the kth score of each item that has so many."""
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc(score)))
        return pairs.withColumn("r", place).where(F.col("r") == k).select("item", F.col(score).alias("floor"))

    # stored impacts of each term, and thresholds of each item
    best = Window.partitionBy("tid").orderBy(F.desc("impact"), "doc")
    stored = materialise(scored.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k))
    kth = stored.groupBy("tid").agg(F.max("impact").alias("most"), F.max(F.when(F.col("r") == k, F.col("impact"))).alias("kth"))
    own = materialise(pairs.join(bounded(vocabulary), "term").select("item", "tid").join(bounded(kth), "tid"))
    terms = own.select("item", "tid").join(bounded(weights), "tid")
    seeding = own.withColumn("s", F.row_number().over(Window.partitionBy("item").orderBy(F.desc_nulls_last("kth"), "tid"))).where(F.col("s") <= SEEDS)
    seeds = stored.join(bounded(seeding.select("item", "tid")), "tid").select("item", "doc").distinct()
    floors = materialise(kth_of(exact(seeds), "score"))

    # suffix bounds, and candidates by the essential terms
    item, after = Window.partitionBy("item"), Window.partitionBy("item").orderBy(F.desc("most"), "tid").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    seeded = own.join(bounded(floors), "item", "left").withColumn("floor", F.greatest(F.coalesce("floor", F.lit(0)), F.coalesce(F.max("kth").over(item), F.lit(0))))
    ordered = seeded.withColumn("suffix", F.sum("most").over(after))
    needed = F.col("suffix") >= F.col("floor") * SLACK
    rest = F.coalesce(F.max(F.when(~needed, F.col("suffix"))).over(item), F.lit(0))
    essential = materialise(ordered.withColumn("rest", rest).where(needed).select("item", "tid", "floor", "rest"))
    met = together.join(bounded(weights), "tid").select("doc", "tid", impact(n_docs, n_terms).alias("impact")).join(bounded(essential), "tid").groupBy("item", "doc").agg(F.sum("impact").alias("partial"), F.first("rest").alias("rest"), F.first("floor").alias("floor"))
    candidates = materialise(met.where("partial + rest >= floor").drop("floor"))
    kept = candidates.join(bounded(kth_of(candidates, "partial")), "item", "left").where("floor is null or partial + rest >= floor").select("item", "doc")

    # the best by exact scores
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"), "doc"))
    ranked = exact(kept).where("score > 0").withColumn("rank", rank).where(F.col("rank") <= k)
    found = materialise(ranked.join(asked.select("item", "key"), "item").select(F.col("key").alias(item_id), F.col("rank").cast("int").alias("rank"), F.col("id").alias(doc_id), "score"))
    discard(asked, vocabulary, read, postings, weights, stored, own, floors, essential, candidates)
    return found
