"""Rolling window features: counts, sums, distinct labels and ranked values of what came
before each row.

Rows of equal key, time, value and label are merged with their number before anything
is sent, so copies cost nothing. A key's time is cut into blocks, BLOCKS to
the longest window; a block also gets the entries of as many blocks before it, which is all
that its windows reach, so a key with most of the rows is the work of many tasks. In a block a Fenwick tree over the compressed (sorted distinct) values
follows two pointers: one adds entries as time moves on, the other removes those that
leave the window. The tree's descent by halving steps finds the value of any rank, while
plain sums and a counter for each label are kept beside it. Features belong to a time, not
to a row, and are joined back to the rows; Spark splits times of very many rows.

A task holds the merged entries of one key in little more than the longest window. These are bounded by
the distinct (time, value, label) there, whatever the number of rows.

Defined cases: a null key is a key of its own; a null value counts as a row without a
value (a window without values has a sum of 0 and null ranks); null labels are no label.
Rows of one time don't see each other. A row without a time is in no window and has
empty ones. Equal rows each count and each give their own results. An empty table gives an
empty table. Other columns are ignored unless they are to be kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranks of the median and of a high quantile among m values: ceil(m * a / b).
MEDIAN, HIGH = (1, 2), (99, 100)
#: Blocks of time in the longest window.
BLOCKS = 4


class Fenwick:
    """Counts of compressed values; prefix sums in the form of a binary indexed tree."""

    def __init__(self, size: int):
        self.tree = [0] * (size + 1)
        self.top = 1 << max(size.bit_length() - 1, 0)

    def add(self, at: int, n: int) -> None:
        """Adds n to the count of the value in place `at`, from 0."""
        tree, at = self.tree, at + 1
        while at < len(tree):
            tree[at] += n
            at += at & -at

    def find(self, rank: int) -> int:
        """The place of the value that has this rank, from 1, in ascending order."""
        tree, at, step = self.tree, 0, self.top
        while step:
            if at + step < len(tree) and tree[at + step] < rank:
                at += step
                rank -= tree[at]
            step >>= 1
        return at


def slide(times: np.ndarray, values: np.ndarray, known: np.ndarray, labels: np.ndarray, counts: np.ndarray, asked: list[int], span: int) -> Iterator[tuple]:
    """(rows, sum, distinct labels, median, high value) of the window before each of the
    times asked for, in ascending order. Entries are sorted by time; labels below 0 are none."""
    distinct = np.unique(values[known])
    place = np.searchsorted(distinct, values).tolist()
    tree, seen = Fenwick(len(distinct)), [0] * (int(labels.max(initial=-1)) + 1)
    at, sizes, ns, own, label = times.tolist(), values.tolist(), counts.tolist(), known.tolist(), labels.tolist()
    head = tail = int(np.searchsorted(times, asked[0] - span)) if asked else 0
    rows = total = n_known = n_labels = 0
    for now in asked:
        while head < len(at) and at[head] < now:
            n = ns[head]
            rows += n
            if own[head]:
                tree.add(place[head], n)
                n_known, total = n_known + n, total + n * sizes[head]
            if label[head] >= 0:
                n_labels += not seen[label[head]]
                seen[label[head]] += n
            head += 1
        while tail < head and at[tail] < now - span:
            n = ns[tail]
            rows -= n
            if own[tail]:
                tree.add(place[tail], -n)
                n_known, total = n_known - n, total - n * sizes[tail]
            if label[tail] >= 0:
                seen[label[tail]] -= n
                n_labels -= not seen[label[tail]]
            tail += 1
        ranked = (int(distinct[tree.find(-(-n_known * a // b))]) if n_known else None for a, b in (MEDIAN, HIGH))
        yield rows, total, n_labels, *ranked


FEATURES = "n_events bigint, sum_value bigint, n_labels bigint, median_value bigint, high_value bigint"


def rolling(df: DataFrame, key: str, time: str, value: str, label: str, spans: tuple[int, ...]) -> DataFrame:
    """The rows of `df`, once for each span, with window_s (the span) and the features of
    the window of its key that holds the times from time - span to before time."""
    length = -(-max(spans) // BLOCKS)
    named = {"__none": F.col(key).isNull(), "__key": F.coalesce(F.col(key).cast("string"), F.lit("")), "__t": F.col(time).cast("bigint")}
    rows = df.withColumns(named)
    entry = rows.select(*named, F.coalesce(F.col(value).cast("bigint"), F.lit(0)).alias("__v"), F.col(value).isNotNull().alias("__known"), F.col(label).cast("string").alias("__label"))
    merged = entry.where("__t is not null").groupBy(*entry.columns).agg(F.count("*").alias("__n"))
    block = ((F.col("__t") - F.pmod("__t", F.lit(length))) / length).cast("bigint")
    dealt = merged.withColumn("__block", F.explode(F.sequence(block, block + BLOCKS)))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__t", kind="stable")
        times = pdf["__t"].to_numpy()
        asked = np.unique(times[times // length == pdf["__block"].iloc[0]]).tolist()
        labels = pd.factorize(pdf["__label"])[0]
        arrays = (times, pdf["__v"].to_numpy(), pdf["__known"].to_numpy(dtype=bool), labels, pdf["__n"].to_numpy())
        out = [(t, span, *found) for span in spans for t, found in zip(asked, slide(*arrays, asked, span))]
        found = pd.DataFrame(out, columns=["__t", "window_s", "n_events", "sum_value", "n_labels", "median_value", "high_value"])
        found = found.astype({"median_value": "Int64", "high_value": "Int64"})
        found.insert(0, "__key", pdf["__key"].iloc[0])
        found.insert(0, "__none", pdf["__none"].iloc[0])
        return found

    found = dealt.groupBy("__none", "__key", "__block").applyInPandas(run, f"__none boolean, __key string, __t bigint, window_s bigint, {FEATURES}")
    timed = rows.where("__t is not null").join(found.hint("merge"), list(named)).drop(*named)  # never broadcast: it grows with the rows
    empty = {"n_events": F.lit(0), "sum_value": F.lit(0), "n_labels": F.lit(0), "median_value": F.lit(None), "high_value": F.lit(None)}
    spread = F.explode(F.array(*(F.lit(s).cast("bigint") for s in spans)))
    untimed = rows.where("__t is null").drop(*named).withColumn("window_s", spread).withColumns({n: c.cast("bigint") for n, c in empty.items()})
    return timed.unionByName(untimed)


def event_seconds(id_col: str = "doc_id") -> Column:
    """60 * floor((id + (crc32 of the id as text) mod 1000) / 6), without fractions."""
    shifted = F.col(id_col).cast("bigint") + F.crc32(F.col(id_col).cast("bigint").cast("string")) % 1000
    return (shifted - F.pmod(shifted, F.lit(6))) * 10


def document_windows(df: DataFrame, spans: tuple[int, ...] = (1800, 86400), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """Windows of a source's documents at their derived times; values are lengths of whole
    texts in code points."""
    rows = df.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(lang_col).alias("lang"), F.length(text_col).cast("bigint").alias("chars"), event_seconds(id_col).alias("event_s"))
    found = rolling(rows, "source", "event_s", "chars", "lang", spans)
    named = {"sum_value": "sum_chars", "n_labels": "n_langs", "median_value": "median_chars", "high_value": "high_chars"}
    return found.select(F.col("id").alias(id_col), "window_s", "event_s", "n_events", *(F.col(a).alias(b) for a, b in named.items()))
