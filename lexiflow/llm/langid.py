"""Language identification by inference of multilingual mixtures.

Each language is a model of character trigrams, hashed to a fixed number of
places. A text's words are observations of a mixture of languages: expectation
maximisation estimates the proportions, and the set of languages is the one of
the highest likelihood less a penalty for each language. Models are fitted on at
most about `sample` texts of each language (chosen by a hash of the id).

Defined cases: a null text, or one without letters, is `und` with score 0; so is
every text if nothing could be learned. Marks count as parts of words that have a
letter, not by themselves. Languages of equal share are taken in alphabetical order. Rows without a language teach nothing.
Very long texts are read whole; repeated rows are treated alike; an empty table
gives an empty table; rows with a null id are kept and teach nothing.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import map_texts, slices

PLACES = 1 << 16
#: Bytes of text that are turned into arrays at a time: some 60 bytes each.
SLICE = 1_000_000
UNKNOWN = "und"
#: Added to each count.
SMOOTHING = 0.1
#: Expectation maximisation of a text ends when no share moves by more than this, or
#: after so many steps.
SETTLED, MOST_STEPS = 1e-4, 200
#: Log-likelihood that a further language must gain, in multiples of log(words) / 2.
PENALTY = 8.0


@functools.lru_cache(maxsize=1)
def letter_codes() -> tuple[np.ndarray, np.ndarray]:
    """For each code point its lower-case letter, or 0 if it is no letter or mark; and
    whether it is a letter."""
    codes, is_letter = np.zeros(0x110000, np.uint32), np.zeros(0x110000, bool)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for m in regex.finditer(r"(\p{L})|\p{M}", every):
        lower = m.group().lower()
        codes[ord(m.group())] = ord(lower) if len(lower) == 1 else ord(m.group())
        is_letter[ord(m.group())] = m.group(1) is not None
    return codes, is_letter


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of the trigram around each letter, first letter of each word, text of each word)."""
    points = np.frombuffer("\x00".join(["", *texts, ""]).encode("utf-32-le", "replace"), np.uint32)
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    lower, is_letter = letter_codes()
    codes = lower[points]
    text_at = np.concatenate([[0], np.repeat(np.arange(len(texts)), sizes), [0] * (points.size - 1 - int(sizes.sum()))]).astype(np.int64)
    letter = codes > 0
    letter[0] = letter[-1] = False
    inside = np.flatnonzero(letter)
    if inside.size:  # runs of marks alone are no words
        begins = np.flatnonzero(~letter[inside - 1])
        word = np.logical_or.reduceat(is_letter[points[inside]], begins)
        inside = inside[np.repeat(word, np.diff(np.r_[begins, inside.size]))]
    if not inside.size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        mix = codes[inside - 1] * np.uint32(2654435761) ^ codes[inside] * np.uint32(2246822519) ^ codes[inside + 1] * np.uint32(3266489917)
        mix = (mix ^ (mix >> np.uint32(15))) * np.uint32(668265263)
    first = np.flatnonzero(~letter[inside - 1])
    return (mix >> np.uint32(16)).astype(np.int64), first, text_at[inside[first]]


class Mixture:
    """Trigram log-probabilities of languages, and inference over them."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        self.languages = languages
        self.logs = np.log((counts + SMOOTHING) / (counts.sum(1, keepdims=True) + SMOOTHING * PLACES)).T.astype(np.float32)

    def infer(self, texts: list[str]) -> list[tuple[str, float, dict[str, float]]]:
        """(language, its share, shares of the chosen set) of each text."""
        out: list[tuple[str, float, dict[str, float]]] = [(UNKNOWN, 0.0, {})] * len(texts)
        place, first, text = trigrams(texts)
        if not first.size or not self.languages:
            return out
        logs = np.add.reduceat(self.logs[place], first, axis=0)  # of each word in each language
        seen, start = np.unique(text, return_index=True)
        sizes = np.diff(np.r_[start, text.size])
        row = np.repeat(np.arange(seen.size), sizes)
        top = logs.max(1, keepdims=True)
        likely = np.exp(np.maximum(logs - top, -60.0))
        shares = self._fit(likely, row, start, sizes, np.ones((seen.size, len(self.languages)), bool))
        rank = np.argsort(np.argsort(-shares, axis=1, kind="stable"), axis=1)
        best, chosen = np.full(seen.size, -np.inf), rank < 1
        cost = PENALTY * np.log(np.maximum(sizes, 2)) / 2
        for m in range(1, len(self.languages) + 1):
            part = np.where(rank < m, shares, 0)
            part /= part.sum(1, keepdims=True)
            gain = np.add.reduceat(np.log(np.einsum("wk,wk->w", likely, part[row])), start) - m * cost
            better = gain > best
            best, chosen = np.where(better, gain, best), np.where(better[:, None], rank < m, chosen)
        shares = self._fit(likely, row, start, sizes, chosen)
        for t, s in zip(seen.tolist(), shares):
            k = int(s.argmax())
            out[t] = (self.languages[k], float(s[k]), {self.languages[i]: float(s[i]) for i in np.flatnonzero(s > 0)})
        return out

    @staticmethod
    def _fit(likely: np.ndarray, row: np.ndarray, start: np.ndarray, sizes: np.ndarray, allowed: np.ndarray) -> np.ndarray:
        """Shares of the allowed languages in each text; texts that have settled are set
        aside once they are half of those at work."""
        found = allowed / allowed.sum(1, keepdims=True)
        at, shares = np.arange(len(found)), found
        for _ in range(MOST_STEPS):
            part = likely * shares[row].astype(np.float32)
            part /= np.maximum(part.sum(1, keepdims=True), 1e-30)
            fresh = np.add.reduceat(part, start, axis=0) / sizes[:, None]
            moving = np.abs(fresh - shares).max(1) > SETTLED
            shares = found[at] = fresh
            if not moving.any():
                break
            if 2 * moving.sum() <= moving.size:
                at, shares, likely, sizes = at[moving], shares[moving], likely[moving[row]], sizes[moving]
                start, row = np.cumsum(sizes) - sizes, np.repeat(np.arange(sizes.size), sizes)
        shares = np.where(allowed, np.maximum(found, 1e-12), 0)
        return shares / shares.sum(1, keepdims=True)


def is_held_out(id_col: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = 4000) -> Mixture:
    """Learns from rows that have a language and an id. What reaches the driver is at
    most a count for each language and each of the hashed places."""
    rows = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t"), F.col(lang_col).alias("l")).where("i is not null and l is not null and t is not null")
    totals = {r[0]: r[1] for r in rows.groupBy("l").count().collect()}
    if not totals:
        return Mixture([], np.zeros((0, PLACES)))
    shares = F.create_map(*(F.lit(x) for l, n in sorted(totals.items()) for x in (l, min(1.0, sample / n))))
    drawn = rows.where(F.pmod(F.xxhash64("i"), F.lit(1 << 20)) < shares[F.col("l")] * (1 << 20)).select("l", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            languages = batch.column(0).to_pylist()
            for a, b, texts in slices(batch.column(1), SLICE):
                for language in set(languages[a:b]):
                    own = [t for l, t in zip(languages[a:b], texts) if l == language]
                    found.setdefault(language, np.zeros(PLACES, np.int64))
                    found[language] += np.bincount(trigrams(own)[0], minlength=PLACES)
        for language, total in found.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array([language] * at.size), pa.array(at), pa.array(total[at])], names=["l", "p", "n"])

    grams = drawn.mapInArrow(count, "l string, p bigint, n bigint").groupBy("l", "p").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(totals)
    counts = np.zeros((len(languages), PLACES))
    counts[grams["l"].map({l: k for k, l in enumerate(languages)}).to_numpy(int), grams["p"].to_numpy(int)] = grams["n"]
    return Mixture(languages, counts)


def predict(df: DataFrame, model: Mixture, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, languages map): the main language of each whole text, its
    share, and the shares of all languages found in it."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # of fixed size for each language

    def make():
        return lambda texts: ((l, s, list(m.items())) for l, s, m in shared.value.infer(texts))

    return map_texts(df, id_col, text_col, "lang_pred string, score double, languages map<string, double>", make, slice_bytes=SLICE)
