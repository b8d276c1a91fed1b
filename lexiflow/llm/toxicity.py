"""Toxicity scores from class-conditional Kneser-Ney models.

Two models of words as sequences of characters, one of toxic and one of ordinary
texts, differ in their higher orders only: the lower orders, and what the higher
ones back off to, are shared counts of both classes, so expressions that are rare
in a class count for little. Evidence is the difference of the two log-likelihoods
divided by the number of words, of the whole text, of its most toxic passages and
of its most toxic words; a logistic curve maps it to a probability.

The models are fitted on at most about `sample` labelled texts of each class,
chosen by a hash of the id; copies count once, and words once a text.

Defined cases: null and empty texts, and texts without letters, get the score of
no evidence; unlabelled rows teach nothing; if a class has no texts, every score is
0; a label that is given twice counts as toxic if either says so, and a label whose
id is not among the rows counts for nothing. Very long texts are read whole;
repeated rows are scored alike, and of copies the one of the least id teaches, so
the same rows in any order give the same model; an empty table gives an empty
table; rows with a null id are scored and teach nothing.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.bpe import PieceCache
from lexiflow.llm.common import discard, held, map_texts, materialise

WORDS = re.compile(r"[^\W\d_]+")
#: Characters in the longest n-gram; up to SHARED the counts of both classes are shared.
ORDER, SHARED = 6, 3
DISCOUNT = 0.8
#: Words of the passages and numbers of the most toxic distinct words that are looked at.
PASSAGES, MOST_TOXIC = (2, 8, 32), (1, 3, 6)
FEATURES = 1 + len(PASSAGES) + len(MOST_TOXIC)
#: Texts a word must occur in to count for a class.
LEAST_TEXTS = 2
#: Copies share a band of so many least hashes: of two texts of similarity 0.9 with a
#: chance of 0.99, of 0.2 with one of 0.006.
COPY_BANDS, BAND_HASHES = 4, 4
COPY_FACTORS = [np.uint64(pow(0xD1342543DE82EF95, n + 1, 1 << 64)) for n in range(COPY_BANDS * BAND_HASHES)]
#: Longer words are scored by so many of their characters at a time.
LONGEST_WORD = 40
ALPHABET = 256
FACTORS = [np.uint64(pow(0x9E3779B97F4A7C15, n + 1, 1 << 64)) for n in range(ORDER)]
CACHE_WORDS = 200_000
#: Parts of the sample; the curve is fitted to each under a model of the others.
FOLDS = 4


def words_of(text: str) -> list[str]:
    """Lower-case runs of letters; overlong ones in parts."""
    words = WORDS.findall(text.lower())
    if max(map(len, words), default=0) > LONGEST_WORD:
        words = [w[a : a + LONGEST_WORD] for w in words for a in range(0, len(w), LONGEST_WORD)]
    return words


class Grams:
    """Hashes of the n-grams that end at each character of each word. Words are padded,
    so every n-gram is whole; one length at a time is held."""

    def __init__(self, words: list[str]):
        pad = "\x02" * (ORDER - 1)
        self.points = np.frombuffer("".join(f"{pad}{w}\x03" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
        sizes = np.fromiter((len(w) + 1 for w in words), np.int64, len(words))
        self.owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        self.ends = np.arange(self.owner.size) + (ORDER - 1) * (self.owner.astype(np.int64) + 1)

    def hashes(self, n: int, keep: np.ndarray | slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """(hashes of the n-grams, hashes of them without their last character)."""
        ends = self.ends[keep]
        context = np.zeros(ends.size, np.uint64)
        with np.errstate(over="ignore"):
            for k in range(1, n):
                context += (self.points[ends - k].astype(np.uint64) + np.uint64(1)) * FACTORS[k]
            return context + (self.points[ends].astype(np.uint64) + np.uint64(1)) * FACTORS[0], context


class Table:
    """Sums by key, for keys found by binary search."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.keys, place = np.unique(keys, return_inverse=True)
        self.values = np.zeros((self.keys.size + 1, values.shape[1]), np.float32)
        for c in range(values.shape[1]):
            self.values[:-1, c] = np.bincount(place, values[:, c], self.keys.size)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        """The sums of each key, zeros for keys that are not there."""
        if not self.keys.size:
            return self.values[np.zeros(keys.size, np.int64)]
        place = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        return self.values[np.where(self.keys[place] == keys, place, self.keys.size)]


class KneserNey:
    """The models of both classes; column 0 is ordinary, column 1 toxic."""

    def __init__(self, words: list[str], counts: np.ndarray):
        """counts: for each word the texts of each class it occurs in."""
        own = np.where(counts >= LEAST_TEXTS, counts, 0).astype(np.float32)
        text = Grams(words)
        # words of a single text are in the shared counts only
        often = np.flatnonzero((own.sum(1) > 0)[text.owner])
        self.joint: list[Table] = [None] * (ORDER + 1)  # type: ignore[list-item]
        self.given: list[Table] = [None] * (ORDER + 1)  # type: ignore[list-item]
        for n in range(ORDER, 0, -1):
            keep = often if n > SHARED else slice(None)
            keys, given = text.hashes(n, keep)
            if n == ORDER:
                weights = own[text.owner[keep]]
            else:  # how many different characters come before the n-gram
                longer, first = np.unique(text.hashes(n + 1, keep)[0], return_index=True)
                weights = (self.joint[n + 1](longer) > 0 if n > SHARED else np.ones((longer.size, 1))).astype(np.float32)
                keys, given = keys[first], given[first]
            self.joint[n] = Table(keys, weights)
            own_keys, first = np.unique(keys, return_index=True)
            sums = self.joint[n](own_keys)
            self.given[n] = Table(given[first], np.hstack([sums, sums > 0]).astype(np.float32))

    def evidence(self, words: list[str]) -> np.ndarray:
        """Log-likelihood of each word as toxic less that as ordinary."""
        if not words:
            return np.zeros(0, np.float32)
        text = Grams(words)
        likely = np.full((text.owner.size, 1), 1 / ALPHABET, np.float32)
        for n in range(1, ORDER + 1):
            keys, contexts = text.hashes(n)
            joint, (total, kinds) = self.joint[n](keys), np.split(self.given[n](contexts), 2, axis=1)
            known = total > 0
            total = np.maximum(total, 1e-9)
            likely = np.where(known, (np.maximum(joint - DISCOUNT, 0) + np.minimum(DISCOUNT * kinds, total) * likely) / total, likely)
        return np.bincount(text.owner, np.log(likely[:, 1]) - np.log(likely[:, 0]), len(words)).astype(np.float32)


class Scorer:
    """Scores texts with a fitted model; remembers the evidence of words."""

    def __init__(self, model: KneserNey | None, curve: Curve | None = None):
        self.model, self.curve, self.name = model, curve, uuid.uuid4().hex

    def evidence(self, texts: list[str]) -> Iterable[list[float]]:
        """The length-normalised evidence of each text: of all its words, of its most
        toxic passages, and of its most toxic distinct words."""
        known = held(("toxicity", self.name), lambda: PieceCache(CACHE_WORDS))
        split = [words_of(t) for t in texts]
        look = known.prepare(set(chain.from_iterable(split)), lambda new: self.model.evidence(new).tolist())
        for words in split:
            if not words:
                yield [0.0] * FEATURES
                continue
            values = list(map(look, words))
            sums = np.concatenate([[0.0], np.cumsum(values)])
            out = [float(sums[-1]) / len(words)]
            for width in PASSAGES:
                k = min(width, len(words))
                out.append(float((sums[k:] - sums[:-k]).max()) / width)
            top = heapq.nlargest(max(MOST_TOXIC), dict(zip(words, values)).values())
            out += [sum(top[:k]) / k for k in MOST_TOXIC]
            yield out

    def score(self, texts: list[str]) -> Iterable[tuple[float, float]]:
        """(score from 0 to 1, evidence of all words) of each text."""
        if self.model is None:
            return [(0.0, 0.0)] * len(texts)
        found = np.array(list(self.evidence(texts))).reshape(-1, FEATURES)
        return zip(self.curve(found).tolist(), found[:, 0].tolist())


class Curve:
    """A weighted logistic regression with a ridge, over standardised columns."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 0.3):
        self.centre, self.spread = x.mean(0), x.std(0) + 1e-6
        design = self._design(x)
        penalty = np.r_[np.full(x.shape[1], ridge), 1e-3]
        self.beta = np.zeros(design.shape[1])
        for _ in range(60):
            p = self._probability(design)
            curve = design.T @ (design * (weight * p * (1 - p))[:, None]) + np.diag(penalty)
            step = np.linalg.solve(curve, design.T @ (weight * (y - p)) - penalty * self.beta)
            self.beta += np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-6:
                break

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.c_[(x - self.centre) / self.spread, np.ones(len(x))]

    def _probability(self, design: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(design @ self.beta, -30, 30)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._probability(self._design(x))


def copy_keys(words: list[str]) -> list[int]:
    """Bands of least hashes over five-word shingles."""
    hashes = np.fromiter((xxhash.xxh64_intdigest(" ".join(words[i : i + 5])) for i in range(max(1, len(words) - 4))), np.uint64)
    with np.errstate(over="ignore"):
        least = [int((hashes * f >> np.uint64(1)).min()) for f in COPY_FACTORS]
    return [xxhash.xxh64_intdigest(repr(least[k::COPY_BANDS])) >> 1 for k in range(COPY_BANDS)]


def train(words: list[str], counts: np.ndarray, left_out: Callable[[int, Scorer], list[tuple[int, list[float]]]], prior: float) -> Scorer:
    """A scorer from counts[word, fold, class], the texts that hold a word. `left_out` gives
    (class, evidence) of a fold's texts under a scorer that has not seen them; the
    curve is fitted to these, for a share `prior` of toxic texts."""
    total = counts.sum(1)
    if not len(words) or not (total.sum(0) > 0).all():
        return Scorer(None)
    found: list[tuple[int, list[float]]] = []
    for fold in range(FOLDS):
        rest = total - counts[:, fold]
        if (rest.sum(0) > 0).all():
            found += left_out(fold, Scorer(KneserNey(words, rest)))
    y, x = np.array([k for k, _ in found], float), np.array([v for _, v in found], float)
    if not y.size or not 0 < y.sum() < y.size:
        return Scorer(None)
    weight = np.where(y == 1, prior / y.mean(), (1 - prior) / (1 - y.mean()))
    return Scorer(KneserNey(words, total), Curve(x, y, weight))


def without_copies(parsed: DataFrame) -> DataFrame:
    """Of rows (i, digest, keys) that share a band the one of the least id, and of the
    least digest among rows of one id."""
    kept = parsed.select("i", "digest", "keys").distinct()
    for k in range(COPY_BANDS):
        kept = kept.groupBy(F.get("keys", F.lit(k)).alias("k")).agg(F.min(F.struct("i", "digest", "keys")).alias("r")).select("r.*")
    return kept.select("i", "digest")


def fit(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = 2000) -> Scorer:
    """Learns from the rows of `df` that `labels` (id, 0 or 1) marks; labels of other ids
    count for nothing. What reaches the driver are words of at most about `sample` texts
    of each class."""
    given = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("kind")).where("i is not null and kind in (0, 1)")
    there = df.select(F.col(id_col).alias("i"))
    marks = materialise(given.groupBy("i").agg(F.max("kind").alias("kind")).join(there, "i", "left_semi"))
    rows = df.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).where("i is not null and t is not null")
    totals = {r["kind"]: r["n"] for r in marks.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        discard(marks)
        return Scorer(None)
    draw = F.pmod(F.xxhash64("i"), F.lit(1 << 20)) / (1 << 20)
    share = F.when(F.col("kind") == 1, F.lit(min(1.0, sample / totals[1]))).otherwise(F.lit(min(1.0, sample / totals[0])))
    chosen = marks.where(draw < share)  # about twice `sample` ids
    drawn = rows.join(F.broadcast(chosen), "i").withColumn("fold", F.pmod(F.xxhash64("i", F.lit(7)), F.lit(FOLDS)).cast("int"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [words_of(t) for t in batch.column(4).to_pylist()]
            keys = pa.array([copy_keys(w) for w in split], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], keys, pa.array([list(dict.fromkeys(w)) for w in split], pa.list_(pa.string())), batch.column(4)], names=names)

    id_type = df.schema[id_col].dataType.simpleString()
    names = ["i", "fold", "kind", "digest", "keys", "words", "t"]
    parsed = drawn.select("i", "fold", "kind", F.xxhash64("t").alias("digest"), "t").mapInArrow(read, f"i {id_type}, fold int, kind int, digest bigint, keys array<bigint>, words array<string>, t string")
    every = materialise(parsed.dropDuplicates(["i", "digest"]))
    parsed = materialise(every.join(without_copies(every), ["i", "digest"], "left_semi"))
    discard(every, marks)
    cells = [(fold, kind) for fold in range(FOLDS) for kind in (0, 1)]
    sums = (F.count_if((F.col("fold") == f) & (F.col("kind") == k)).alias(f"n{f}_{k}") for f, k in cells)
    grouped = parsed.select("fold", "kind", F.explode("words").alias("w")).groupBy("w").agg(*sums).orderBy("w").toPandas()
    words = grouped.pop("w").tolist()
    counts = grouped.to_numpy(np.float32).reshape(-1, FOLDS, 2)
    del grouped

    def left_out(fold: int, scorer: Scorer) -> list[tuple[int, list[float]]]:
        scored = map_texts(parsed.where(F.col("fold") == fold).select("kind", "t"), "kind", "t", "x array<double>", lambda: lambda texts: ((x,) for x in scorer.evidence(texts)))
        return sorted((r["kind"], r["x"]) for r in scored.collect())

    scorer = train(words, counts, left_out, totals[1] / (totals[0] + totals[1]))
    discard(parsed)
    return scorer


def score(df: DataFrame, scorer: Scorer, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, evidence): how toxic each whole text is, from 0 to 1, and the
    length-normalised evidence of all its words."""
    shared = df.sparkSession.sparkContext.broadcast(scorer)  # as large as the bounded sample at most
    return map_texts(df, id_col, text_col, "score double, evidence double", lambda: shared.value.score)
