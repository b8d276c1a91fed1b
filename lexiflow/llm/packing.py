"""Packing of token sequences into windows by non-negative least squares.

Each task packs the documents of its partition in blocks of bounded size, so
packing needs no shuffle and a lost task repeats only its own work. In a block,
whole windows are cut off first; the remainders' lengths, in units of a 64th of
the window, form a histogram. All combinations of two or three lengths that fill
a window are enumerated, their repeat counts are solved against the histogram by
non-negative least squares and rounded, as far as documents last; the last document
of a combination is cut where the window ends. What remains is packed greedily:
the longest piece that fits, else the shortest is cut. Only the last sequence of
a block can be short; it is cut into sequences of powers of two, so that no
sequence needs padding.

Defined cases: a null or empty text is a document of one token, the end id;
repeated rows and documents of any length are packed as they come; an empty
table gives an empty table; rows with a null id are kept; of pieces of equal length
the one that came last is taken first, so a partition's result is always the same.
"""

from __future__ import annotations

import functools
import os
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.bpe import PieceCache
from lexiflow.llm.common import bounds_of, held, release, text_of

#: A block ends once it holds so many tokens.
BLOCK_TOKENS = 4_000_000
UNITS_IN_WINDOW = 64
CACHE_WORDS, LONGEST_CACHED, RUNS_AT_ONCE = 400_000, 64, 20_000
#: Bytes of text that are cut into words at a time.
SLICE = 8_000_000
# Letters that have one lower-case letter each, and signs that never
# join what follows them.
LETTERS, SIGNS = "A-Za-zÀ-ÖØ-öø-įı-ɏ", r"!-&(-/:-@\[-`{-~"
PLAIN = f"^[{LETTERS}0-9{SIGNS}]+$"
RUNS = re.compile(f"[{LETTERS}]+|[0-9]|[{SIGNS}]+|\n")
PROBE = "Straße,2024:(naïve)%%ÉTÉ--x7"
#: Ids of a partition's sequences start at its number times this.
SEQUENCES_OF_A_PARTITION = 1 << 36


@functools.lru_cache(maxsize=4)
def combinations(total: int) -> tuple[np.ndarray, list[tuple[int, ...]]]:
    """All ways to fill `total` units with two or three lengths: as columns of a
    matrix that counts each length, and as tuples, longest first."""
    sets = [(total - a, a) for a in range(1, total // 2 + 1)]
    sets += [(total - a - b, a, b) for b in range(1, total // 3 + 1) for a in range(b, (total - b) // 2 + 1)]
    matrix = np.zeros((total, len(sets)))
    for k, lengths in enumerate(sets):
        for n in lengths:
            matrix[n, k] += 1
    return matrix, sets


def nnls(matrix: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The x >= 0 that minimises |matrix x - target|, by an active-set method: the
    column of steepest descent joins, and columns that would turn negative leave. It
    ends at the optimum, or, where rounding keeps it from that, after three rounds a
    column; any x is a plan, as what it leaves over is packed greedily."""
    normal, moment = matrix.T @ matrix, matrix.T @ target
    n = moment.size
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, np.abs(moment).max(initial=0))
    for _ in range(3 * n):
        gradient = np.where(active, -np.inf, moment - normal @ x)
        joins = int(gradient.argmax())
        if gradient[joins] <= tolerance:
            break
        active[joins] = True
        while active.any():
            on = np.flatnonzero(active)
            solved = np.linalg.lstsq(normal[np.ix_(on, on)], moment[on], rcond=None)[0]
            if (solved > 0).all():
                x[:] = 0
                x[on] = solved
                break
            low = on[solved <= 0]
            gap = x[low] - solved[solved <= 0]
            step = np.min(x[low] / np.where(gap > 0, gap, 1))
            x[on] += step * (solved - x[on])
            drop = on[(x[on] <= 1e-12) | ((solved <= 0) & (x[on] <= 1e-9))]
            active[drop if drop.size else low[:1]] = False
            x[~active] = 0
    return x


def pack_block(lengths: np.ndarray, window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of pieces (document, start, length); every token of every document
    is in exactly one piece."""
    sequences: list[list[tuple[int, int, int]]] = []
    rest: list[tuple[int, int, int]] = []  # (length, document, start)
    for d, n in enumerate(lengths.tolist()):
        whole = n // window * window
        sequences += [[(d, s, window)] for s in range(0, whole, window)]
        if n > whole:
            rest.append((n - whole, d, whole))
    rest.sort()
    unit = max(1, window // UNITS_IN_WINDOW)
    total = window // unit
    queues: list[list[tuple[int, int, int]]] = [[] for _ in range(total)]
    loose = []
    for item in rest:
        units = item[0] // unit
        (queues[units] if 0 < units < total and window % unit == 0 else loose).append(item)
    histogram = np.array([len(q) for q in queues], float)
    matrix, sets = combinations(total)
    # about equal steps on the histogram, whatever its size
    repeats = nnls(matrix, histogram) if histogram.any() else np.zeros(len(sets))
    for k in np.argsort(-repeats, kind="stable").tolist():
        if repeats[k] < 0.5:
            break
        for _ in range(int(repeats[k] + 0.5)):
            left: dict[int, int] = {}
            for n in sets[k]:
                left[n] = left.get(n, 0) + 1
            if any(len(queues[n]) < c for n, c in left.items()):
                break
            pieces, at = [], 0
            for n in sets[k]:
                size, d, start = queues[n].pop()
                take = min(size, window - at)
                if take:  # else the others fill the window by themselves
                    pieces.append((d, start, take))
                at += take
                if take < size:
                    loose.append((size - take, d, start + take))
            sequences.append(pieces)
    loose += chain.from_iterable(queues)
    loose.sort()
    pieces, at = [], 0
    while loose:
        k = bisect_right(loose, (window - at, 1 << 62, 0)) - 1
        size, d, start = loose.pop(max(k, 0))
        take = min(size, window - at)
        pieces.append((d, start, take))
        at += take
        if take < size:
            loose.insert(bisect_right(loose, (size - take, d, start + take)), (size - take, d, start + take))
        if at == window:
            sequences.append(pieces)
            pieces, at = [], 0
    for bit in reversed(range(at.bit_length())):  # the last one, by powers of two
        if at >> bit & 1:
            room, part = 1 << bit, []
            while room:
                d, start, size = pieces.pop(0)
                take = min(size, room)
                part.append((d, start, take))
                room -= take
                if take < size:
                    pieces.insert(0, (d, start + take, size - take))
            sequences.append(part)
    return sequences


class WordIds:
    """Token ids of texts by the tokenizers library. A text's ids are those of its parts
    between spaces, and each distinct part of a slice is looked at once. Parts of Latin
    letters, digits and ASCII signs are runs of one of these each, whose ids are kept, so
    the library sees every run once; any other part goes to it as it is."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        self.last = np.zeros(max([*vocab.values(), *self.tokenizer.get_added_tokens_decoder()]) + 1, bool)
        self.last[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.known = PieceCache(CACHE_WORDS, LONGEST_CACHED)
        alike = self._whole([PROBE])[0] == b"".join(self._runs(RUNS.findall(PROBE.lower())))
        self.plain = PLAIN if alike else "a^"  # a vocabulary that cuts words otherwise gets them whole

    def _whole(self, words: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _runs(self, runs: list[str]) -> list[bytes]:
        """Ids of runs: many in one text, cut behind each id that ends a word."""
        out: list[bytes] = []
        for a in range(0, len(runs), RUNS_AT_ONCE):
            part = runs[a : a + RUNS_AT_ONCE]
            ids = self._whole([" ".join(part)])[0]
            ends = (np.flatnonzero(self.last[np.frombuffer(ids, "<u4")]) + 1) * 4
            out += [ids[x:y] for x, y in zip([0, *ends.tolist()], ends.tolist())] if ends.size == len(part) else self._whole(part)
        return out

    def _words(self, words: pa.Array) -> pa.Array:
        """The ids of distinct words, as bytes."""
        plain = pc.match_substring_regex(words, self.plain)
        for s in self.special:
            plain = pc.and_(plain, pc.invert(pc.match_substring(words, s)))
        chosen = words.filter(plain)
        lines = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(chosen)], pa.int32()), chosen), "\n")[0].as_py()
        runs = RUNS.findall(lines.lower() + "\n") if len(chosen) else []
        odd = words.filter(pc.invert(plain)).to_pylist()
        coded = pa.array(runs, pa.string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        look = self.known.prepare({*distinct, *odd}, self._learn)
        flat = pa.array(list(map(look, distinct)), pa.large_binary()).take(coded.indices)
        breaks = coded.indices.to_numpy() == (distinct.index("\n") if distinct else 0)
        ends = np.r_[0, np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1)[1:][breaks]]
        found = pa.LargeBinaryArray.from_buffers(pa.large_binary(), ends.size - 1, [None, pa.py_buffer(ends), flat.buffers()[2]])
        every = pa.concat_arrays([found, pa.array(list(map(look, odd)), pa.large_binary())])
        mask = plain.to_numpy(zero_copy_only=False)
        place = np.where(mask, np.cumsum(mask) - 1, mask.sum() + np.cumsum(~mask) - 1)
        return every.take(pa.array(place))

    def _learn(self, new: list[str]) -> list[bytes]:
        """Ids of runs and of other parts; a line feed, which parts them, has none."""
        run = [RUNS.fullmatch(w) is not None and w != "\n" for w in new]
        of_runs = iter(self._runs([w for w, r in zip(new, run) if r]))
        of_others = iter(self._whole([w for w, r in zip(new, run) if not r]))
        return [next(of_runs if r else of_others) for r in run]

    def encode(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after another, each closed by `end`; where each begins,
        and the last ends)."""
        parts = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        first = parts.offsets.to_numpy() - parts.offsets[0].as_py()
        coded = parts.flatten().dictionary_encode()
        table = pa.concat_arrays([self._words(coded.dictionary), pa.array([end], pa.large_binary())])
        places = np.insert(coded.indices.to_numpy(), first[1:], len(table) - 1)
        flat = table.take(pa.array(places))
        bounds = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1)
        ids = np.frombuffer(flat.buffers()[2], "<u4", bounds[-1] // 4)
        return ids, bounds[first + np.arange(first.size)] // 4


def word_ids(path: str) -> WordIds:
    return held(("words", path), lambda: WordIds(path))


def pack_documents(df: DataFrame, path: str, window: int = 2048, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, start, length, doc_tokens, sequence_id, offset, ids binary): one row per
    piece; ids are the piece's, as little-endian unsigned 32-bit numbers. Only
    texts that a space never joins across are cut for encoding: the vocabulary
    must drop white space between words."""
    id_type = df.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {id_type}, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_ids(path)
        first = TaskContext.get().partitionId() * SEQUENCES_OF_A_PARTITION
        keys: list[pa.Array] = []
        blocks: list[np.ndarray] = []
        starts: list[np.ndarray] = []
        tokens = used = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal used
            ids, tokens_of, begin = pa.concat_arrays(keys), np.concatenate(blocks), np.concatenate([*starts, [tokens]])
            lengths = np.diff(begin)
            sequences = pack_block(lengths, window)
            d, s, n = np.array(list(chain.from_iterable(sequences)), np.int64).T
            q = np.repeat(np.arange(len(sequences)), [len(pieces) for pieces in sequences])
            before = np.cumsum(n) - n
            o = before - before[np.searchsorted(q, q)]
            for a in range(0, len(d), 4000):
                part = slice(a, a + 4000)
                size = n[part]
                ends = np.r_[0, np.cumsum(size)]
                at = np.repeat(begin[d[part]] + s[part] - ends[:-1], size) + np.arange(ends[-1])
                pieces = pa.BinaryArray.from_buffers(pa.binary(), size.size, [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(tokens_of[at])])
                columns = [ids.take(pa.array(d[part])), *map(pa.array, (s[part], size, lengths[d[part]], first + used + q[part], o[part])), pieces]
                yield pa.RecordBatch.from_arrays(columns, names=[id_col, "start", "length", "doc_tokens", "sequence_id", "offset", "ids"])
            used += len(sequences)

        for batch in batches:
            for a, b in bounds_of(batch.column(1), SLICE):
                found, begin = encoder.encode(batch.column(1).slice(a, b - a), end)
                keys.append(batch.column(0).slice(a, b - a))
                blocks.append(found)
                starts.append(begin[:-1] + tokens)
                tokens += found.size
                release()
                if tokens >= BLOCK_TOKENS:
                    yield from flush()
                    keys, blocks, starts, tokens = [], [], [], 0
        if blocks:
            yield from flush()

    return df.select(F.col(id_col), text_of(text_col).alias("__text")).mapInArrow(run, schema)
