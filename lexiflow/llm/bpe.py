"""Byte-level BPE by batched numpy merge rounds.

Texts are cut into pieces, and each distinct piece of a slice is encoded once and
kept in a bounded cache. The symbols of all new pieces lie in one flat array; each round finds the rank of
every adjacent pair by binary search over the sorted pair keys and applies each
piece's lowest merge everywhere in that piece.

Defined cases: a null text is the empty text and has no ids; white-space-only,
very long and repeated texts need no special treatment; an empty table gives an
empty table; rows with a null id are kept.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np
import regex
from pyspark.sql import DataFrame

from lexiflow.llm.common import held, map_texts

# The characters with the Unicode property White_Space.
WHITE_SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed value: how byte-level vocabularies of this family cut texts into pieces.
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{WHITE_SPACE}\p{{L}}\p{{N}}]+|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+")
NOT_LATIN = re.compile("[^\x00-\u024f]")
NO_RANK = np.int32((1 << 31) - 1)


def latin_pieces() -> re.Pattern:
    """PIECES for texts below U+0250, where the classes are short."""
    kinds = {k: "".join(re.escape(chr(c)) for c in range(0x250) if unicodedata.category(chr(c))[0] == k) for k in "LN"}
    space = "".join(c for c in WHITE_SPACE if ord(c) < 0x250)
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{kinds['L']}]+| ?[{kinds['N']}]+| ?[^{space}{kinds['L']}{kinds['N']}]+|[{space}]+(?![^{space}])|[{space}]+")


LATIN_PIECES = latin_pieces()


def plain_pieces(text: str) -> list[str]:
    """The pieces of a text without special strings."""
    return (PIECES if NOT_LATIN.search(text) else LATIN_PIECES).findall(text)


#: Pieces of more bytes are merged one by one with a heap: each batched round
#: costs time in proportion to all symbols that are still being merged.
LONG_PIECE = 256
#: Distinct pieces a worker remembers, and the longest piece it remembers.
CACHE_PIECES, CACHE_CHARS = 300_000, 64


def byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in vocabulary files."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    spare = (b for b in range(256) if b not in set(plain))
    letters.update((chr(256 + k), b) for k, b in enumerate(spare))
    return letters


class Vocabulary:
    """Tokens, merges and special strings of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        letters, model = byte_letters(), spec["model"]
        ids = model["vocab"]
        self.bytes_of = {i: bytes(letters[c] for c in token) for token, i in ids.items()}
        self.id_of = {b: i for i, b in self.bytes_of.items()}
        self.numbers = list(range(max(self.bytes_of) + 2))  # one object for each id, however often it is kept
        self.byte_ids = np.array([self.id_of[bytes([b])] for b in range(256)], np.int32)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of.update((i, s.encode()) for s, i in self.special.items())
        self.splitter = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        self.base = np.int64(max(self.bytes_of) + 1)
        self.key_type = np.uint32 if self.base**2 < 1 << 32 else np.int64
        keys = (left * self.base + right).astype(self.key_type)
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.merged = np.array([ids[a + b] for a, b in merges], np.int32)  # by rank
        self.rank_of = {(int(a), int(b)): r for r, (a, b) in enumerate(zip(left, right))}

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs, by binary search over the sorted pair keys."""
        keys = left.astype(self.key_type) * self.key_type(self.base) + right.astype(self.key_type)
        place = np.minimum(np.searchsorted(self.keys, keys), self.keys.size - 1)
        return np.where(self.keys[place] == keys, self.ranks[place], NO_RANK)

    def pieces(self, text: str) -> list[str]:
        """The pieces of a text; special strings are pieces of their own."""
        if self.splitter is None or not self.splitter.search(text):
            return plain_pieces(text)
        found, at = [], 0
        for m in self.splitter.finditer(text):
            found += [*plain_pieces(text[at : m.start()]), m.group()]
            at = m.end()
        return found + plain_pieces(text[at:])


@functools.lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merge_one(symbols: list[int], vocab: Vocabulary) -> list[int]:
    """Merges one long piece: a heap of (rank, place) over a linked list."""
    rank_of, merged = vocab.rank_of, vocab.merged
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    alive = [True] * n
    heap = [(r, i) for i in range(n - 1) if (r := rank_of.get((symbols[i], symbols[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        r, i = heapq.heappop(heap)
        if not alive[i] or (j := after[i]) >= n or rank_of.get((symbols[i], symbols[j])) != r:
            continue
        symbols[i], alive[j], after[i] = int(merged[r]), False, after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (q := rank_of.get((symbols[a], symbols[b]))) is not None:
                heapq.heappush(heap, (q, a))
    return [s for s, live in zip(symbols, alive) if live]


def merge_batch(pieces: list[bytes], vocab: Vocabulary) -> list[list[int]]:
    """The ids of each piece."""
    out: list[list[int]] = [[] for _ in pieces]
    short = []
    for k, p in enumerate(pieces):
        if len(p) > LONG_PIECE:
            out[k] = merge_one(vocab.byte_ids[np.frombuffer(p, np.uint8)].tolist(), vocab)
        elif p:
            short.append(k)
    if not short:
        return out
    sizes = np.array([len(pieces[k]) for k in short])
    symbols = vocab.byte_ids[np.frombuffer(b"".join(pieces[k] for k in short), np.uint8)]
    owner = np.repeat(np.arange(len(short), dtype=np.int32), sizes)
    rank = np.full(symbols.size, NO_RANK, np.int32)  # of the pair that starts at each symbol; none at a piece's last
    at = np.flatnonzero(owner[:-1] == owner[1:])
    rank[at] = vocab.find(symbols[at], symbols[at + 1])
    done_symbols, done_owner = [], []
    while symbols.size:
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, symbols.size]))
        finished = lowest == NO_RANK
        if finished.any():
            done_symbols.append(symbols[finished])
            done_owner.append(owner[finished])
        chosen = rank == lowest
        chosen &= ~finished
        # in a run of overlapping equal pairs every second one is applied, from the left
        follows = chosen[1:] & chosen[:-1]
        if follows.any():
            follows = np.r_[False, follows]
            index = np.arange(symbols.size)
            run_start = np.maximum.accumulate(np.where(chosen & ~follows, index, 0))
            chosen &= (index - run_start) % 2 == 0
        at = np.flatnonzero(chosen)
        symbols[at] = vocab.merged[rank[at]]
        keep = ~finished
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
        # only pairs with a new symbol have another rank
        at = place[at]
        touched = np.zeros(symbols.size + 1, bool)
        touched[at] = touched[at - 1] = True  # one before the first is the spare last
        at = np.flatnonzero(touched[:-1])
        rank[at] = NO_RANK
        at = at[at + 1 < symbols.size]
        at = at[owner[at] == owner[at + 1]]
        rank[at] = vocab.find(symbols[at], symbols[at + 1])
    symbols, owner = np.concatenate(done_symbols), np.concatenate(done_owner)
    order = np.argsort(owner, kind="stable")
    flat, bounds = list(map(vocab.numbers.__getitem__, symbols[order].tolist())), np.searchsorted(owner[order], np.arange(len(short) + 1)).tolist()
    for n, k in enumerate(short):
        out[k] = flat[bounds[n] : bounds[n + 1]]
    return out


class PieceCache:
    """What is known of pieces. It holds two generations of bounded size, so pieces
    that keep coming stay and rare ones go; long pieces are not kept at all."""

    def __init__(self, size: int = CACHE_PIECES, longest: int = CACHE_CHARS):
        self.young: dict = {}
        self.old: dict = {}
        self.passing: list[str] = []  # long ones, kept until the next call
        self.size, self.longest = size, longest

    def prepare(self, pieces: set[str], learn: Callable[[list[str]], Iterable]) -> Callable[[str], object]:
        """A lookup that knows all of `pieces`; `learn` gives the values of new ones."""
        for p in self.passing:
            self.young.pop(p, None)
        if len(self.young) > self.size // 2:
            self.old, self.young = self.young, {}
        young = self.young
        new = pieces.difference(young)
        for p in new & self.old.keys() if self.old else ():
            young[p] = self.old[p]
        new = list(new.difference(young))
        young.update(zip(new, learn(new)))
        self.passing = [p for p in new if len(p) > self.longest]
        return young.__getitem__


class Codec:
    """Encodes and decodes; remembers pieces it has seen."""

    def __init__(self, path: str):
        self.vocab = vocabulary(path)
        self.known = PieceCache()

    def encode(self, texts: list[str]) -> Iterable[list[int]]:
        """The ids of each text."""
        split = [self.vocab.pieces(t) for t in texts]
        known = self.known.prepare(set(chain.from_iterable(split)), self._learn)
        for pieces in split:
            yield list(chain.from_iterable(map(known, pieces)))

    def _learn(self, pieces: list[str]) -> Iterable[tuple[int, ...]]:
        special = self.vocab.special
        found = merge_batch([b"" if p in special else p.encode() for p in pieces], self.vocab)
        return (tuple(ids) if ids else (special[p],) for p, ids in zip(pieces, found))

    def decode(self, ids: Iterable[int]) -> str:
        """The text of the ids; bytes that are no UTF-8 become U+FFFD."""
        return b"".join(map(self.vocab.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def codec(path: str) -> Codec:
    """One codec per worker process, so that its cache outlives a task."""
    return held(("codec", path), lambda: Codec(path))


def encode_documents(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids array<int>): the token ids of each whole text."""
    return map_texts(df, id_col, text_col, "ids array<int>", lambda: lambda texts: ((ids,) for ids in codec(path).encode(texts)))


def decode_documents(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, text): what the ids decode to; null ids decode to the empty text."""
    from pyspark.sql import functions as F

    packed = df.select(id_col, F.concat_ws(",", F.transform(ids_col, lambda x: x.cast("string"))).alias("__ids"))

    def make():
        c = codec(path)
        return lambda rows: ((c.decode(map(int, r.split(","))) if r else "",) for r in rows)

    return map_texts(packed, id_col, "__ids", "text string", make)


def round_trip_digests(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encodes and decodes each whole
    text in one pass and returns digests of both results."""

    def make():
        c = codec(path)
        name = {i: str(i) for i in c.vocab.bytes_of}.__getitem__

        def work(texts: list[str]):
            for ids in c.encode(texts):
                decoded = c.decode(ids)
                yield len(ids), hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

        return work

    return map_texts(df, id_col, text_col, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", make)
