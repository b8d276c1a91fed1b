"""Exact token counts at every prefix, by dynamic programming over byte pieces.

For each prefix of a piece the last token of its encoding is the only token that
ends there and stays apart from the last token of what precedes it, so one pass
gives the number of tokens of every prefix. Texts are cut into units (white
space and what follows); a unit's pieces do not depend on its neighbours, so the
count at any prefix of a text is the sum over the units before it plus the count
at a prefix of one unit, and neither truncation nor budget questions encode again.

Defined cases: a null text is the empty text with no bytes and no tokens;
an empty table gives an empty table; rows with a null id are kept; repeated rows are
counted each; of prefixes of equally many tokens the longest is the one that fits; very
long pieces cost time in proportion to their length times the longest token.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from lexiflow.llm.bpe import WHITE_SPACE, PieceCache, plain_pieces, vocabulary
from lexiflow.llm.common import held, map_texts

NEVER = 1 << 40
UNITS = re.compile(rf"[{WHITE_SPACE}]*[^{WHITE_SPACE}]+|[{WHITE_SPACE}]+")


class PrefixCounter:
    """Counts of tokens at every prefix, for one byte-level vocabulary."""

    def __init__(self, path: str):
        v = self.vocab = vocabulary(path)
        self.trie, self.token_at = {}, [-1]  # of reversed tokens: (node << 8 | byte) -> node; node -> token
        for token, i in v.id_of.items():
            node = 0
            for b in reversed(token):
                if (below := self.trie.get(node << 8 | b)) is None:
                    below = self.trie[node << 8 | b] = len(self.token_at)
                    self.token_at.append(-1)
                node = below
            self.token_at[node] = i
        self.parents = {int(m): (r, *pair) for pair, r in v.rank_of.items() for m in (v.merged[r],)}
        self.apart: dict[int, bool] = {}
        self.edges: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        self.totals = PieceCache()

    def _edge(self, token: int, right: bool) -> list[tuple[int, int]]:
        """The symbols at a token's right (or left) edge while it is built up:
        (symbol, rank of the merge that made it), the single byte first."""
        key = (token, right)
        if key not in self.edges:
            found, t = [], token
            while t in self.parents:
                r, a, b = self.parents[t]
                found.append((t, r))
                t = b if right else a
            self.edges[key] = [(t, -1), *reversed(found)]
        return self.edges[key]

    def _stay_apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border when a's and b's bytes are encoded
        side by side: at each moment the pair at the border would have to be
        merged before either symbol is taken up within its own token."""
        key = a << 20 | b
        if (known := self.apart.get(key)) is not None:
            return known
        left, right, i, j, rank = self._edge(a, True), self._edge(b, False), 0, 0, self.vocab.rank_of
        while True:
            next_left = left[i + 1][1] if i + 1 < len(left) else NEVER
            next_right = right[j + 1][1] if j + 1 < len(right) else NEVER
            across = rank.get((left[i][0], right[j][0]), NEVER)
            # equal ranks are applied from the left
            if across < next_left and across <= next_right and across != NEVER:
                result = False
                break
            if next_left == next_right == NEVER:
                result = True
                break
            if next_left <= next_right:
                i += 1
            else:
                j += 1
        if len(self.apart) > 2_000_000:
            self.apart.clear()
        self.apart[key] = result
        return result

    def piece_prefixes(self, piece: bytes, start: int = 0, last: list[int] | None = None, counts: list[int] | None = None) -> list[int]:
        """counts[n]: tokens of the first n bytes of the piece. Tokens that end at a
        place are found by walking the trie of reversed tokens. With start, last
        and counts, what they hold of the first `start` bytes is taken over."""
        n = len(piece)
        if last is None:
            last, counts = [-1] * (n + 1), [0] * (n + 1)
        step, token_at, apart, stay = self.trie.get, self.token_at, self.apart.get, self._stay_apart
        for end in range(start + 1, n + 1):
            node = 0
            for begin in range(end - 1, -1, -1):
                node = step(node << 8 | piece[begin])
                if node is None:
                    break
                token = token_at[node]
                if token < 0:
                    continue
                if begin:
                    fits = apart(last[begin] << 20 | token)
                    if fits is None:
                        fits = stay(last[begin], token)
                    if not fits:
                        continue
                last[end], counts[end] = token, counts[begin] + 1
                break
        return counts

    def _learn(self, pieces: list[str]) -> Iterable[int]:
        """Totals of many pieces: in sorted order each shares the start of the one before."""
        special, keys = self.vocab.special, [p.encode() for p in pieces]
        totals, before, last, counts = [0] * len(pieces), b"", [-1], [0]
        for k in sorted(range(len(pieces)), key=keys.__getitem__):
            key, same = keys[k], 0
            if pieces[k] in special:
                totals[k] = 1
                continue
            for x, y in zip(key, before):
                if x != y:
                    break
                same += 1
            spare = [0] * (len(key) - same)
            last[same + 1 :] = spare
            counts[same + 1 :] = spare
            totals[k], before = self.piece_prefixes(key, same, last, counts)[-1], key
        return totals

    def total(self, text: str) -> int:
        return sum(map(self._piece_total, self.vocab.pieces(text)))

    def unit_prefixes(self, unit: str) -> list[int]:
        """counts[n]: tokens of the first n characters of a unit. Up to the last character
        of a special string it and what precedes it are plain text; with that character it
        is one token, and what follows begins anew."""
        counts, at, done = [0], 0, 0
        for m in self.vocab.splitter.finditer(unit) if self.vocab.splitter else ():
            plain = unit[at : m.end() - 1]
            if self.vocab.splitter.search(plain):  # one special string begins another
                return [self.total(unit[:n]) for n in range(len(unit) + 1)]
            own = self.plain_prefixes(plain)
            counts += [done + c for c in own[1:]]
            done += own[m.start() - at] + 1
            counts.append(done)
            at = m.end()
        return counts + [done + c for c in self.plain_prefixes(unit[at:])[1:]]

    def plain_prefixes(self, unit: str) -> list[int]:
        """The same without special strings. A prefix cuts into pieces as the unit does,
        except within its white space (one piece) and within a contraction."""
        space = len(unit) - len(unit.lstrip(WHITE_SPACE))
        counts = [0] * (len(unit) + 1)
        at = done = 0
        for piece in plain_pieces(unit):
            by_byte = self.piece_prefixes(piece.encode())
            size = 0
            for k, c in enumerate(piece):
                size += len(c.encode())
                counts[at + k + 1] = done + by_byte[size]
            if len(piece) == 3 and piece[0] == "'" and piece[1].isalpha():  # its first two characters alone are two pieces
                counts[at + 2] = done + sum(self.piece_prefixes(x.encode())[-1] for x in piece[:2])
            at, done = at + len(piece), done + by_byte[-1]
        if space:
            by_byte, size = self.piece_prefixes(unit[:space].encode()), 0
            for k, c in enumerate(unit[:space]):
                size += len(c.encode())
                counts[k + 1] = by_byte[size]
        return counts

    def piece_counts(self, texts: list[str]) -> Iterable[tuple[list[str], list[int]]]:
        """For each text its pieces and their token counts."""
        split = [self.vocab.pieces(t) for t in texts]
        known = self.totals.prepare(set(chain.from_iterable(split)), self._learn)
        for pieces in split:
            yield pieces, list(map(known, pieces))

    def _piece_total(self, piece: str) -> int:
        return 1 if piece in self.vocab.special else self.piece_prefixes(piece.encode())[-1]

    def prefixes(self, text: str) -> np.ndarray:
        """counts[n]: tokens of the first n characters of the text, for every n."""
        out, done = [np.zeros(1, np.int64)], 0
        for unit in UNITS.findall(text):
            counts = np.array(self.unit_prefixes(unit)[1:], np.int64) + done
            out.append(counts)
            done = int(counts[-1])
        return np.concatenate(out)

    def longest_prefix(self, text: str, pieces: list[str], totals: list[int], budget: int) -> int:
        """Characters of the longest prefix of at most `budget` tokens. Each unit has
        a token at least, so the last unit that starts within the budget holds the
        end, or one of those before it."""
        before = np.cumsum(totals)
        if not pieces or before[-1] <= budget:
            return len(text)
        k = int(np.searchsorted(before, budget, "right"))
        ends = np.cumsum([len(p) for p in pieces[: k + 1]])
        # units start where white space follows something else, always between pieces
        starts = [(0, 0)] + [(int(ends[i]), int(before[i])) for i in range(k) if pieces[i + 1][0] in WHITE_SPACE and pieces[i][-1] not in WHITE_SPACE]
        for at, done in reversed(starts):
            counts = self.unit_prefixes(UNITS.match(text, at).group())
            fit = max(n for n, c in enumerate(counts) if done + c <= budget)
            if fit:
                return at + fit
        return 0


def counter(path: str) -> PrefixCounter:
    return held(("counter", path), lambda: PrefixCounter(path))


def prefix_counts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, counts array<int>): counts[n] is the number of tokens of the text's first
    n characters, from n = 0 to its length."""
    return map_texts(df, id_col, text_col, "counts array<int>", lambda: lambda texts: ((counter(path).prefixes(t).tolist(),) for t in texts))


def budget_report(df: DataFrame, path: str, limit: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit, fitting_chars): the size of each whole
    text, whether it has more than `limit` tokens, and the length of its longest
    prefix of at most that many."""

    def make():
        c = counter(path)

        def work(texts: list[str]):
            for text, (pieces, totals) in zip(texts, c.piece_counts(texts)):
                n = sum(totals)
                yield len(text.encode()), n, n > limit, len(text) if n <= limit else c.longest_prefix(text, pieces, totals, limit)

        return work

    return map_texts(df, id_col, text_col, "n_bytes bigint, n_tokens bigint, over_limit boolean, fitting_chars bigint", make)


__all__ = ["PrefixCounter", "WHITE_SPACE", "budget_report", "counter", "prefix_counts"]
