"""Readings: numbered and tone-marked syllables, and keys to match them.

The rules work on plain strings; the column functions apply them to Arrow batches
of distinct values.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

# The combining marks of tones 1 to 4 (tone 5 has none).
TONE_MARKS = "̄́̌̀"
#: What keys leave out: separators and the neutral-tone dot.
KEY_DROPS = str.maketrans("", "", " '’-·,˙")
NUMBERED = re.compile(r"[a-z:][1-5](?=$|[\s·])", re.I)
TOKEN = re.compile(r"\s*(?:(?P<pause>[,，])(?=\s|$)|(?P<run>(?:[a-z]+:?[a-z]*[1-5])+(?=[\s-]|$))|(?P<other>(?:(?!-)\S)+))(?P<hyphen>-)?|-", re.I)
SYLLABLE = re.compile(r"([a-z]+:?[a-z]*)([1-5])", re.I)
# the mark goes to a or e, else to the o of ou, else to the last vowel, else to m or n
PLACES = [re.compile(p, re.I) for p in (r"[ae]", r"o(?=u)", r"[aeiouv](?!.*[aeiouv])", r"[mn]")]


def place_of_mark(syllable: str) -> int:
    """Where the tone mark goes: the index of its letter, or -1. `v` stands for ü; of a
    and e, a comes first."""
    low = syllable.lower()
    if "a" in low:
        return low.index("a")
    return next((m.start() for p in PLACES if (m := p.search(low))), -1)


def marked_syllable(syllable: str, tone: int) -> str:
    plain = syllable.replace("u:", "v").replace("U:", "V")
    at = place_of_mark(plain)
    if tone < 5 and at >= 0:
        plain = plain[: at + 1] + TONE_MARKS[tone - 1] + plain[at + 1 :]
    return unicodedata.normalize("NFC", plain.replace("v", "ü").replace("V", "Ü"))


def tokens(numbered: str) -> list[str]:
    """Syllables and other parts; a pause or a hyphen stays with what is before it."""
    out: list[str] = []
    for m in TOKEN.finditer(numbered):
        if m["pause"] and out:
            out[-1] += ","
        elif m["run"]:
            out += ["".join(s) for s in SYLLABLE.findall(m["run"])]
        elif m["other"] or m["pause"]:
            out.append(m["other"] or m["pause"])
        if m["hyphen"] and out:
            out[-1] += "-"
    return out


def with_marks(token: str) -> str:
    """A token with its tone as a mark; tokens without a tone stay, but for ü."""
    tail = token[len(token.rstrip(",-")) :]
    body = token[: len(token) - len(tail)]
    m = SYLLABLE.fullmatch(body)
    return (marked_syllable(m[1], int(m[2])) if m else body.replace("u:", "ü").replace("U:", "Ü")) + tail


def to_marks(numbered: str, separator: str = " ") -> str:
    """A numbered reading with tone marks."""
    text = separator.join(map(with_marks, tokens(numbered)))
    return text.replace("-" + separator, "-") if separator else text


def is_numbered(reading: str) -> bool:
    return bool(NUMBERED.search(reading))


def key(reading: str) -> str:
    """The same string for all spellings of a reading: no separators, lower case, ü as v,
    each tone's number right after the letter that bears its mark."""
    marked = to_marks(reading) if is_numbered(reading) else reading
    out = []
    for c in unicodedata.normalize("NFD", marked):
        if c in TONE_MARKS:
            out.append(str(TONE_MARKS.index(c) + 1))
        elif c == "̈" and out and out[-1] in "uU":
            out[-1] = "v"
        elif not unicodedata.combining(c):
            out.append(c)
    return "".join(out).translate(KEY_DROPS).lower()


def toneless_key(reading: str) -> str:
    return re.sub(r"[1-4]", "", key(reading))


def sandhi_key(numbered: str) -> str:
    """The key with the tone of a first syllable yi or bu removed: equal to
    heard_sandhi_key() of a reading that differs from it in that tone only."""
    parts = [key(t) for t in tokens(numbered)]
    if parts and re.sub(r"[1-5]", "", parts[0]) in ("yi", "bu"):
        return re.sub(r"[1-5]", "", parts[0]) + "".join(parts[1:])
    return "".join(parts)


def heard_sandhi_key(reading: str) -> str:
    """The key with the tone of a yi or bu at its start removed."""
    return re.sub(r"^(yi|bu)[1-4]", r"\1", key(reading))


def starts_with_sandhi(numbered: str) -> bool:
    parts = tokens(numbered)
    return bool(parts) and re.sub(r"[1-5]", "", key(parts[0])) in ("yi", "bu")


def column(rule: Callable[[str], object], returns: DataType = StringType()) -> Callable:
    """A rule as a function of columns; each distinct value of a batch is computed once."""

    @F.pandas_udf(returns)
    def apply(values: pd.Series) -> pd.Series:
        known = {v: None if v is None else rule(v) for v in set(values.astype(object).where(values.notna(), None))}
        return pd.Series([known.get(v) for v in values], index=values.index, dtype=object)

    return apply
