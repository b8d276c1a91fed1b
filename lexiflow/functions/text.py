"""Text predicates and tokens as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ranges of code points of the scripts the rules tell apart, tone marks,
# digits that are no decimal ones, and what messages of a reached limit contain.
HAN = "\\x{3400}-\\x{4DBF}\\x{4E00}-\\x{9FFF}\\x{F900}-\\x{FAFF}\\x{20000}-\\x{2A6DF}\\x{2A700}-\\x{2EBEF}\\x{2F800}-\\x{2FA1F}\\x{30000}-\\x{323AF}"
KANA = "\\x{3041}-\\x{30FF}\\x{31F0}-\\x{31FF}"
CYRILLIC = "\\x{0400}-\\x{052F}"
LATIN = "A-Za-zªµºÀ-ÖØ-öø-ɏ"
TONE_MARKS = "\\x{0300}\\x{0301}\\x{0304}\\x{030C}āáǎàēéěèīíǐìōóǒòūúǔùǖǘǚǜĀÁǍÀĒÉĚÈ"
DIGITS = "\\p{Nd}²³¹⁰⁴-⁹₀-₉①-⑨⑴-⑼⒈-⒐⓪⓵-⓽⓿❶-❾➀-➈➊-➒"
LIMIT_HINTS = ("usage limit", "rate limit", "rate_limit", "429", "overloaded", "quota", "too many requests", "capacity")
SPACE = "(?U)[\\s\\x{1C}-\\x{1F}]"


def has(text: Column | str, characters: str) -> Column:
    """Whether the text has any of the characters."""
    return F.rlike(F.col(text) if isinstance(text, str) else text, F.lit(f"[{characters}]"))


def trimmed(text: Column) -> Column:
    """Without white space at the ends, Unicode's included."""
    return F.regexp_replace(text, f"^({SPACE})+|({SPACE})+$", "")


def has_edge_space(text: Column) -> Column:
    return F.rlike(text, F.lit(f"^{SPACE}|{SPACE}$"))


def latin_tokens(text: Column) -> Column:
    """Runs of Latin letters below U+0250."""
    return F.regexp_extract_all(text, F.lit(f"([{LATIN}]+)"), F.lit(1))


def english_tokens(glosses: Column) -> Column:
    """Distinct lower-case Latin tokens of an array of texts."""
    return F.array_distinct(F.flatten(F.transform(glosses, lambda g: F.transform(latin_tokens(g), F.lower))))


def normalised(text: Column) -> Column:
    """Western and full-width commas as the ideographic one, ends trimmed."""
    return trimmed(F.translate(text, ",，", "、、"))


def looks_rate_limited(text: Column) -> Column:
    """Whether a service's message says that its limit is reached."""
    return F.rlike(F.lower(text), F.lit("|".join(LIMIT_HINTS)))


def without(tokens: Column, allowed: Column) -> Column:
    """The tokens that are not among the allowed ones, in their order."""
    return F.filter(tokens, lambda t: ~F.array_contains(allowed, t))


def first_failure(text: Column, most: Column | int, allowed: Column, english: Column | None = None, readings: Column | None = None) -> Column:
    """The first rule a translated text breaks, or null: empty, edge-space, too-long,
    cyrillic, tone-marks, english-left, latin, no-japanese. `allowed`: Latin tokens a text
    may hold; `english`: lower-case tokens of its source, which tell words left over
    from others; `readings`: whether it may hold readings and Latin words at all. A text
    of digits or of Latin words alone is one."""
    plain = ~readings if readings is not None else F.lit(True)
    foreign = F.get(without(latin_tokens(text), allowed), F.lit(0))
    left = F.array_contains(english, F.lower(foreign)) if english is not None else F.lit(False)
    return (
        F.when(text.isNull() | (text == ""), "empty")
        .when(has_edge_space(text), "edge-space")
        .when(F.length(text) > most, "too-long")
        .when(has(text, CYRILLIC), "cyrillic")
        .when(plain & has(text, TONE_MARKS), "tone-marks")
        .when(plain & left, "english-left")
        .when(plain & foreign.isNotNull(), "latin")
        .when(~has(text, HAN + KANA + LATIN + DIGITS), "no-japanese")
    )


def json_from_reply(reply: Column) -> Column:
    """The JSON of a reply: in a fenced block, else from the first bracket to the last."""
    fenced = F.regexp_extract(reply, r"(?s)```(?:json)?\s*(.*?)```", 1)
    bare = F.regexp_extract(reply, r"(?s)([\[{].*[\]}])", 1)
    return F.try_parse_json(F.when(fenced != "", fenced).otherwise(bare))


def outside_brackets(text: Column, separator: str) -> Column:
    """Parts between separators that stand outside square brackets (one level), trimmed
    and without empty ones."""
    parts = F.split(text, f"{separator}(?![^\\[]*\\])")
    return F.filter(F.transform(parts, trimmed), lambda p: p != "")
