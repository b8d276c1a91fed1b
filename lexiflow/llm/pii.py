"""Format-preserving pseudonyms of personal data, by keyed Feistel permutations.

Values are found by their format and kept only if they are valid: card numbers by
their check digit, account numbers by their remainder, addresses by their range,
dates by the calendar. The symbols of a value, each within its own alphabet, are
permuted as one number in a keyed Feistel network; where the outcome would not be
valid it is permuted again (cycle walking), so the pseudonym is valid too and the
mapping stays one-to-one. Separators stay. Equal values get equal pseudonyms in
all documents, whatever their separators, as long as the key is the same.

What is found: e-mail addresses, IBANs, access keys that begin with AKIA or ASIA,
what is assigned to names like password, token, secret or api key, dates of four
written forms, social security numbers, IPv4 addresses, phone and card numbers.

Defined cases: a null text stays null; empty texts and texts without such values
stay as they are; very long texts are read whole; repeated rows are treated
alike; of values that overlap the one that begins first holds, and of those that
begin together the kind listed first; an empty table gives an empty table; rows with
a null id are kept.
"""

from __future__ import annotations

import functools
import hashlib
import re
import string
from collections.abc import Callable, Iterator
from datetime import date

from pyspark.sql import DataFrame

from lexiflow.llm.common import held, map_texts

ROUNDS = 10
#: Most walks along a cycle; the share of valid outcomes is over a tenth for each kind.
MOST_WALKS = 10_000
DEMO_KEY = "public demonstration key"  # pass your own
#: Dates are permuted within spans of so many years, one of which begins in 1900.
SPAN_YEARS, DAY_RADIX = 200, 272

# Lengths of account numbers (IBAN) by country.
IBAN_LENGTHS = dict(
    AD=24, AE=23, AL=28, AT=20, AZ=28, BA=20, BE=16, BG=22, BH=22, BR=29, BY=28, CH=21, CR=22, CY=28, CZ=24, DE=22, DK=18, DO=28,
    EE=20, EG=29, ES=24, FI=18, FO=18, FR=27, GB=22, GE=22, GI=23, GL=18, GR=27, GT=28, HR=21, HU=28, IE=22, IL=23, IQ=23, IS=26,
    IT=27, JO=30, KW=30, KZ=20, LB=28, LC=32, LI=21, LT=20, LU=20, LV=21, LY=25, MC=27, MD=24, ME=22, MK=19, MR=27, MT=31, MU=30,
    NL=18, NO=15, PK=24, PL=28, PS=29, PT=25, QA=29, RO=24, RS=22, SA=24, SC=31, SD=18, SE=24, SI=19, SK=24, SM=27, ST=25, SV=28,
    TL=23, TN=24, TR=26, UA=29, VA=22, VG=24, XK=20,
)
#: A text without any of these holds no value.
CANDIDATE = re.compile(r"[0-9@]|AKIA|ASIA|[pP][aA][sS][sS]|[pP][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[kK][eE][yY]")
# Written formats of the kinds of values. A secret is an access key, or what
# is assigned to a name of secrets: hexadecimal digits, or signs with a digit among them.
FORMATS = re.compile(
    r"""(?P<email>(?<![\w.%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})
    |(?P<iban>(?<!\w)[A-Za-z]{2}\d{2}(?:[ ]?[A-Za-z0-9]{4}){2,7}(?:[ ]?[A-Za-z0-9]{1,3})?(?!\w))
    |(?P<key>(?<!\w)(?:AKIA|ASIA)[A-Z0-9]{16}(?!\w))
    |(?<![A-Za-z])(?i:password|passwd|passphrase|pwd|secret|token|(?:api|access|auth|private|secret)[_ -]?key)["']?[ ]{0,2}(?:=>|[:=])[ ]{0,2}["']?
     (?P<secret>(?:[0-9a-f]{12,64}|[0-9A-F]{12,64}|(?=[A-Za-z+/_-]{0,40}\d)[A-Za-z0-9+/_-]{8,200})(?![\w+/-]))
    |(?P<date>(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?![\w-]|\.\d))
    |(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
    |(?P<address>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?!\w|\.\d))
    |(?P<phone>(?<![\w+])(?:\+1[ .-]?)?(?:\(\d{3}\)[ ]?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]\d)?(?:[ .-]?\(?\d{2,4}\)?){2,5}(?!\w))
    |(?P<card>(?<![\w-])\d(?:[ -]?\d){12,18}(?!\w|-(?!\d)))""",
    re.X,
)


class Feistel:
    """Keyed permutations of sequences of symbols of given radices."""

    def __init__(self, key: str):
        self.key = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def permute(self, symbols: list[int], radices: list[int], kind: str) -> list[int]:
        """Another sequence within the radices; one-to-one for each kind and radices."""
        half = len(symbols) // 2 or len(symbols)
        sizes, values = [1, 1], [0, 0]
        for k, (s, r) in enumerate(zip(symbols, radices)):
            side = k >= half
            sizes[side], values[side] = sizes[side] * r, values[side] * r + s
        for n in range(ROUNDS):
            side = n % 2
            message = f"{kind}|{','.join(map(str, radices))}|{n}|{values[1 - side]}".encode()
            mixed = int.from_bytes(hashlib.blake2b(message, key=self.key, digest_size=40).digest(), "big")
            values[side] = (values[side] + mixed) % sizes[side]
        out = [0] * len(symbols)
        for k in reversed(range(len(symbols))):
            side = k >= half
            values[side], out[k] = divmod(values[side], radices[k])
        return out

    def walk(self, symbols: list[int], radices: list[int], kind: str, valid: Callable[[list[int]], bool]) -> list[int]:
        """permute(), again and again until the outcome is valid; valid sequences are
        permuted among themselves."""
        for _ in range(MOST_WALKS):
            symbols = self.permute(symbols, radices, kind)
            if valid(symbols):
                return symbols
        raise ValueError(f"no valid {kind} found")


def luhn(digits: list[int]) -> bool:
    total = sum(digits[-1::-2]) + sum(sum(divmod(2 * d, 10)) for d in digits[-2::-2])
    return total % 10 == 0


def iban_remainder(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def digits_of(text: str) -> list[int]:
    return [int(c) for c in text if c.isdigit()]


def with_digits(text: str, digits: list[int]) -> str:
    """The text with its digits replaced in order."""
    fresh = iter(digits)
    return "".join(str(next(fresh)) if c.isdigit() else c for c in text)


def fpe_text(text: str, feistel: Feistel, kind: str) -> str:
    """Letters and digits permuted within their classes; case and signs stay."""
    classes = (string.digits, string.ascii_lowercase, string.ascii_uppercase)
    places = [(k, c) for k, char in enumerate(text) for c in classes if char in c]
    symbols = feistel.permute([c.index(text[k]) for k, c in places], [len(c) for _, c in places], kind)
    out = list(text)
    for (k, c), s in zip(places, symbols):
        out[k] = c[s]
    return "".join(out)


def email(value: str, feistel: Feistel) -> str:
    name, _, domain = value.partition("@")
    return f"{fpe_text(name, feistel, 'email ' + domain)}@{domain}"


def access_key(value: str, feistel: Feistel) -> str:
    return value[:4] + fpe_text(value[4:], feistel, "key")


def secret(value: str, feistel: Feistel) -> str:
    """Hexadecimal digits of one case stay such; other signs stay in their classes."""
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", value):
        symbols = feistel.permute([int(c, 16) for c in value], [16] * len(value), "secret")
        text = "".join(f"{s:x}" for s in symbols)
        return text.upper() if value.upper() == value else text
    return fpe_text(value, feistel, "secret")


def iban(value: str, feistel: Feistel) -> str | None:
    """Equal numbers get the same pseudonym in any case and spacing. Numbers of countries
    that the table lacks are known by their remainder, if they are in capitals."""
    plain = value.replace(" ", "").upper()
    known = IBAN_LENGTHS.get(plain[:2])
    fits = len(plain) == known if known else 15 <= len(plain) <= 34 and value.upper() == value
    if not fits or iban_remainder(plain) != 1:
        return None
    body = fpe_text(plain[4:], feistel, "iban " + plain[:2])
    fresh = iter(f"{plain[:2]}{98 - iban_remainder(plain[:2] + '00' + body):02d}{body}")
    moved = "".join(c if c == " " else next(fresh) for c in value)
    return moved if value.upper() == value else moved.lower()


def day(value: str, feistel: Feistel) -> str | None:
    """Dates of the calendar, moved within their span of years; of two readings of day
    and month the one with the day first holds, if it is a date."""
    parts = [int(p) for p in re.split(r"[-/.]", value)]
    first = value[4:5] in "-/" and len(value.split(value[4])[0]) == 4
    orders = [(0, 1, 2)] if first else [(2, 1, 0), (2, 0, 1)] if "/" in value else [(2, 1, 0)]
    for order in orders:
        try:
            given = date(*(parts[k] for k in order))
        except ValueError:
            continue
        span = (given.year - 100) // SPAN_YEARS * SPAN_YEARS + 100
        start = date(max(1, span), 1, 1).toordinal()
        days = date(min(9999, span + SPAN_YEARS - 1), 12, 31).toordinal() + 1 - start
        radices = [-(-days // DAY_RADIX), DAY_RADIX]
        ok = lambda s: s[0] * DAY_RADIX + s[1] < days
        high, low = feistel.walk(list(divmod(given.toordinal() - start, DAY_RADIX)), radices, f"date {span}", ok)
        moved = date.fromordinal(start + high * DAY_RADIX + low)
        numbers = iter(sorted(zip(order, (f"{moved.year:04d}", f"{moved.month:02d}", f"{moved.day:02d}"))))
        return re.sub(r"\d+", lambda m: next(numbers)[1], value)
    return None


def ssn(value: str, feistel: Feistel) -> str | None:
    def ok(d: list[int]) -> bool:
        area = d[0] * 100 + d[1] * 10 + d[2]
        return area not in (0, 666) and area < 900 and any(d[3:5]) and any(d[5:])

    digits = digits_of(value)
    return with_digits(value, feistel.walk(digits, [10] * 9, "ssn", ok)) if ok(digits) else None


def address(value: str, feistel: Feistel) -> str | None:
    octets = [int(x) for x in value.split(".")]
    if max(octets) > 255 or any(len(x) > 1 and x[0] == "0" for x in value.split(".")):
        return None
    kind = lambda o: (o[0] in (0, 10, 127) or o[0] >= 224, o[0] == 172 and 16 <= o[1] < 32, o[:2] == [192, 168])
    if any(kind(octets)):  # no public address: the last octets only
        return ".".join(map(str, octets[:2] + feistel.permute(octets[2:], [256, 256], f"address {octets[:2]}")))
    return ".".join(map(str, feistel.walk(octets, [256] * 4, "address", lambda o: not any(kind(o)))))


def phone(value: str, feistel: Feistel) -> str:
    digits = digits_of(value)
    if len(digits) == 10 and "+" not in value or len(digits) == 11 and value.startswith("+1"):  # behind a plus stands a country
        code, local = digits[:-10], digits[-10:]
        regular = lambda d: d[0] > 1 and d[3] > 1
        if regular(local):
            return with_digits(value, code + feistel.walk(local, [10] * 10, "phone", regular))
        return with_digits(value, code + feistel.walk(local, [10] * 10, "phone", lambda d: not regular(d)))
    keep = min(2, len(digits) - 2)
    return with_digits(value, digits[:keep] + feistel.permute(digits[keep:], [10] * (len(digits) - keep), f"phone {digits[:keep]}"))


def card(value: str, feistel: Feistel) -> str | None:
    """The first digit stays, the last is the check digit of the others."""
    digits = digits_of(value)
    if len(digits) < 13 or not luhn(digits):
        return None
    body = digits[:1] + feistel.permute(digits[1:-1], [10] * (len(digits) - 2), f"card {digits[0]}")
    return with_digits(value, body + next([c] for c in range(10) if luhn([*body, c])))


#: Where a value may end before its longest match does: before a separator.
ENDS = {"card": re.compile(r"[ -]"), "iban": re.compile(" ")}
KINDS: dict[str, Callable[[str, Feistel], str | None]] = {"email": email, "iban": iban, "key": access_key, "secret": secret, "date": day, "ssn": ssn, "address": address, "phone": phone, "card": card}


class Pseudonymiser:
    """Replaces values in texts; remembers the latest ones."""

    def __init__(self, key: str):
        feistel = Feistel(key)
        self.of = functools.lru_cache(maxsize=100_000)(lambda kind, value: KINDS[kind](value, feistel))

    def apply(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and (kind, start, end) of each value in the original."""
        if not CANDIDATE.search(text):
            return text, []
        out, spans, at, look = [], [], 0, 0
        while m := FORMATS.search(text, look):
            fresh, end = self.longest(m)
            start = m.start(m.lastgroup)
            if fresh is None:  # not valid: what begins within it may be
                look = start + 1
                while look < len(text) and text[look].isalnum():
                    look += 1
                continue
            spans.append((m.lastgroup, start, end))
            out += [text[at:start], fresh]
            at = look = end
        return "".join([*out, text[at:]]), spans

    def longest(self, m: re.Match) -> tuple[str | None, int]:
        """The pseudonym of the longest valid value at a match's start, and its end."""
        kind = m.lastgroup
        value, start = m.group(kind), m.start(kind)
        ends = [x.start() for x in ENDS[kind].finditer(value)] if kind in ENDS else []
        for end in (len(value), *reversed(ends)):
            fresh = self.of(kind, value[:end])
            if fresh is not None:
                return fresh, start + end
        return None, m.end()


def pseudonymiser(key: str) -> Pseudonymiser:
    return held(("pseudonyms", key), lambda: Pseudonymiser(key))


def pseudonymise(df: DataFrame, key: str = DEMO_KEY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, values array of (kind, start, end)): each whole text with its personal
    data replaced by pseudonyms, and where they stood in the original."""

    def make():
        p = pseudonymiser(key)

        def work(texts: list[str]) -> Iterator[tuple]:
            for t in texts:
                text, spans = (None, []) if t is None else p.apply(t)
                yield text, [{"kind": k, "start": a, "end": b} for k, a, b in spans]

        return work

    return map_texts(df, id_col, text_col, "text string, values array<struct<kind: string, start: bigint, end: bigint>>", make, keep_null=True)
