"""Chat formatting by a template compiler.

Templates are parsed into a syntax tree, constants are folded, and each node
becomes a Python closure that yields pieces of text with their loss mask. The
language has text, `{{ expression }}`, `{% if %}`, `{% for name in expression %}`,
`{% set name = expression %}`, `{% generation %}` (what the model is to learn) and
`{# comments #}`. Expressions have strings, whole numbers, names, keys of mappings
(never attributes of Python objects), comparison, `and`, `or`, `not`, `+`, `~` and
the filters in FILTERS; nothing else can be reached from a template.

Defined cases: null texts and roles are empty; the turns of a conversation are
ordered by turn (null first), then role and text, and repeated rows are turns of
their own; rows with a null conversation form one conversation; an empty table
gives an empty table. A task holds one conversation at a time; very long texts are
formatted and read back whole, in memory of a few copies of one turn.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexiflow.llm.common import map_texts

TURN_END, TURN_START = "</turn>", "###"
CONTROL = re.compile(r"\\|###|</turn>")
ROLE_CONTROL = re.compile(r"\\|###|</turn>|:")
ESCAPED = re.compile(r"\\(\\|###|</turn>|:)")
#: An escaped sign, or what ends a role or a text.
STOPS = {end: re.compile(r"\\.|" + re.escape(end), re.S) for end in (":", TURN_END)}

CHAT_TEMPLATE = (
    "{% for m in messages %}### {{ m.role | escape_role }}: "
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}" + TURN_END + "\n{% endfor %}"
)


def escape(text: str) -> str:
    """A backslash before each control string, and before each backslash."""
    return CONTROL.sub(r"\\\g<0>", text)


def escape_role(text: str) -> str:
    return ROLE_CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    """What escape() or escape_role() was given."""
    return ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable] = {
    "escape": escape,
    "escape_role": escape_role,
    "trim": lambda v: str(v).strip(),
    "upper": lambda v: str(v).upper(),
    "lower": lambda v: str(v).lower(),
    "capitalize": lambda v: str(v).capitalize(),
    "length": len,
    "default": lambda v, other="": other if v is None else v,
}
LEXEMES = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+~<>()\[\].,|]))""", re.S)
TAGS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
Env = dict
Piece = tuple[str, bool]


class TemplateError(ValueError):
    """A template that the language does not allow."""


class Expression:
    """Recursive-descent parser of one expression; its nodes are tuples."""

    COMPARE = {"==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b, ">": lambda a, b: a > b, "<=": lambda a, b: a <= b, ">=": lambda a, b: a >= b, "in": lambda a, b: a in b}

    def __init__(self, source: str):
        self.source, self.tokens, at = source, [], 0
        source = source.rstrip()
        while at < len(source):
            m = LEXEMES.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 10]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            at = m.end()
        self.tokens.append(("end", ""))
        self.at = 0

    def take(self, *values: str) -> str | None:
        kind, value = self.tokens[self.at]
        if kind in ("sign", "name") and value in values:
            self.at += 1
            return value
        return None

    def expect(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected in {self.source!r}")

    def whole(self) -> tuple:
        node = self.either()
        if self.tokens[self.at][0] != "end":
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r} in {self.source!r}")
        return node

    def either(self) -> tuple:
        node = self.both()
        while self.take("or"):
            node = ("or", node, self.both())
        return node

    def both(self) -> tuple:
        node = self.negated()
        while self.take("and"):
            node = ("and", node, self.negated())
        return node

    def negated(self) -> tuple:
        return ("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> tuple:
        node = self.joined()
        if op := self.take(*self.COMPARE):
            node = ("compare", op, node, self.joined())
        return node

    def joined(self) -> tuple:
        node = self.filtered()
        while op := self.take("+", "~"):
            node = ("join", op, node, self.filtered())
        return node

    def filtered(self) -> tuple:
        node = self.keyed()
        while self.take("|"):
            kind, name = self.tokens[self.at]
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            given: list[tuple] = []
            if self.take("("):
                while not self.take(")"):
                    given.append(self.either())
                    self.take(",")
            node = ("filter", name, node, given)
        return node

    def keyed(self) -> tuple:
        node = self.single()
        while op := self.take(".", "["):
            if op == ".":
                kind, name = self.tokens[self.at]
                if kind != "name":
                    raise TemplateError(f"a key expected in {self.source!r}")
                self.at += 1
                node = ("key", node, ("constant", name))
            else:
                node = ("key", node, self.either())
                self.expect("]")
        return node

    def single(self) -> tuple:
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return ("constant", re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "number":
            return ("constant", int(value))
        if kind == "name":
            words = {"true": True, "false": False, "none": None}
            return ("constant", words[value.lower()]) if value.lower() in words else ("name", value)
        if value == "(":
            node = self.either()
            self.expect(")")
            return node
        raise TemplateError(f"unexpected {value!r} in {self.source!r}")


def evaluator(node: tuple) -> Callable[[Env], object]:
    """A closure that computes an expression; constants are folded on the way."""
    kind = node[0]
    if kind == "constant":
        value = node[1]
        make = lambda env: value
        make.constant = True
        return make
    if kind == "name":
        name = node[1]
        return lambda env: env.get(name)
    parts = [evaluator(n) for n in node[1:] if isinstance(n, tuple)]
    a, b = (parts + parts[:1])[:2] if parts else (None, None)
    if kind == "or":
        make = lambda env: a(env) or b(env)
    elif kind == "and":
        make = lambda env: a(env) and b(env)
    elif kind == "not":
        make = lambda env: not a(env)
    elif kind == "compare":
        test = Expression.COMPARE[node[1]]
        make = lambda env: test(a(env), b(env))
    elif kind == "join":
        make = (lambda env: a(env) + b(env)) if node[1] == "+" else (lambda env: f"{a(env)}{b(env)}")
    elif kind == "key":

        def make(env: Env) -> object:
            held, key = a(env), b(env)
            if isinstance(held, dict):
                return held.get(key)
            if isinstance(held, (list, tuple)) and isinstance(key, int):
                return held[key] if -len(held) <= key < len(held) else None
            raise TemplateError(f"{key!r} of what is no mapping")

    else:
        apply, given = FILTERS[node[1]], [evaluator(g) for g in node[3]]
        parts += given
        make = lambda env: apply(a(env), *(g(env) for g in given))
    if all(getattr(p, "constant", False) for p in parts):
        return evaluator(("constant", make({})))
    return make


def parse(source: str) -> list[tuple]:
    """The syntax tree of a template: a list of nodes."""
    stack: list[list] = [["root", []]]
    for part in TAGS.split(source):
        body = stack[-1][-1]
        if not part or part.startswith("{#"):
            continue
        if part.startswith("{{"):
            body.append(("show", Expression(part[2:-2].strip("-")).whole()))
        elif part.startswith("{%"):
            word, _, rest = part[2:-2].strip("- \n\t").partition(" ")
            if word in ("if", "for", "generation"):
                if word == "if":
                    stack.append(["if", [], Expression(rest).whole(), []])
                elif word == "for":
                    m = re.fullmatch(r"\s*([A-Za-z_]\w*)\s+in\s+(.+)", rest, re.S)
                    if not m:
                        raise TemplateError(f"cannot read {part!r}")
                    stack.append(["for", m[1], Expression(m[2]).whole(), []])
                else:
                    stack.append(["generation", []])
            elif word in ("elif", "else"):
                if stack[-1][0] != "if":
                    raise TemplateError(f"{word} without if")
                top = stack[-1]
                top[1].append((top[2], top[3]))
                top[2:] = [Expression(rest).whole() if word == "elif" else ("constant", True), []]
            elif word in ("endif", "endfor", "endgeneration"):
                top = stack.pop()
                if top[0] != word[3:] or not stack:
                    raise TemplateError(f"unexpected {word}")
                if top[0] == "if":
                    top[1].append((top[2], top[3]))
                    stack[-1][-1].append(("if", top[1]))
                else:
                    stack[-1][-1].append(tuple(top))
            elif word == "set":
                name, _, value = rest.partition("=")
                body.append(("set", name.strip(), Expression(value).whole()))
            else:
                raise TemplateError(f"no statement {word!r}")
        else:
            body.append(("text", part))
    if len(stack) > 1:
        raise TemplateError(f"{stack[-1][0]} is not ended")
    return stack[0][1]


def fold(nodes: list[tuple]) -> list[tuple]:
    """The tree with constant output as text, constant branches chosen and texts joined."""
    out: list[tuple] = []
    for node in nodes:
        if node[0] == "show":
            value = evaluator(node[1])
            made = [("text", shown(value({})))] if getattr(value, "constant", False) else [node]
        elif node[0] == "if":
            branches = []
            for test, body in node[1]:
                value = evaluator(test)
                fixed = getattr(value, "constant", False)
                if not fixed or value({}):
                    branches.append((test, fold(body)))
                if fixed and value({}):
                    break
            always = branches and getattr(evaluator(branches[0][0]), "constant", False)
            made = branches[0][1] if always else [("if", branches)] if branches else []
        elif node[0] in ("for", "generation"):
            made = [(*node[:-1], fold(node[-1]))]
        else:
            made = [node]
        for n in made:
            if n[0] == "text" and out and out[-1][0] == "text":
                out[-1] = ("text", out[-1][1] + n[1])
            else:
                out.append(n)
    return out


def shown(value: object) -> str:
    return "" if value is None else str(value)


def closure(nodes: list[tuple], masked: bool = False) -> Callable[[Env], Iterator[Piece]]:
    """A function that renders the nodes, piece by piece."""
    steps: list[Callable[[Env], Iterable[Piece]]] = []
    for node in nodes:
        if node[0] == "text":
            steps.append(lambda env, p=((node[1], masked),): p)
        elif node[0] == "show":
            steps.append(lambda env, f=evaluator(node[1]): ((shown(f(env)), masked),))
        elif node[0] == "set":
            steps.append(lambda env, n=node[1], f=evaluator(node[2]): env.__setitem__(n, f(env)) or ())
        elif node[0] == "generation":
            steps.append(closure(node[1], True))
        elif node[0] == "if":
            branches = [(evaluator(t), closure(b, masked)) for t, b in node[1]]
            steps.append(lambda env, bs=branches: next((b(env) for t, b in bs if t(env)), ()))
        else:

            def loop(env: Env, name=node[1], items=evaluator(node[2]), body=closure(node[3], masked)) -> Iterator[Piece]:
                inner = dict(env)
                for inner["index"], inner[name] in enumerate(items(env) or ()):
                    yield from body(inner)

            steps.append(loop)

    def render(env: Env) -> Iterator[Piece]:
        for step in steps:
            yield from step(env)

    return render


@functools.lru_cache(maxsize=16)
def compile_template(source: str) -> Callable[[Env], tuple[str, list[tuple[int, int]]]]:
    """A function from variables to the text and the spans (from, to) under the mask."""
    render = closure(fold(parse(source)))

    def formatted(env: Env) -> tuple[str, list[tuple[int, int]]]:
        pieces, spans, at = [], [], 0
        for text, masked in render(dict(env)):
            if masked:
                spans.append((at, at + len(text)))
            pieces.append(text)
            at += len(text)
        return "".join(pieces), spans

    return formatted


def format_conversations(df: DataFrame, template: str = CHAT_TEMPLATE, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conversation, formatted string, spans array of (start, end)): each conversation
    rendered with `messages`, and the spans under the loss mask in code points."""
    conv_type = df.schema[conv_col].dataType.simpleString()
    compile_template(template)  # a bad template fails here
    empty = F.lit("")
    rows = df.select(F.col(conv_col).alias("c"), F.col(turn_col).alias("n"), F.coalesce(F.col(role_col), empty).alias("r"), F.coalesce(F.col(text_col), empty).alias("t"))
    rows = rows.repartition("c").sortWithinPartitions("c", "n", "r", "t").select("c", "r", "t")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        render = compile_template(template)
        turns = (row for b in batches for row in zip(*(c.to_pylist() for c in b.columns)))
        done: list[tuple] = []
        held = 0

        def batch() -> pa.RecordBatch:
            ids, texts, spans = zip(*done)
            span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            return pa.RecordBatch.from_arrays([pa.array(ids), pa.array(texts), pa.array([[{"start": a, "end": b} for a, b in s] for s in spans], span)], names=[conv_col, "formatted", "spans"])

        for conv, own in groupby(turns, key=lambda row: row[0]):
            text, spans = render({"messages": ({"role": r, "text": t} for _, r, t in own)})
            done.append((conv, text, spans))
            held += len(text)
            if held > 1_000_000:
                yield batch()
                done, held = [], 0
        if done:
            yield batch()

    return rows.mapInArrow(run, f"`{conv_col}` {conv_type}, formatted string, spans array<struct<start: bigint, end: bigint>>")


def read_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """(role, text) of each turn of a conversation in the chat template, one at a time."""

    def until(start: int, end: str) -> int:
        return next((m.start() for m in STOPS[end].finditer(formatted, start) if m[0] == end), -1)

    at = 0
    while at < len(formatted):
        role = at + len(TURN_START) + 1
        colon = until(role, ":") if formatted.startswith(f"{TURN_START} ", at) else -1
        end = until(colon + 2, TURN_END) if colon >= 0 and formatted.startswith(": ", colon) else -1
        if end < 0 or not formatted.startswith(f"{TURN_END}\n", end):
            raise ValueError(f"no turn at {at}: {formatted[at:at + 40]!r}")
        yield unescape(formatted[role:colon]), unescape(formatted[colon + 2 : end])
        at = end + len(TURN_END) + 1


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """(conversation, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars):
    what the formatted text and its mask hold, read from them alone."""
    packed = formatted.select(conv_col, F.concat(F.to_json(F.transform("spans", lambda s: F.array(s["start"], s["end"]))), F.lit("\n"), "formatted").alias("packed"))

    def work(rows: list[str]) -> Iterator[tuple]:
        import json

        for row in rows:
            spans, _, text = row.partition("\n")
            n, turns, chars, loss = 0, hashlib.sha256(), 0, hashlib.sha256()
            for role, said in read_turns(text):
                n += 1
                turns.update(f"{role}\n{said}\n".encode())
            for a, b in json.loads(spans):
                said = unescape(text[a:b])
                chars += len(said)
                loss.update(said.encode())
            yield n, turns.hexdigest(), chars, loss.hexdigest(), len(text)

    return map_texts(packed, conv_col, "packed", "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint", lambda: work)
