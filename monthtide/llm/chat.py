"""Conversations as marked text: a compiler for a small sandboxed template language, and the way back."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from monthtide.llm.common import per_batch

START, END = "<|im_start|>", "<|im_end|>"

#: One block per turn; what stands between generation marks is under the loss mask.
CHATML = (
    "{% for turn in turns %}{{ '<|im_' + 'start|>' }}{{ turn.role | escape }}\n"
    "{% if turn.role == 'assistant' %}{% generation %}{{ turn.text | escape }}{% endgeneration %}"
    "{% else %}{{ turn.text | escape }}{% endif %}{{ '<|im_' + 'end|>' }}\n{% endfor %}"
)


def escape(text: str) -> str:
    """The text without any control string or line end: a backslash goes into each <| and before each backslash."""
    return text.replace("\\", "\\\\").replace("<|", "<\\|").replace("\n", "\\n")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], text, flags=re.S)


# --- the language -------------------------------------------------------------------------------------------------
#
#   text, {{ expression }}, {% for name in expression %} .. {% endfor %}, {% if e %} .. {% elif e %} .. {% else %} .. {% endif %},
#   {% generation %} .. {% endgeneration %}.  Expressions: strings, whole numbers, true, false, none, names, name.field,
#   loop.first, loop.last, loop.index0; + == != and or not; filters escape, trim, upper, lower; parentheses.
#   No calls, subscripts or attributes of Python objects: fields are keys of dicts, and names those that were passed.


class TemplateError(ValueError):
    """The template can't be compiled."""


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str
    parts: tuple[str, ...] = ()


@dataclass(frozen=True)
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Emit:
    value: object


@dataclass(frozen=True)
class For:
    name: str
    source: object
    body: tuple


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


@dataclass
class Output:
    """What a template writes: the text so far and the (start, end) of the parts under the loss mask."""

    parts: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)


_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+|().]))")
_FILTERS: dict[str, Callable[[str], str]] = {"escape": escape, "trim": str.strip, "upper": str.upper, "lower": str.lower}
_WORDS = {"true": True, "false": False, "none": None}


def _string(token: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t"}.get(m[1], m[1]), token[1:-1])


class _Expression:
    """Recursive descent: or, and, not, comparison, sum, filters, values."""

    def __init__(self, source: str) -> None:
        self.tokens, at = [], 0
        source = source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append(next((k, m[k + 1]) for k in range(4) if m[k + 1] is not None))
            at = m.end()
        self.at = 0

    def peek(self, *texts: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] > 1 and self.tokens[self.at][1] in texts

    def take(self, *texts: str) -> bool:
        found = self.peek(*texts)
        self.at += found
        return found

    def whole(self) -> object:
        value = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return value

    def either(self) -> object:
        value = self.both()
        while self.take("or"):
            value = Op("or", (value, self.both()))
        return value

    def both(self) -> object:
        value = self.denied()
        while self.take("and"):
            value = Op("and", (value, self.denied()))
        return value

    def denied(self) -> object:
        return Op("not", (self.denied(),)) if self.take("not") else self.compared()

    def compared(self) -> object:
        value = self.added()
        for sign in ("==", "!="):
            if self.take(sign):
                return Op(sign, (value, self.added()))
        return value

    def added(self) -> object:
        value = self.filtered()
        while self.take("+"):
            value = Op("+", (value, self.filtered()))
        return value

    def filtered(self) -> object:
        value = self.value()
        while self.take("|"):
            kind, name = self.next()
            if kind != 2 or name not in _FILTERS:
                raise TemplateError(f"unknown filter {name!r}")
            value = Op("filter", (Const(name), value))
        return value

    def next(self) -> tuple[int, str]:
        if self.at >= len(self.tokens):
            raise TemplateError("the expression ends too early")
        self.at += 1
        return self.tokens[self.at - 1]

    def value(self) -> object:
        kind, text = self.next()
        if kind == 0:
            return Const(_string(text))
        if kind == 1:
            return Const(int(text))
        if kind == 2 and text not in ("and", "or", "not"):
            if text in _WORDS:
                return Const(_WORDS[text])
            parts = []
            while self.take("."):
                kind, part = self.next()
                if kind != 2 or part.startswith("_"):
                    raise TemplateError(f"not a field: {part!r}")
                parts.append(part)
            return Name(text, tuple(parts))
        if text == "(":
            value = self.either()
            if not self.take(")"):
                raise TemplateError("a parenthesis isn't closed")
            return value
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> tuple:
    """The template's syntax tree."""
    pieces = re.split(r"(\{\{.*?\}\}|\{%.*?%\})", source, flags=re.S)
    at = 0

    def block(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        out: list = []
        while at < len(pieces):
            piece = pieces[at]
            at += 1
            if at % 2:
                if piece:
                    out.append(Emit(Const(piece)))
            elif piece.startswith("{{"):
                out.append(Emit(_Expression(piece[2:-2]).whole()))
            else:
                said = piece[2:-2].strip()
                word = said.split(None, 1)[0] if said else ""
                if word in ends:
                    return tuple(out), said
                out.append(statement(said, word))
        if ends:
            raise TemplateError(f"missing {ends[0]}")
        return tuple(out), ""

    def statement(said: str, word: str) -> object:
        if word == "for":
            m = re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+(.+)", said, flags=re.S)
            if not m:
                raise TemplateError(f"not a loop: {said!r}")
            return For(m[1], _Expression(m[2]).whole(), block("endfor")[0])
        if word == "if":
            return choice(said[2:])
        if word == "generation":
            return Generation(block("endgeneration")[0])
        raise TemplateError(f"unknown statement {said!r}")

    def choice(test: str) -> object:
        then, end = block("endif", "elif", "else")
        other: tuple = ()
        if end.startswith("elif"):
            other = (choice(end[4:]),)
        elif end == "else":
            other = block("endif")[0]
        return If(_Expression(test).whole(), then, other)

    return block()[0]


def _apply(kind: str, args: tuple) -> object:
    if kind == "+":
        return _text(args[0]) + _text(args[1]) if any(isinstance(a, str) for a in args) else args[0] + args[1]
    if kind == "filter":
        return _FILTERS[args[0]](_text(args[1]))
    return args[0] == args[1] if kind == "==" else args[0] != args[1] if kind == "!=" else not args[0]


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


def folded(tree: object) -> object:
    """The tree with constant expressions computed, dead branches left out and neighbouring text joined."""
    if isinstance(tree, tuple):
        out: list = []
        for node in map(folded, tree):
            for n in node if isinstance(node, tuple) else (node,):
                if isinstance(n, Emit) and isinstance(n.value, Const):
                    n = Emit(Const(_text(n.value.value)))
                    if out and isinstance(out[-1], Emit) and isinstance(out[-1].value, Const):
                        out[-1] = Emit(Const(out[-1].value.value + n.value.value))
                        continue
                out.append(n)
        return tuple(out)
    if isinstance(tree, Op):
        args = tuple(map(folded, tree.args))
        if tree.kind in ("and", "or"):
            if isinstance(args[0], Const):
                return args[1] if bool(args[0].value) == (tree.kind == "and") else args[0]
        elif all(isinstance(a, Const) for a in args):
            return Const(_apply(tree.kind, tuple(a.value for a in args)))
        return Op(tree.kind, args)
    if isinstance(tree, Emit):
        return Emit(folded(tree.value))
    if isinstance(tree, For):
        return For(tree.name, folded(tree.source), folded(tree.body))
    if isinstance(tree, If):
        test, then, other = folded(tree.test), folded(tree.then), folded(tree.other)
        return (then if test.value else other) if isinstance(test, Const) else If(test, then, other)
    return Generation(folded(tree.body)) if isinstance(tree, Generation) else tree


def _value(tree: object) -> Callable[[dict], object]:
    if isinstance(tree, Const):
        return lambda scope, v=tree.value: v
    if isinstance(tree, Name):

        def look(scope: dict) -> object:
            found = scope.get(tree.name)
            for part in tree.parts:
                found = found.get(part) if isinstance(found, dict) else None
            return found

        return look
    args = tuple(map(_value, tree.args))
    if tree.kind in ("and", "or"):
        left, right = args
        return (lambda s: left(s) and right(s)) if tree.kind == "and" else (lambda s: left(s) or right(s))
    return lambda scope: _apply(tree.kind, tuple(a(scope) for a in args))


def _action(tree: object) -> Callable[[dict, Output], None]:
    if isinstance(tree, tuple):
        steps = tuple(map(_action, tree))

        def run(scope: dict, out: Output) -> None:
            for step in steps:
                step(scope, out)

        return run
    if isinstance(tree, Emit):
        if isinstance(tree.value, Const):
            return lambda scope, out, text=tree.value.value: out.write(text)
        value = _value(tree.value)
        return lambda scope, out: out.write(_text(value(scope)))
    if isinstance(tree, If):
        test, then, other = _value(tree.test), _action(tree.then), _action(tree.other)
        return lambda scope, out: then(scope, out) if test(scope) else other(scope, out)
    if isinstance(tree, Generation):
        body = _action(tree.body)

        def marked(scope: dict, out: Output) -> None:
            start = out.length
            body(scope, out)
            out.spans.append((start, out.length))

        return marked
    source, body = _value(tree.source), _action(tree.body)

    def loop(scope: dict, out: Output) -> None:
        items = source(scope)
        items = items if isinstance(items, (list, tuple)) else []
        for k, item in enumerate(items):
            body(scope | {tree.name: item, "loop": {"first": k == 0, "last": k == len(items) - 1, "index0": k}}, out)

    return loop


def compiled(source: str) -> Callable[[dict], tuple[str, list[tuple[int, int]]]]:
    """A function from names to the text that the template makes of them and the spans of its generation marks."""
    action = _action(folded(parse(source)))

    def render(names: dict) -> tuple[str, list[tuple[int, int]]]:
        out = Output()
        action(dict(names), out)
        return "".join(out.parts), out.spans

    return render


def turns_of(text: str) -> list[tuple[str, str]]:
    """The (role, text) that a text of the CHATML template was made of."""
    out = []
    for part in text.split(END + "\n")[:-1]:
        role, body = part.removeprefix(START).split("\n", 1)
        out.append((unescape(role), unescape(body)))
    return out


def format_conversations(conversations: DataFrame, template: str = CHATML) -> DataFrame:
    """(conv_id, formatted, spans): each conversation as the template makes it of its turns, in the order of turn.

    spans are the (start, end) in code points of what the template marks as generated. Null roles and texts are empty;
    turns of one number come in the order of role and text, null numbers first; a row repeated in full is a turn each time. A null
    conv_id is a conversation like others. Other columns are ignored; an empty table gives no rows.
    A conversation becomes one text, so its turns meet in one row; different conversations share none.
    """
    compiled(template)  # errors show here
    rows = conversations.select("conv_id", F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    rows = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("turns"))
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        render = compiled(template)
        done = [render({"turns": x}) for x in batch.column("turns").to_pylist()]
        spans = [[{"start": a, "end": b} for a, b in x[1]] for x in done]
        place = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        columns = [batch.column("conv_id"), pa.array([x[0] for x in done], pa.string()), pa.array(spans, place)]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "formatted", "spans"])

    return rows.mapInArrow(per_batch(run), f"conv_id {kind}, formatted string, spans array<struct<start: bigint, end: bigint>>")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, formatted, roles, texts, loss_texts) of each row of (conv_id, formatted, spans), made by the CHATML template."""
    kind = formatted.schema["conv_id"].dataType.simpleString()

    def run(batch: pa.RecordBatch) -> Iterable[pa.RecordBatch]:
        roles, texts, losses = [], [], []
        for text, spans in zip(batch.column("formatted").to_pylist(), batch.column("spans").to_pylist()):
            turns = turns_of(text)
            roles.append([r for r, _ in turns])
            texts.append([t for _, t in turns])
            losses.append([unescape(text[s["start"] : s["end"]]) for s in spans])
        strings = pa.list_(pa.string())
        columns = [batch.column("conv_id"), batch.column("formatted"), *(pa.array(x, strings) for x in (roles, texts, losses))]
        yield pa.RecordBatch.from_arrays(columns, ["conv_id", "formatted", "roles", "texts", "loss_texts"])

    schema = f"conv_id {kind}, formatted string, roles array<string>, texts array<string>, loss_texts array<string>"
    return formatted.select("conv_id", "formatted", "spans").mapInArrow(per_batch(run), schema)
