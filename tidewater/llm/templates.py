"""A small sandboxed template language, compiled to Python closures.

Source is parsed into a syntax tree, constants are folded, and every node becomes a
closure, so that rendering a conversation runs no parser.

  ``{{ value }}``  ``{# remark #}``  and, with ``-`` inside either end of a tag, the
  white space beside it removed
  ``{% for x in list %} .. {% endfor %}`` (``loop.index``, ``loop.first``, ``loop.last``)
  ``{% if a %} .. {% elif b %} .. {% else %} .. {% endif %}``  ``{% set x = value %}``
  ``{% generation %} .. {% endgeneration %}``: output that a model learns to produce
  values: strings, whole numbers, ``true false none``, names, ``a.key``, ``a['key']``,
  ``a if c else b``, ``or and not``, comparisons, ``in``, ``~ + - %``, filters ``a | trim``

Sandbox: a name is looked up in the values given to ``render`` and nowhere else; a key
only in a mapping, never as a Python attribute; nothing can be called but the
filters listed; there is no multiplication or power, so a template's output is bounded by
its own length and its input.  Unknown names and keys are undefined: false, and empty
when printed.  Errors of syntax raise ``TemplateError`` with the place.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from typing import Any


class TemplateError(ValueError):
    """The template does not follow the language."""


class _Undefined:
    def __bool__(self) -> bool:
        return False

    def __str__(self) -> str:
        return ""


UNDEFINED = _Undefined()


# --- syntax tree --------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Op:
    """An operator on values: ``kind`` names an entry of ``_OPERATIONS`` or a filter (``|name``)."""

    kind: str
    args: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class If:
    """Branches of (condition, body); a missing condition is true."""

    branches: tuple


@dataclass(frozen=True)
class For:
    name: str
    items: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# --- parser -------------------------------------------------------------------------

_TAG = re.compile(r"(\{\{|\{%|\{#)(-?)(.*?)(-?)(\}\}|%\}|#\})", re.S)
_CLOSES = {"{{": "}}", "{%": "%}", "{#": "#}"}
_TOKEN = re.compile(r"""\s*(?:(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-<>~+%|.\[\](),=]))""", re.S)
_WORDS = {"true": True, "false": False, "none": None}
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_RESERVED = {"or", "and", "not", "in", "is", "if", "else", "for", "elif", "set", "endif", "endfor"}


class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str, filters: Iterable[str]):
        self.tokens, self.at, self.source, self.filters = [], 0, source, filters
        end = 0
        while source[end:].strip():
            m = _TOKEN.match(source, end)
            if not m:
                raise TemplateError(f"cannot read {source[end:]!r}")
            self.tokens.append((m.lastgroup, m.group(m.lastgroup)))
            end = m.end()

    def peek(self) -> str | None:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "string" else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted and self.peek() is not None:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"{wanted!r} is missing in {self.source!r}")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            word = self.tokens[self.at][1]
            if not word.startswith("_") and word not in _WORDS and word not in _RESERVED:
                self.at += 1
                return word
        raise TemplateError(f"a name is missing in {self.source!r}")

    def whole(self):
        node = self.choice()
        self.done()
        return node

    def done(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is not expected in {self.source!r}")

    def choice(self):
        value = self.either()
        if self.take("if"):
            condition = self.either()
            other = self.choice() if self.take("else") else Const("")
            return Op("choose", (condition, value, other))
        return value

    def either(self):
        node = self.both()
        while self.take("or"):
            node = Op("or", (node, self.both()))
        return node

    def both(self):
        node = self.negated()
        while self.take("and"):
            node = Op("and", (node, self.negated()))
        return node

    def negated(self):
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self):
        node = self.joined()
        while True:
            if sign := self.take("==", "!=", "<", "<=", ">", ">=", "in"):
                node = Op(sign, (node, self.joined()))
            elif self.take("is"):
                no = self.take("not")
                self.need("defined")
                node = Op("defined", (node,))
                node = Op("not", (node,)) if no else node
            elif self.peek() == "not" and self.at + 1 < len(self.tokens) and self.tokens[self.at + 1][1] == "in":
                self.at += 2
                node = Op("not", (Op("in", (node, self.joined())),))
            else:
                return node

    def joined(self):
        node = self.summed()
        while self.take("~"):
            node = Op("~", (node, self.summed()))
        return node

    def summed(self):
        node = self.filtered()
        while sign := self.take("+", "-", "%"):
            node = Op(sign, (node, self.filtered()))
        return node

    def filtered(self):
        node = self.member()
        while self.take("|"):
            name = self.name()
            if name not in self.filters:
                raise TemplateError(f"there is no filter {name!r}")
            args = [node]
            if self.take("(") and not self.take(")"):
                args.append(self.choice())
                while self.take(","):
                    args.append(self.choice())
                self.need(")")
            node = Op("|" + name, tuple(args))
        return node

    def member(self):
        node = self.single()
        while True:
            if self.take("."):
                node = Op("get", (node, Const(self.name())))
            elif self.take("["):
                node = Op("get", (node, self.choice()))
                self.need("]")
            else:
                return node

    def single(self):
        if self.take("("):
            node = self.choice()
            self.need(")")
            return node
        if self.at < len(self.tokens):
            kind, word = self.tokens[self.at]
            if kind == "string":
                self.at += 1
                return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), word[1:-1], flags=re.S))
            if kind == "number":
                self.at += 1
                return Const(int(word))
            if word in _WORDS:
                self.at += 1
                return Const(_WORDS[word])
        return Name(self.name())


class _Parser:
    def __init__(self, source: str, filters: Iterable[str]):
        self.filters, self.parts, end, trim = filters, [], 0, False
        for m in _TAG.finditer(source):
            if _CLOSES[m[1]] != m[5]:
                raise TemplateError(f"{m[0]!r} does not end as it begins")
            self._text(source[end : m.start()], trim, m[2] == "-")
            trim, end = m[4] == "-", m.end()
            if m[1] != "{#":
                self.parts.append((m[1], m[3].strip()))
        self._text(source[end:], trim, False)
        self.at = 0

    def _text(self, text: str, left: bool, right: bool) -> None:
        text = text.lstrip() if left else text
        text = text.rstrip() if right else text
        if any(mark in text for mark in ("{{", "{%", "{#")):
            raise TemplateError(f"a tag is not closed in {text!r}")
        if text:
            self.parts.append(("", text))

    def expression(self, source: str) -> _Expression:
        return _Expression(source, self.filters)

    def body(self, *ends: str) -> tuple[tuple, str]:
        """The nodes up to a tag that begins with one of ``ends``, and that tag."""
        nodes = []
        while self.at < len(self.parts):
            kind, source = self.parts[self.at]
            self.at += 1
            if kind == "":
                nodes.append(Text(source))
            elif kind == "{{":
                nodes.append(Output(self.expression(source).whole()))
            else:
                word = source.split(None, 1)[0] if source else ""
                rest = source[len(word) :]
                if word in ends:
                    return tuple(nodes), source
                nodes.append(self.statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(nodes), ""

    def statement(self, word: str, rest: str):
        if word == "set":
            e = self.expression(rest)
            name = e.name()
            e.need("=")
            return Set(name, e.whole())
        if word == "for":
            e = self.expression(rest)
            name = e.name()
            e.need("in")
            items = e.whole()
            body, end = self.body("endfor")
            self.expression(end[len("endfor") :]).done()
            return For(name, items, body)
        if word == "generation":
            self.expression(rest).done()
            body, end = self.body("endgeneration")
            return Generation(body)
        if word == "if":
            branches, condition = [], self.expression(rest).whole()
            while True:
                body, end = self.body("elif", "else", "endif")
                branches.append((condition, body))
                if end.startswith("elif"):
                    condition = self.expression(end[4:]).whole()
                elif end.startswith("else"):
                    body, end = self.body("endif")
                    branches.append((Const(True), body))
                    return If(tuple(branches))
                else:
                    return If(tuple(branches))
        raise TemplateError(f"{word!r} is not expected")


def parse(source: str, filters: Iterable[str] = ()) -> tuple:
    """The syntax tree of a template."""
    return _Parser(source, set(filters) | set(FILTERS)).body()[0]


# --- operations, folding, closures --------------------------------------------------


def printed(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def _get(of: Any, key: Any) -> Any:
    if isinstance(of, dict):
        return of.get(key, UNDEFINED)
    if isinstance(of, list | tuple) and isinstance(key, int) and not isinstance(key, bool):
        return of[key] if -len(of) <= key < len(of) else UNDEFINED
    return UNDEFINED


def _sum(a: Any, b: Any) -> Any:
    if isinstance(a, str) or isinstance(b, str):
        return printed(a) + printed(b)
    return a + b


def _within(a: Any, b: Any) -> bool:
    return isinstance(b, str | dict | list | tuple) and (not isinstance(b, str) or isinstance(a, str)) and a in b


def _rest(a: Any, b: Any) -> int:
    if isinstance(a, int) and isinstance(b, int) and b:
        return a % b
    raise TemplateError("% takes whole numbers, the second not 0")


_OPERATIONS: dict[str, Callable] = {
    "get": _get,
    "not": lambda a: not a,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "in": _within,
    "~": lambda a, b: printed(a) + printed(b),
    "+": _sum,
    "-": lambda a, b: a - b,
    "%": _rest,
    "defined": lambda a: a is not UNDEFINED,
}

FILTERS: dict[str, Callable] = {
    "trim": lambda a: printed(a).strip(),
    "upper": lambda a: printed(a).upper(),
    "lower": lambda a: printed(a).lower(),
    "string": printed,
    "length": lambda a: len(a) if isinstance(a, str | dict | list | tuple) else 0,
    "default": lambda a, b="": b if a is UNDEFINED else a,
}


def _fold_value(node, filters: dict):
    if not isinstance(node, Op):
        return node
    args = tuple(_fold_value(a, filters) for a in node.args)
    if node.kind == "choose" and isinstance(args[0], Const):
        return args[1] if args[0].value else args[2]
    if node.kind in ("and", "or") and isinstance(args[0], Const):
        return args[1] if bool(args[0].value) == (node.kind == "and") else args[0]
    node = Op(node.kind, args)
    if args and all(isinstance(a, Const) for a in args) and node.kind not in ("choose", "and", "or"):
        return Const(_value(node, filters)({}))
    return node


def fold(nodes: tuple, filters: dict | None = None) -> tuple:
    """The tree with constant values computed, dead branches gone and neighbouring text joined."""
    filters, out = FILTERS if filters is None else filters, []

    def add(node) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].value + node.value)
        elif not (isinstance(node, Text) and not node.value):
            out.append(node)

    for node in nodes:
        if isinstance(node, Output):
            value = _fold_value(node.value, filters)
            add(Text(printed(value.value)) if isinstance(value, Const) else Output(value))
        elif isinstance(node, Set):
            add(Set(node.name, _fold_value(node.value, filters)))
        elif isinstance(node, For):
            add(For(node.name, _fold_value(node.items, filters), fold(node.body, filters)))
        elif isinstance(node, Generation):
            add(Generation(fold(node.body, filters)))
        elif isinstance(node, If):
            branches = []
            for condition, body in node.branches:
                condition = _fold_value(condition, filters)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold(body, filters)))
                if isinstance(condition, Const):
                    break
            if branches and isinstance(branches[0][0], Const):
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(If(tuple(branches)))
        else:
            add(node)
    return tuple(out)


def _value(node, filters: dict) -> Callable[[dict], Any]:
    """A closure from the scope to the value of an expression."""
    if isinstance(node, Const):
        constant = node.value
        return lambda scope: constant
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name, UNDEFINED)
    args = [_value(a, filters) for a in node.args]
    if node.kind == "choose":
        condition, first, second = args
        return lambda scope: first(scope) if condition(scope) else second(scope)
    if node.kind == "and":
        first, second = args
        return lambda scope: first(scope) and second(scope)
    if node.kind == "or":
        first, second = args
        return lambda scope: first(scope) or second(scope)
    call = filters[node.kind[1:]] if node.kind[0] == "|" else _OPERATIONS[node.kind]
    if len(args) == 1:
        (only,) = args
        return lambda scope: call(only(scope))
    if len(args) == 2:
        first, second = args
        return lambda scope: call(first(scope), second(scope))
    return lambda scope: call(*[a(scope) for a in args])


#: What a rendering yields besides ``(text, learned)``: an item of the outermost loop has ended.
TURN = None
Piece = tuple[str, bool]
_Run = Callable[[dict, bool], Iterator["Piece | None"]]


def _with_last(items: Iterable) -> Iterator[tuple[Any, bool]]:
    it = iter(items)
    for now in it:
        for then in it:
            yield now, False
            now = then
        yield now, True


def _body(nodes: tuple, filters: dict, depth: int) -> _Run:
    runs = [_node(n, filters, depth) for n in nodes]
    if len(runs) == 1:
        return runs[0]

    def run(scope: dict, learned: bool) -> Iterator[Piece | None]:
        for step in runs:
            yield from step(scope, learned)

    return run


def _node(node, filters: dict, depth: int) -> _Run:
    """A closure that yields the pieces of a node's output."""
    if isinstance(node, Text):
        text = node.value

        def run(scope, learned):
            yield text, learned

    elif isinstance(node, Output):
        value = _value(node.value, filters)

        def run(scope, learned):
            yield printed(value(scope)), learned

    elif isinstance(node, Set):
        name, value = node.name, _value(node.value, filters)

        def run(scope, learned):
            scope[name] = value(scope)
            return
            yield

    elif isinstance(node, Generation):
        inner = _body(node.body, filters, depth)

        def run(scope, learned):
            yield from inner(scope, True)

    elif isinstance(node, If):
        branches = [(_value(c, filters), _body(b, filters, depth)) for c, b in node.branches]

        def run(scope, learned):
            for condition, body in branches:
                if condition(scope):
                    yield from body(scope, learned)
                    return

    else:
        name, items, body = node.name, _value(node.items, filters), _body(node.body, filters, depth + 1)

        def run(scope, learned):
            of = items(scope)
            if of is UNDEFINED or of is None or isinstance(of, str | int):
                return
            for index, (item, last) in enumerate(_with_last(of), 1):
                loop = {"index": index, "index0": index - 1, "first": index == 1, "last": last}
                yield from body({**scope, name: item, "loop": loop}, learned)
                if not depth:
                    yield TURN

    return run


@dataclass
class Template:
    """A compiled template; ``filters`` are added to the built-in ones."""

    source: str
    filters: dict[str, Callable] = field(default_factory=dict)

    def __post_init__(self) -> None:
        every = FILTERS | self.filters
        self.tree = fold(parse(self.source, every), every)
        self._run = _body(self.tree, every, 0)

    def pieces(self, **values: Any) -> Iterator[Piece | None]:
        """``(text, learned)`` pieces one by one, and ``TURN`` after each item of an outermost loop.

        A list that a loop runs over may be any iterable: it is read one item ahead.
        """
        return self._run(dict(values), False)

    def render(self, **values: Any) -> tuple[str, list[tuple[int, int]]]:
        """The text and the spans of generated output, in code points."""
        return joined(self.pieces(**values))


def joined(pieces: Iterable[Piece | None]) -> tuple[str, list[tuple[int, int]]]:
    """Pieces as one text with its spans of generated output (neighbouring ones as one)."""
    texts, spans, at = [], [], 0
    for piece in pieces:
        if piece is TURN:
            continue
        text, learned = piece
        if learned and text:
            if spans and spans[-1][1] == at:
                spans[-1] = (spans[-1][0], at + len(text))
            else:
                spans.append((at, at + len(text)))
        texts.append(text)
        at += len(text)
    return "".join(texts), spans
