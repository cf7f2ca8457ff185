"""A small sandboxed template language, compiled to Python closures.

    {{ expr }}  {% if e %} {% elif e %} {% else %} {% endif %}
    {% for x in e %} {% endfor %}  {% set x = e %}
    {% generation %} {% endgeneration %}

A minus inside a tag strips white space on its side. Expressions: literals,
names, `.key`, `[index]`, `|filter(args)`, `a if c else b`, or / and / not,
comparisons, `in`, + - * % and ~ (joins as text). Names and keys reach data
only: `.key` looks into mappings, never at Python attributes, and there are no
calls but the filters given. `loop` has index, index0, first and last.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any


class TemplateError(ValueError):
    """The template is not well formed, or asks for what the sandbox has not."""


# -- syntax tree ---------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: Any
    key: Any


@dataclass(frozen=True)
class Op:
    """Operator or filter over operands."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Choice:
    """`a if c else b`, and, or: operands are evaluated as needed."""

    kind: str
    args: tuple


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class If:
    arms: tuple  # of (condition, body)


@dataclass(frozen=True)
class For:
    name: str
    items: Any
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


def _text(value: Any) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


OPERATORS: dict[str, Callable] = {
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "in": lambda a, b: a in b, "not in": lambda a, b: a not in b, "+": operator.add, "-": operator.sub,
    "*": operator.mul, "%": operator.mod, "~": lambda a, b: _text(a) + _text(b), "not": operator.not_, "neg": operator.neg,
}

FILTERS: dict[str, Callable] = {
    "trim": lambda x: _text(x).strip(),
    "upper": lambda x: _text(x).upper(),
    "lower": lambda x: _text(x).lower(),
    "length": len,
    "default": lambda x, y: y if x is None else x,
}

# -- lexer and parser ----------------------------------------------------------

_TAG = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|(\d+)|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+*%~<>().,\[\]|=]))""")
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _tokens(source: str) -> list[tuple[str, Any]]:
    out, at, source = [], 0, source.rstrip()
    while at < len(source):
        found = _TOKEN.match(source, at)
        if not found:
            raise TemplateError(f"cannot read {source[at:]!r}")
        at = found.end()
        if found[1] is not None:
            out.append(("const", re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), found[1][1:-1], flags=re.DOTALL)))
        elif found[2] is not None:
            out.append(("const", int(found[2])))
        elif found[3] is not None:
            out.append(("name", found[3]))
        else:
            out.append(("sign", found[4]))
    return out


class _Expression:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str, filters: Mapping[str, Callable]):
        self.tokens, self.at, self.filters, self.source = _tokens(source), 0, filters, source

    def peek(self, *values: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in values

    def take(self, *values: str) -> str | None:
        if self.peek(*values):
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, value: str) -> None:
        if not self.take(value):
            raise TemplateError(f"{value!r} expected in {self.source!r}")

    def identifier(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError(f"a name expected in {self.source!r}")

    def whole(self):
        node = self.choice()
        if self.at != len(self.tokens):
            raise TemplateError(f"unexpected rest in {self.source!r}")
        return node

    def choice(self):
        node = self.either()
        if self.take("if"):
            condition = self.either()
            other = self.choice() if self.take("else") else Const(None)
            return Choice("if", (condition, node, other))
        return node

    def either(self):
        node = self.both()
        while self.take("or"):
            node = Choice("or", (node, self.both()))
        return node

    def both(self):
        node = self.negation()
        while self.take("and"):
            node = Choice("and", (node, self.negation()))
        return node

    def negation(self):
        return Op("not", (self.negation(),)) if self.take("not") else self.comparison()

    def comparison(self):
        node = self.sum()
        while sign := self.take("==", "!=", "<", "<=", ">", ">=", "in", "not"):
            if sign == "not":
                self.need("in")
                sign = "not in"
            node = Op(sign, (node, self.sum()))
        return node

    def sum(self):
        node = self.product()
        while sign := self.take("+", "-", "~"):
            node = Op(sign, (node, self.product()))
        return node

    def product(self):
        node = self.unary()
        while sign := self.take("*", "%"):
            node = Op(sign, (node, self.unary()))
        return node

    def unary(self):
        return Op("neg", (self.unary(),)) if self.take("-") else self.postfix()

    def postfix(self):
        node = self.atom()
        while sign := self.take(".", "[", "|"):
            if sign == ".":
                node = Item(node, Const(self.identifier()))
            elif sign == "[":
                node = Item(node, self.choice())
                self.need("]")
            else:
                name, args = self.identifier(), [node]
                if name not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                if self.take("("):
                    while not self.take(")"):
                        args.append(self.choice())
                        self.take(",")
                node = Op(f"|{name}", tuple(args))
        return node

    def atom(self):
        if self.at >= len(self.tokens):
            raise TemplateError(f"{self.source!r} ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "const":
            return Const(value)
        if kind == "name":
            fixed = {"true": True, "false": False, "none": None}
            return Const(fixed[value]) if value in fixed else Name(value)
        if value == "(":
            node = self.choice()
            self.need(")")
            return node
        raise TemplateError(f"unexpected {value!r} in {self.source!r}")


def parse(source: str, filters: Mapping[str, Callable]) -> tuple:
    """The syntax tree of a template."""
    pieces, at, strip = [], 0, False
    for found in _TAG.finditer(source):
        left, right = found[1] or found[4], found[3] or found[6]
        text = source[at : found.start()]
        text = text.lstrip() if strip else text
        pieces.append(("text", text.rstrip() if left else text))
        pieces.append(("out", found[2]) if found[2] is not None else ("tag", found[5].strip()))
        at, strip = found.end(), bool(right)
    pieces.append(("text", source[at:].lstrip() if strip else source[at:]))
    body, rest, end = _body(pieces, 0, filters)
    if end is not None:
        raise TemplateError(f"{end!r} without its beginning")
    return body


def _body(pieces: list, at: int, filters: Mapping[str, Callable]) -> tuple[tuple, int, str | None]:
    """Nodes up to an ending tag, which is returned with the place after it."""
    nodes: list = []

    def block(start: int, *ends: str) -> tuple[tuple, int, str]:
        inner, after, end = _body(pieces, start, filters)
        if end is None or end.split()[0] not in ends:
            raise TemplateError(f"{' or '.join(ends)} expected, not {end!r}")
        return inner, after, end

    while at < len(pieces):
        kind, value = pieces[at]
        at += 1
        if kind == "text":
            nodes.append(Output(Const(value)))
        elif kind == "out":
            nodes.append(Output(_Expression(value, filters).whole()))
        else:
            word, _, rest = value.partition(" ")
            if word == "if":
                arms, condition = [], _Expression(rest, filters).whole()
                while True:
                    inner, at, end = block(at, "elif", "else", "endif")
                    arms.append((condition, inner))
                    if end == "endif":
                        break
                    condition = Const(True) if end == "else" else _Expression(end.removeprefix("elif"), filters).whole()
                nodes.append(If(tuple(arms)))
            elif word == "for":
                reader = _Expression(rest, filters)
                name = reader.identifier()
                reader.need("in")
                items = reader.whole()
                inner, at, _ = block(at, "endfor")
                nodes.append(For(name, items, inner))
            elif word == "set":
                reader = _Expression(rest, filters)
                name = reader.identifier()
                reader.need("=")
                nodes.append(Set(name, reader.whole()))
            elif word == "generation":
                inner, at, _ = block(at, "endgeneration")
                nodes.append(Generation(inner))
            elif word in ("elif", "else", "endif", "endfor", "endgeneration"):
                return tuple(nodes), at, value
            else:
                raise TemplateError(f"no tag {word!r}")
    return tuple(nodes), at, None


# -- constant folding ----------------------------------------------------------


def fold(node: Any, filters: Mapping[str, Callable]) -> Any:
    """The expression with every constant part worked out."""
    if isinstance(node, Op):
        args = tuple(fold(a, filters) for a in node.args)
        if all(isinstance(a, Const) for a in args):
            return Const(_function(node.name, filters)(*(a.value for a in args)))
        return Op(node.name, args)
    if isinstance(node, Choice):
        args = tuple(fold(a, filters) for a in node.args)
        if isinstance(args[0], Const):
            truth = bool(args[0].value)
            return args[1 if truth else 2] if node.kind == "if" else args[1] if truth == (node.kind == "and") else args[0]
        return Choice(node.kind, args)
    if isinstance(node, Item):
        return Item(fold(node.of, filters), fold(node.key, filters))
    return node


def fold_body(body: tuple, filters: Mapping[str, Callable]) -> tuple:
    """The nodes with constants folded, dead arms gone and neighbouring texts joined."""
    out: list = []

    def put(node) -> None:
        if isinstance(node, Output) and isinstance(node.value, Const):
            text = _text(node.value.value)
            if out and isinstance(out[-1], Output) and isinstance(out[-1].value, Const):
                text = out.pop().value.value + text
            if text:
                out.append(Output(Const(text)))
        else:
            out.append(node)

    for node in body:
        if isinstance(node, Output):
            put(Output(fold(node.value, filters)))
        elif isinstance(node, Set):
            put(Set(node.name, fold(node.value, filters)))
        elif isinstance(node, For):
            put(For(node.name, fold(node.items, filters), fold_body(node.body, filters)))
        elif isinstance(node, Generation):
            put(Generation(fold_body(node.body, filters)))
        else:
            arms = []
            for condition, inner in node.arms:
                condition = fold(condition, filters)
                if isinstance(condition, Const) and not condition.value:
                    continue
                arms.append((condition, fold_body(inner, filters)))
                if isinstance(condition, Const):
                    break
            if arms and isinstance(arms[0][0], Const):
                for x in arms[0][1]:
                    put(x)
            elif arms:
                put(If(tuple(arms)))
    return tuple(out)


# -- closures ------------------------------------------------------------------


@dataclass
class Page:
    """What a rendering has written so far, and the spans of its generation blocks."""

    pieces: list[str] = field(default_factory=list)
    size: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)

    def put(self, text: str) -> None:
        self.pieces.append(text)
        self.size += len(text)


def _function(name: str, filters: Mapping[str, Callable]) -> Callable:
    return filters[name[1:]] if name[0] == "|" else OPERATORS[name]


def _lookup(of: Any, key: Any) -> Any:
    if isinstance(of, Mapping):
        return of.get(key)
    if isinstance(of, (list, tuple, str)) and isinstance(key, int):
        return of[key] if -len(of) <= key < len(of) else None
    return None


def _value(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict], Any]:
    if isinstance(node, Const):
        return lambda env, value=node.value: value
    if isinstance(node, Name):
        return lambda env, name=node.name: env.get(name)
    if isinstance(node, Item):
        of, key = _value(node.of, filters), _value(node.key, filters)
        return lambda env: _lookup(of(env), key(env))
    args = [_value(a, filters) for a in node.args]
    if isinstance(node, Choice):
        if node.kind == "if":
            return lambda env: args[1](env) if args[0](env) else args[2](env)
        if node.kind == "and":
            return lambda env: args[0](env) and args[1](env)
        return lambda env: args[0](env) or args[1](env)
    function = _function(node.name, filters)
    if len(args) == 1:
        return lambda env, one=args[0]: function(one(env))
    return lambda env: function(*(a(env) for a in args))


def _writer(node: Any, filters: Mapping[str, Callable]) -> Callable[[dict, Page], None]:
    if isinstance(node, Output):
        value = _value(node.value, filters)
        return lambda env, page: page.put(_text(value(env)))
    if isinstance(node, Set):
        value = _value(node.value, filters)
        return lambda env, page: env.__setitem__(node.name, value(env))
    if isinstance(node, Generation):
        body = _writers(node.body, filters)

        def generation(env: dict, page: Page) -> None:
            start = page.size
            body(env, page)
            page.spans.append((start, page.size))

        return generation
    if isinstance(node, If):
        arms = [(_value(c, filters), _writers(b, filters)) for c, b in node.arms]

        def choose(env: dict, page: Page) -> None:
            for condition, body in arms:
                if condition(env):
                    body(env, page)
                    return

        return choose
    items, body = _value(node.items, filters), _writers(node.body, filters)

    def repeat(env: dict, page: Page) -> None:
        values = items(env) or ()
        inner = dict(env)
        for i, value in enumerate(values):
            inner[node.name] = value
            inner["loop"] = {"index": i + 1, "index0": i, "first": i == 0, "last": i == len(values) - 1}
            body(inner, page)

    return repeat


def _writers(body: tuple, filters: Mapping[str, Callable]) -> Callable[[dict, Page], None]:
    steps = [_writer(node, filters) for node in body]

    def run(env: dict, page: Page) -> None:
        for step in steps:
            step(env, page)

    return run


def compile_template(source: str, filters: Mapping[str, Callable] | None = None) -> Callable[[Mapping], tuple[str, list[tuple[int, int]]]]:
    """A function from data to (text, spans of the generation blocks in code points)."""
    known = {**FILTERS, **(filters or {})}
    write = _writers(fold_body(parse(source, known), known), known)

    def render(data: Mapping) -> tuple[str, list[tuple[int, int]]]:
        page = Page()
        write(dict(data), page)
        return "".join(page.pieces), page.spans

    return render
