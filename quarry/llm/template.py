"""A sandboxed template language compiled to Python closures (operator 1).

    text                          literal text
    {# ... #}                     comment
    {{ expression }}              value; null gives nothing
    {% for x in expr %} ... {% endfor %}     loop.index, loop.first, loop.last
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% set x = expr %}
    {% generation %} ... {% endgeneration %}  what a model is trained on

Expressions: strings, integers, true, false, none; names; fields (``a.b``,
mapping keys only); ``a | filter(args)``; ``~`` (joins text), ``+``, ``-``, ``*``,
``==``, ``!=``, ``<``, ``<=``, ``>``, ``>=``, ``in``, ``and``, ``or``, ``not``.
A template reaches nothing but the values it is given: there are no calls, no
Python attributes and no imports.

``compile_template`` parses to a syntax tree, folds constant expressions, branches
with constant tests and neighbouring literals, and turns each node into a closure
that yields text pieces and the markers BEGIN and END of generated text. Loops
take any iterable and read one item ahead, so output can be streamed.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

BEGIN, END = object(), object()


class TemplateError(ValueError):
    pass


# Syntax tree


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: object
    name: str


@dataclass(frozen=True)
class Call:
    """An operator or filter applied to expressions."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Text:
    text: str


@dataclass(frozen=True)
class Emit:
    expr: object


@dataclass(frozen=True)
class Assign:
    name: str
    expr: object


@dataclass(frozen=True)
class If:
    test: object
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# Filters and operators


def _text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


#: Strings that mean something in formatted conversations.
CONTROL = ("###", "</turn>")
ESCAPE = "\\"


def escape(value: object, *more: str) -> str:
    """Puts a backslash before every backslash, control string and string of ``more``."""
    text = _text(value).replace(ESCAPE, ESCAPE * 2)
    for control in (*CONTROL, *more):
        text = text.replace(control, ESCAPE + control)
    return text


def unescape(text: str) -> str:
    """The inverse of ``escape``: a backslash stands for the character after it."""
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL) if ESCAPE in text else text


FILTERS: dict[str, Callable] = {
    "escape": escape,
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "trim": lambda v: _text(v).strip(),
    "length": lambda v: len(v) if v is not None else 0,
    "default": lambda v, other: other if v is None else v,
    "replace": lambda v, old, new: _text(v).replace(old, new),
}
OPERATORS: dict[str, Callable] = {
    "~": lambda a, b: _text(a) + _text(b),
    "+": operator.add,
    "-": operator.sub,
    "*": operator.mul,
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "in": lambda a, b: a in b,
    "not": operator.not_,
}

# Parsing

_BLOCK = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}|\{#.*?#\}", re.DOTALL)
_TOKEN = re.compile(r"""\s*(?:(\d+)|('(?:\\.|[^'\\])*'|"(?:\\.|[^"\\])*")|([A-Za-z]\w*)|(==|!=|<=|>=|[<>+\-*~|.(),=]))""")
_LITERAL_ESCAPES = {"n": "\n", "t": "\t"}
_LEVELS = (("==", "!=", "<", "<=", ">", ">=", "in"), ("~", "+", "-"), ("*",))


class _Expressions:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, object]] = []
        at, source = 0, source.strip()
        while at < len(source):
            m = _TOKEN.match(source, at)
            if not m:
                raise TemplateError(f"unexpected {source[at:at + 20]!r}")
            number, string, name, sign = m.groups()
            if number:
                self.tokens.append(("const", int(number)))
            elif string:
                inner = re.sub(r"\\(.)", lambda x: _LITERAL_ESCAPES.get(x[1], x[1]), string[1:-1], flags=re.DOTALL)
                self.tokens.append(("const", inner))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
            at = m.end()
        self.at = 0

    def peek(self) -> object:
        kind, value = self.tokens[self.at] if self.at < len(self.tokens) else ("end", None)
        return value if kind in ("name", "sign") else None

    def take(self, *wanted: str) -> str | None:
        if self.peek() in wanted and wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"expected {wanted!r}")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("expected a name")

    def whole(self) -> object:
        found = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return found

    def either(self) -> object:
        left = self.both()
        while self.take("or"):
            left = Call("or", (left, self.both()))
        return left

    def both(self) -> object:
        left = self.negated()
        while self.take("and"):
            left = Call("and", (left, self.negated()))
        return left

    def negated(self) -> object:
        return Call("not", (self.negated(),)) if self.take("not") else self.level(0)

    def level(self, k: int) -> object:
        if k == len(_LEVELS):
            return self.filtered()
        left = self.level(k + 1)
        while sign := self.take(*_LEVELS[k]):
            left = Call(sign, (left, self.level(k + 1)))
        return left

    def filtered(self) -> object:
        value = self.primary()
        while self.take("|"):
            name, args = self.name(), [value]
            if name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            if self.take("("):
                while not self.take(")"):
                    args.append(self.either())
                    if self.peek() != ")":
                        self.need(",")
            value = Call(name, tuple(args))
        return value

    def primary(self) -> object:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression ends too early")
        kind, value = self.tokens[self.at]
        self.at += 1
        if kind == "const":
            return Const(value)
        if value == "(":
            inner = self.either()
            self.need(")")
            return inner
        if kind != "name":
            raise TemplateError(f"unexpected {value!r}")
        if value in ("true", "false", "none"):
            return Const({"true": True, "false": False, "none": None}[value])
        found: object = Name(value)
        while self.take("."):
            found = Field(found, self.name())
        return found


def parse(source: str) -> tuple:
    """The syntax tree of a template: a tuple of nodes."""
    items: list[tuple[str, str]] = []
    at = 0
    for m in _BLOCK.finditer(source):
        items.append(("text", source[at : m.start()]))
        if m[1] is not None:
            items.append(("emit", m[1]))
        elif m[2] is not None:
            items.append(("tag", m[2].strip()))
        at = m.end()
    items.append(("text", source[at:]))
    items.reverse()

    def body(*ends: str) -> tuple[tuple, str]:
        nodes: list = []
        while items:
            kind, value = items.pop()
            word = value.split(None, 1)[0] if kind == "tag" and value else ""
            if kind == "text":
                nodes.append(Text(value))
            elif kind == "emit":
                nodes.append(Emit(_Expressions(value).whole()))
            elif word in ends:
                return tuple(nodes), value
            else:
                nodes.append(tag(word, value))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return tuple(nodes), ""

    def tag(word: str, value: str) -> object:
        inner = _Expressions(value)
        if word == "generation":
            return Generation(body("endgeneration")[0])
        if word == "set":
            inner.need("set")
            name = inner.name()
            inner.need("=")
            return Assign(name, inner.whole())
        if word == "for":
            inner.need("for")
            name = inner.name()
            inner.need("in")
            return For(name, inner.whole(), body("endfor")[0])
        if word == "if":
            return branch(value[2:])
        raise TemplateError(f"unknown tag {value!r}")

    def branch(test: str) -> If:
        then, end = body("elif", "else", "endif")
        other: tuple = ()
        if end.startswith("elif"):
            other = (branch(end[4:]),)
        elif end == "else":
            other, _ = body("endif")
        return If(_Expressions(test).whole(), then, other)

    return body()[0]


# Constant folding


def fold_expr(e: object) -> object:
    if isinstance(e, Field):
        return Field(fold_expr(e.of), e.name)
    if not isinstance(e, Call):
        return e
    args = tuple(map(fold_expr, e.args))
    if e.name in ("and", "or") and isinstance(args[0], Const):
        return args[1] if bool(args[0].value) == (e.name == "and") else args[0]
    folded = Call(e.name, args)
    if all(isinstance(a, Const) for a in args):
        return Const(_expression(folded)({}))
    return folded


def fold(nodes: Iterable) -> tuple:
    """The same template with constant parts computed and neighbouring text joined."""
    done: list = []
    for node in nodes:
        parts: tuple = (node,)
        if isinstance(node, Emit):
            e = fold_expr(node.expr)
            parts = (Text(_text(e.value)),) if isinstance(e, Const) else (Emit(e),)
        elif isinstance(node, Assign):
            parts = (Assign(node.name, fold_expr(node.expr)),)
        elif isinstance(node, If):
            test, then, other = fold_expr(node.test), fold(node.then), fold(node.other)
            parts = (If(test, then, other),)
            if isinstance(test, Const):
                parts = then if test.value else other
        elif isinstance(node, For):
            parts = (For(node.name, fold_expr(node.over), fold(node.body)),)
        elif isinstance(node, Generation):
            parts = (Generation(fold(node.body)),)
        for p in parts:
            if isinstance(p, Text) and done and isinstance(done[-1], Text):
                done[-1] = Text(done[-1].text + p.text)
            elif p != Text(""):
                done.append(p)
    return tuple(done)


# Closures

Render = Callable[[dict], Iterator]


def _expression(e: object) -> Callable[[dict], object]:
    if isinstance(e, Const):
        return lambda scope, v=e.value: v
    if isinstance(e, Name):
        return lambda scope, n=e.name: scope.get(n)
    if isinstance(e, Field):

        def field(scope: dict, of=_expression(e.of), n=e.name) -> object:
            value = of(scope)
            return value.get(n) if isinstance(value, dict) else None

        return field
    args = [_expression(a) for a in e.args]
    if e.name == "and":
        return lambda scope: args[0](scope) and args[1](scope)
    if e.name == "or":
        return lambda scope: args[0](scope) or args[1](scope)
    fn = OPERATORS.get(e.name) or FILTERS[e.name]
    return lambda scope: fn(*[a(scope) for a in args])


def _loop(node: For) -> Render:
    over, body, name = _expression(node.over), _body(node.body), node.name

    def run(scope: dict) -> Iterator:
        items = iter(over(scope) or ())
        nothing = object()
        item, k = next(items, nothing), 0
        while item is not nothing:
            ahead, k = next(items, nothing), k + 1
            loop = {"index": k, "first": k == 1, "last": ahead is nothing}
            yield from body({**scope, name: item, "loop": loop})
            item = ahead

    return run


def _node(node: object) -> Render:
    if isinstance(node, Text):
        return lambda scope, t=node.text: iter((t,))
    if isinstance(node, Emit):
        return lambda scope, f=_expression(node.expr): iter((_text(f(scope)),))
    if isinstance(node, Assign):
        value = _expression(node.expr)

        def assign(scope: dict) -> Iterator:
            scope[node.name] = value(scope)
            return iter(())

        return assign
    if isinstance(node, If):
        test, then, other = _expression(node.test), _body(node.then), _body(node.other)
        return lambda scope: then(scope) if test(scope) else other(scope)
    if isinstance(node, For):
        return _loop(node)
    inner = _body(node.body)

    def generation(scope: dict) -> Iterator:
        yield BEGIN
        yield from inner(scope)
        yield END

    return generation


def _body(nodes: tuple) -> Render:
    steps = [_node(n) for n in nodes]

    def run(scope: dict) -> Iterator:
        for step in steps:
            yield from step(scope)

    return run


def compile_template(source: str) -> Callable[..., Iterator]:
    """A function of the template's variables that yields text, BEGIN and END."""
    run = _body(fold(parse(source)))
    return lambda **variables: run(dict(variables))


def render(source: str, **variables: object) -> tuple[str, list[tuple[int, int]]]:
    """The whole text and its generated spans, for small inputs."""
    out, spans, n = [], [], 0
    for piece in compile_template(source)(**variables):
        if piece is BEGIN:
            spans.append((n, n))
        elif piece is END:
            spans[-1] = (spans[-1][0], n)
        else:
            out.append(piece)
            n += len(piece)
    return "".join(out), spans
