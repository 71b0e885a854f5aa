"""A small template language for conversations, compiled to Python closures.

    template  := (text | "{{" value "}}" | statement)*
    statement := "{% for" name "in" value "%}" template "{% endfor %}"
               | "{% if" value "%}" template ("{% elif" value "%}" template)* ["{% else %}" template] "{% endif %}"
               | "{% set" name "=" value "%}"
               | "{% generation %}" template "{% endgeneration %}"
    value     := "or", "and", "not", "==", "!=", "in", "not in", "+", "~", "|" filter, "." key, "[" value "]",
                 strings, whole numbers, true, false, none, names and parentheses

It is a sandbox: a template reads the names it is given, the keys of mappings and the
items of lists; it can call nothing but the filters below, and reach no attribute of any
Python object. Loops run over given lists only, so every template ends.

Control strings are what gives the output its structure. Constant text of a template may
hold them; whatever comes from data is escaped, so it never does. The escape is
reversible: a backslash is doubled, and one is put behind the first character wherever a
control string begins.

``compile_template`` parses to a syntax tree, folds constants, joins neighbouring constant
text, and makes one closure per node. Closures yield (text, generated) bit by bit, so a
conversation of any length is rendered message by message.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field, replace
from typing import Any

# --- syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    owner: Any
    key: Any


@dataclass(frozen=True)
class Unary:
    sign: str
    inner: Any


@dataclass(frozen=True)
class Binary:
    sign: str
    left: Any
    right: Any


@dataclass(frozen=True)
class Filter:
    name: str
    inner: Any


@dataclass(frozen=True)
class Text:
    """Constant output."""

    text: str


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    branches: tuple  # (condition, body); the condition of else is a true constant


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: tuple


class TemplateError(ValueError):
    """A template that the language does not allow, or a value it cannot work on."""


# --- parser

_PART = re.compile(r"\{%-?.*?-?%\}|\{\{-?.*?-?\}\}|\{#.*?#\}", re.S)
_TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[|.()\[\]+~=]))", re.S)
_ESCAPED = {"n": "\n", "t": "\t", "r": "\r"}
_WORDS = {"and", "or", "not", "in", "true", "false", "none"}
_CONSTANTS = {"true": True, "false": False, "none": None}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.rstrip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        kind = ("string", "number", "name", "sign")[m.lastindex - 1]
        out.append((kind, m[m.lastindex]))
        at = m.end()
    return out


class _Value:
    """Recursive descent over the tokens of one tag."""

    def __init__(self, source: str):
        self.tokens, self.at = _tokens(source), 0

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *wanted: str) -> bool:
        if self.peek()[0] in ("name", "sign") and self.peek()[1] in wanted:
            self.at += 1
            return True
        return False

    def need(self, wanted: str) -> None:
        if not self.take(wanted):
            raise TemplateError(f"expected {wanted!r}, found {self.peek()[1]!r}")

    def name(self) -> str:
        kind, text = self.peek()
        if kind != "name" or text in _WORDS:
            raise TemplateError(f"expected a name, found {text!r}")
        self.at += 1
        return text

    def end(self) -> None:
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.peek()[1]!r}")

    def any_of(self) -> Any:
        left = self.all_of()
        while self.take("or"):
            left = Binary("or", left, self.all_of())
        return left

    def all_of(self) -> Any:
        left = self.negated()
        while self.take("and"):
            left = Binary("and", left, self.negated())
        return left

    def negated(self) -> Any:
        return Unary("not", self.negated()) if self.take("not") else self.compared()

    def compared(self) -> Any:
        left = self.added()
        for sign in ("==", "!=", "in"):
            if self.take(sign):
                return Binary(sign, left, self.added())
        if self.peek()[1] == "not" and self.tokens[self.at + 1 : self.at + 2] == [("name", "in")]:
            self.at += 2
            return Unary("not", Binary("in", left, self.added()))
        return left

    def added(self) -> Any:
        left = self.filtered()
        while self.peek()[1] in ("+", "~") and self.peek()[0] == "sign":
            sign = self.peek()[1]
            self.at += 1
            left = Binary(sign, left, self.filtered())
        return left

    def filtered(self) -> Any:
        inner = self.primary()
        while True:
            if self.take("."):
                inner = Item(inner, Const(self.name()))
            elif self.take("["):
                key = self.any_of()
                self.need("]")
                inner = Item(inner, key)
            elif self.take("|"):
                name = self.name()
                if name not in FILTERS:
                    raise TemplateError(f"no filter {name!r}")
                inner = Filter(name, inner)
            else:
                return inner

    def primary(self) -> Any:
        kind, text = self.peek()
        self.at += 1
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPED.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "number":
            return Const(int(text))
        if kind == "name" and text in _CONSTANTS:
            return Const(_CONSTANTS[text])
        if kind == "name" and text not in _WORDS:
            return Name(text)
        if (kind, text) == ("sign", "("):
            inner = self.any_of()
            self.need(")")
            return inner
        raise TemplateError(f"unexpected {text or 'end of tag'!r}")


def _split(source: str) -> list[tuple[str, str]]:
    """(kind, content) of text, values and statements; a dash at a tag's side trims white space there."""
    out, at, trim = [], 0, False
    for m in _PART.finditer(source):
        text = source[at : m.start()]
        tag = m[0]
        if trim:
            text = text.lstrip()
        if tag[2] == "-":
            text = text.rstrip()
        out.append(("text", text))
        trim = tag[-3] == "-"
        if tag[1] != "#":
            out.append(("value" if tag[1] == "{" else "statement", tag[2:-2].strip("-")))
        at = m.end()
    out.append(("text", source[at:].lstrip() if trim else source[at:]))
    return [x for x in out if x != ("text", "")]


class _Parser:
    def __init__(self, source: str):
        self.parts, self.at, self.inside = _split(source), 0, False

    def body(self, *ends: str) -> tuple[tuple, _Value | None, str]:
        """Nodes up to a statement named in ``ends``, which is read."""
        out = []
        while self.at < len(self.parts):
            kind, content = self.parts[self.at]
            self.at += 1
            if kind == "text":
                out.append(Text(content))
                continue
            tag = _Value(content)
            if kind == "value":
                out.append(Output(tag.any_of()))
                tag.end()
                continue
            word = tag.name() if tag.peek()[1] not in _WORDS else ""
            if word in ends:
                return tuple(out), tag, word
            out.append(self.statement(word, tag))
        if ends:
            raise TemplateError(f"expected {' or '.join(ends)}")
        return tuple(out), None, ""

    def statement(self, word: str, tag: _Value) -> Any:
        if word == "for":
            name = tag.name()
            tag.need("in")
            over = tag.any_of()
            tag.end()
            body, last, _ = self.body("endfor")
            last.end()
            return For(name, over, body)
        if word == "if":
            branches, condition = [], tag.any_of()
            tag.end()
            while True:
                body, tag, word = self.body("elif", "else", "endif")
                branches.append((condition, body))
                if word == "elif":
                    condition = tag.any_of()
                tag.end()
                if word == "endif":
                    return If(tuple(branches))
                if word == "else":
                    body, tag, _ = self.body("endif")
                    tag.end()
                    return If((*branches, (Const(True), body)))
        if word == "set":
            name = tag.name()
            tag.need("=")
            made = Set(name, tag.any_of())
            tag.end()
            return made
        if word == "generation":
            if self.inside:
                raise TemplateError("generation inside generation")
            self.inside = True
            tag.end()
            body, last, _ = self.body("endgeneration")
            last.end()
            self.inside = False
            return Generation(body)
        raise TemplateError(f"no statement {word!r}")


def parse(source: str) -> tuple:
    """The nodes of a template."""
    return _Parser(source).body()[0]


# --- values


def _text(value: Any) -> str:
    if value is None:
        return ""
    if isinstance(value, str):
        return value
    if isinstance(value, (bool, int)):
        return str(value).lower()
    raise TemplateError(f"{type(value).__name__} is no text")


FILTERS: dict[str, Callable[[Any], Any]] = {
    "trim": lambda v: _text(v).strip(),
    "upper": lambda v: _text(v).upper(),
    "lower": lambda v: _text(v).lower(),
    "length": lambda v: len(v) if isinstance(v, (str, list, tuple, dict)) else len(_text(v)),
}


def _add(a: Any, b: Any) -> Any:
    if type(a) is type(b) and isinstance(a, (str, int)):
        return a + b
    raise TemplateError("only two texts or two numbers can be added")


def _within(a: Any, b: Any) -> bool:
    if isinstance(b, (str, list, tuple, dict)) and not (isinstance(b, str) and not isinstance(a, str)):
        return a in b
    raise TemplateError("in needs a text, list or mapping")


SIGNS: dict[str, Callable[[Any, Any], Any]] = {
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
    "in": _within,
    "+": _add,
    "~": lambda a, b: _text(a) + _text(b),
}


def item_of(owner: Any, key: Any) -> Any:
    """The value of a key, or an item of a list; None where there is none."""
    if isinstance(owner, dict):
        return owner.get(key) if isinstance(key, (str, int)) else None
    if isinstance(owner, (list, tuple)) and isinstance(key, int) and -len(owner) <= key < len(owner):
        return owner[key]
    return None


# --- constant folding


def fold(node: Any) -> Any:
    """The node with every part computed that no data can change."""
    if isinstance(node, tuple):
        return _joined([fold(n) for n in node])
    if isinstance(node, Item):
        return _constant(Item(fold(node.owner), fold(node.key)), ("owner", "key"))
    if isinstance(node, Filter):
        return _constant(replace(node, inner=fold(node.inner)), ("inner",))
    if isinstance(node, Unary):
        return _constant(replace(node, inner=fold(node.inner)), ("inner",))
    if isinstance(node, Binary):
        left, right = fold(node.left), fold(node.right)
        if node.sign in ("and", "or") and isinstance(left, Const):
            return right if bool(left.value) == (node.sign == "and") else left
        return _constant(Binary(node.sign, left, right), ("left", "right"))
    if isinstance(node, Output):
        value = fold(node.value)
        return Text(_text(value.value)) if isinstance(value, Const) else Output(value)
    if isinstance(node, Set):
        return replace(node, value=fold(node.value))
    if isinstance(node, For):
        return replace(node, over=fold(node.over), body=fold(node.body))
    if isinstance(node, Generation):
        return Generation(fold(node.body))
    if isinstance(node, If):
        branches = []
        for condition, body in node.branches:
            condition = fold(condition)
            if isinstance(condition, Const) and not condition.value:
                continue
            branches.append((condition, fold(body)))
            if isinstance(condition, Const):
                break
        if branches and isinstance(branches[0][0], Const):
            return branches[0][1]
        return If(tuple(branches))
    return node


def _constant(node: Any, parts: tuple[str, ...]) -> Any:
    if all(isinstance(getattr(node, p), Const) for p in parts):
        return Const(_value(node)({}))
    return node


def _joined(nodes: list[Any]) -> tuple:
    out: list[Any] = []
    for node in nodes:
        for n in node if isinstance(node, tuple) else (node,):
            if isinstance(n, Text) and out and isinstance(out[-1], Text):
                out[-1] = Text(out[-1].text + n.text)
            elif n != Text("") and n != If(()):
                out.append(n)
    return tuple(out)


# --- closures

Scope = dict[str, Any]


def _value(node: Any) -> Callable[[Scope], Any]:
    """A closure that computes a value."""
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):
        return lambda scope, name=node.name: scope.get(name)
    if isinstance(node, Item):
        owner, key = _value(node.owner), _value(node.key)
        return lambda scope: item_of(owner(scope), key(scope))
    if isinstance(node, Filter):
        inner, made = _value(node.inner), FILTERS[node.name]
        return lambda scope: made(inner(scope))
    if isinstance(node, Unary):
        inner = _value(node.inner)
        return lambda scope: not inner(scope)
    left, right = _value(node.left), _value(node.right)
    if node.sign == "and":
        return lambda scope: left(scope) and right(scope)
    if node.sign == "or":
        return lambda scope: left(scope) or right(scope)
    made = SIGNS[node.sign]
    return lambda scope: made(left(scope), right(scope))


Render = Callable[[Scope, bool], Iterator[tuple[str, bool]]]


def _nodes(nodes: tuple, escape: Callable[[str], str]) -> Render:
    """A closure that yields what the nodes say, and whether it is generated."""
    made = [_node(n, escape) for n in nodes]

    def run(scope: Scope, generated: bool) -> Iterator[tuple[str, bool]]:
        for render in made:
            yield from render(scope, generated)

    return run


def _node(node: Any, escape: Callable[[str], str]) -> Render:
    if isinstance(node, Text):
        return lambda scope, generated, text=node.text: iter([(text, generated)])
    if isinstance(node, Output):
        value = _value(node.value)
        return lambda scope, generated: iter([(escape(_text(value(scope))), generated)])
    if isinstance(node, Generation):
        body = _nodes(node.body, escape)
        return lambda scope, generated: body(scope, True)
    if isinstance(node, Set):
        value = _value(node.value)

        def put(scope: Scope, generated: bool) -> Iterator[tuple[str, bool]]:
            scope[node.name] = value(scope)
            return iter(())

        return put
    if isinstance(node, If):
        branches = [(_value(c), _nodes(b, escape)) for c, b in node.branches]

        def choose(scope: Scope, generated: bool) -> Iterator[tuple[str, bool]]:
            for condition, body in branches:
                if condition(scope):
                    return body(scope, generated)
            return iter(())

        return choose
    over, body = _value(node.over), _nodes(node.body, escape)

    def loop(scope: Scope, generated: bool) -> Iterator[tuple[str, bool]]:
        items = over(scope)
        if isinstance(items, (str, dict)) or not isinstance(items, Iterable):
            raise TemplateError("for needs a list")
        inner, items = dict(scope), iter(items)
        ahead, i = next(items, loop), 0
        while ahead is not loop:
            item, ahead = ahead, next(items, loop)
            inner[node.name] = item
            inner["loop"] = {"index0": i, "index": i + 1, "first": i == 0, "last": ahead is loop}
            yield from body(inner, generated)
            i += 1

    return loop


# --- control strings


def _check_controls(controls: tuple[str, ...]) -> None:
    for c in controls:
        if len(c) < 2 or "\\" in c:
            raise TemplateError(f"{c!r} cannot be escaped")
        for other in controls:
            # a text that ends within one control string must not complete it with the next
            if any(other.startswith(c[i:]) or c[i:].startswith(other) for i in range(1, len(c))):
                raise TemplateError(f"{c!r} and {other!r} overlap")


@dataclass
class Template:
    """A compiled template: its tree, its control strings and the closure that renders it."""

    source: str
    controls: tuple[str, ...]
    tree: tuple = field(init=False)
    render: Render = field(init=False)

    def __post_init__(self):
        _check_controls(self.controls)
        self._begin = re.compile("|".join(f"(?<={re.escape(c[0])})(?={re.escape(c[1:])})" for c in self.controls))
        self._any = re.compile("|".join(re.escape(c) for c in sorted(self.controls, key=len, reverse=True)))
        self.tree = fold(parse(self.source))
        self.render = _nodes(self.tree, self.escape)

    def escape(self, text: str) -> str:
        """The text without control strings in it."""
        if "\\" in text:
            text = text.replace("\\", "\\\\")
        return self._begin.sub("\\\\", text) if self.controls and self._any.search(text) else text

    @staticmethod
    def unescape(text: str) -> str:
        """What ``escape`` was given."""
        if "\\" not in text:
            return text
        return re.sub(r"\\(\\?)", r"\1", text)

    def stream(self, **names: Any) -> Iterator[tuple[str, bool]]:
        """Bits of the output, and whether each is generated; lists may be iterators."""
        return self.render(dict(names), False)

    def controls_in(self, text: str) -> Iterator[re.Match]:
        return self._any.finditer(text)


def compile_template(source: str, controls: Iterable[str]) -> Template:
    return Template(source, tuple(controls))
