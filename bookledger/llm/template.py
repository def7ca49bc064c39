"""A small sandboxed template language, compiled to Python closures.

    {{ expression }}                  output
    {% for x in expression %} ... {% endfor %}     with loop.index0, loop.first, loop.last
    {% if expression %} ... {% elif expression %} ... {% else %} ... {% endif %}
    {% set x = expression %}
    {% generation %} ... {% endgeneration %}       output under the loss mask
    {# comment #}

Expressions have literals, names, ``a.b`` and ``a['b']`` on mappings, ``+`` ``~`` ``==`` ``!=`` ``<`` ``<=`` ``>``
``>=``, ``in``, ``and or not``, ``a if b else c`` and the filters given to ``compile_template``. There are
no calls, no attributes of Python objects and no loops but over what is passed in.
"""

from __future__ import annotations

import ast
import operator
import re
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass
from typing import Any

Scope = dict[str, Any]
Part = tuple[str, bool]
Filters = Mapping[str, Callable[[Any], Any]]


class TemplateError(ValueError):
    pass


# ---------------------------------------------------------------- syntax tree


@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    value: Any
    key: Any


@dataclass(frozen=True)
class Apply:
    """An operator or filter on its operands."""

    name: str
    operands: tuple


@dataclass(frozen=True)
class Choose:
    """``and``, ``or`` and conditional expressions evaluate what they need only."""

    test: Any
    yes: Any
    no: Any


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Block:
    body: tuple


@dataclass(frozen=True)
class If:
    test: Any
    yes: Block
    no: Block


@dataclass(frozen=True)
class For:
    name: str
    values: Any
    body: Block


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class Generation:
    body: Block


# ---------------------------------------------------------------- parser

PIECE = re.compile(r"\{\{(.*?)\}\}|\{%-?(.*?)-?%\}|\{#.*?#\}", re.S)
TOKEN = re.compile(r"\s*(?:(\d+)|('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|([A-Za-z]\w*)|(==|!=|<=|>=|[-+~<>()\[\].|]))", re.S)
WORDS = {"true": True, "false": False, "none": None}
RESERVED = {"and", "or", "not", "in", "if", "else", *WORDS}
COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge}
OPERATORS: dict[str, Callable] = {
    **COMPARE,
    "in": lambda a, b: a in b,
    "+": operator.add,
    "~": lambda a, b: _shown(a) + _shown(b),
    "not": operator.not_,
}


def _shown(value: Any) -> str:
    return "" if value is None else str(value)


class _Expression:
    """Recursive descent over one expression's tokens."""

    def __init__(self, text: str, filters: Filters) -> None:
        self.tokens, at, self.filters = [], 0, filters
        text = text.strip()
        while at < len(text):
            found = TOKEN.match(text, at)
            if not found:
                raise TemplateError(f"unexpected {text[at:]!r}")
            at = found.end()
            number, string, name, sign = found.groups()
            if number is not None:
                self.tokens.append(("const", int(number)))
            elif string is not None:
                self.tokens.append(("const", ast.literal_eval(string)))
            else:
                self.tokens.append(("name", name) if name else ("sign", sign))
        self.at = 0

    def peek(self, *wanted: str) -> bool:
        return self.at < len(self.tokens) and self.tokens[self.at][0] != "const" and self.tokens[self.at][1] in wanted

    def take(self, *wanted: str) -> Any:
        if self.at >= len(self.tokens) or wanted and not self.peek(*wanted):
            raise TemplateError(f"expected {' or '.join(wanted) or 'a value'}")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self) -> Any:
        value = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"unexpected {self.tokens[self.at][1]!r}")
        return value

    def choice(self) -> Any:
        value = self.either()
        if self.peek("if"):
            self.take("if")
            test = self.either()
            no = (self.take("else"), self.choice())[1] if self.peek("else") else Const(None)
            return Choose(test, value, no)
        return value

    def either(self) -> Any:
        value = self.both()
        while self.peek("or"):
            self.take("or")
            value = Choose(value, Const(True), Apply("not", (Apply("not", (self.both(),)),)))
        return value

    def both(self) -> Any:
        value = self.negation()
        while self.peek("and"):
            self.take("and")
            value = Choose(value, Apply("not", (Apply("not", (self.negation(),)),)), Const(False))
        return value

    def negation(self) -> Any:
        if self.peek("not"):
            self.take("not")
            return Apply("not", (self.negation(),))
        value = self.sum()
        if self.peek(*COMPARE, "in"):
            sign = self.take(*COMPARE, "in")
            return Apply(sign, (value, self.sum()))
        return value

    def sum(self) -> Any:
        value = self.suffixed()
        while self.peek("+", "~"):
            sign = self.take("+", "~")
            value = Apply(sign, (value, self.suffixed()))
        return value

    def suffixed(self) -> Any:
        value = self.atom()
        while self.peek(".", "[", "|"):
            sign = self.take(".", "[", "|")
            if sign == ".":
                value = Item(value, Const(self.name()))
            elif sign == "[":
                value = Item(value, self.choice())
                self.take("]")
            else:
                name = self.name()
                if name not in self.filters:
                    raise TemplateError(f"no filter {name}")
                value = Apply(f"|{name}", (value,))
        return value

    def name(self) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != "name":
            raise TemplateError("expected a name")
        return self.take()

    def atom(self) -> Any:
        if self.peek("("):
            self.take("(")
            value = self.choice()
            self.take(")")
            return value
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "const":
            return Const(self.take())
        name = self.name()
        if name in WORDS:
            return Const(WORDS[name])
        if name in RESERVED:
            raise TemplateError(f"unexpected {name}")
        return Name(name)


def parse(source: str, filters: Filters) -> Block:
    pieces, at = [], 0
    for found in PIECE.finditer(source):
        if found.start() > at:
            pieces.append(("text", source[at : found.start()]))
        if found[1] is not None:
            pieces.append(("output", found[1]))
        elif found[2] is not None:
            pieces.append(("tag", found[2].strip()))
        at = found.end()
    if at < len(source):
        pieces.append(("text", source[at:]))
    position = 0

    def expression(text: str) -> Any:
        return _Expression(text, filters).whole()

    def until(*ends: str) -> tuple[Block, str]:
        nonlocal position
        body = []
        while position < len(pieces):
            kind, text = pieces[position]
            position += 1
            if kind == "text":
                body.append(Output(Const(text)))
            elif kind == "output":
                body.append(Output(expression(text)))
            else:
                word, _, rest = text.partition(" ")
                if word in ends:
                    return Block(tuple(body)), text
                body.append(statement(word, rest))
        if ends:
            raise TemplateError(f"missing {' or '.join(ends)}")
        return Block(tuple(body)), ""

    def branches(test: str) -> If:
        yes, end = until("elif", "else", "endif")
        word, _, rest = end.partition(" ")
        if word == "elif":
            return If(expression(test), yes, Block((branches(rest),)))
        return If(expression(test), yes, until("endif")[0] if word == "else" else Block(()))

    def statement(word: str, rest: str) -> Any:
        if word == "if":
            return branches(rest)
        if word == "for" and (found := re.fullmatch(r"([A-Za-z]\w*) in (.+)", rest, re.S)):
            return For(found[1], expression(found[2]), until("endfor")[0])
        if word == "set" and (found := re.fullmatch(r"([A-Za-z]\w*)\s*=(?!=)(.+)", rest, re.S)):
            return Set(found[1], expression(found[2]))
        if word == "generation":
            return Generation(until("endgeneration")[0])
        raise TemplateError(f"unknown tag {word} {rest}")

    return until()[0]


# ---------------------------------------------------------------- folding


def fold(node: Any, filters: Filters) -> Any:
    """The same tree with constant parts computed, dead branches gone and neighbouring texts joined."""
    inner = lambda x: fold(x, filters)
    if isinstance(node, Apply):
        operands = tuple(map(inner, node.operands))
        if all(isinstance(x, Const) for x in operands):
            return Const(_function(node.name, filters)(*(x.value for x in operands)))
        return Apply(node.name, operands)
    if isinstance(node, Item):
        return Item(inner(node.value), inner(node.key))
    if isinstance(node, Choose | If):
        test = inner(node.test)
        if isinstance(test, Const):
            return inner(node.yes if test.value else node.no)
        return type(node)(test, inner(node.yes), inner(node.no))
    if isinstance(node, Output):
        value = inner(node.value)
        return Output(Const(_shown(value.value)) if isinstance(value, Const) else value)
    if isinstance(node, Block):
        body: list[Any] = []
        for part in map(inner, node.body):
            for one in part.body if isinstance(part, Block) else (part,):
                is_text = isinstance(one, Output) and isinstance(one.value, Const)
                if is_text and body and isinstance(body[-1], Output) and isinstance(body[-1].value, Const):
                    body[-1] = Output(Const(body[-1].value.value + one.value.value))
                elif not is_text or one.value.value:
                    body.append(one)
        return Block(tuple(body))
    if isinstance(node, For):
        return For(node.name, inner(node.values), inner(node.body))
    if isinstance(node, Set):
        return Set(node.name, inner(node.value))
    if isinstance(node, Generation):
        return Generation(inner(node.body))
    return node


def _function(name: str, filters: Filters) -> Callable:
    return filters[name[1:]] if name[0] == "|" else OPERATORS[name]


# ---------------------------------------------------------------- closures


def _value(node: Any, filters: Filters) -> Callable[[Scope], Any]:
    if isinstance(node, Const):
        constant = node.value
        return lambda scope: constant
    if isinstance(node, Name):
        name = node.name
        return lambda scope: scope.get(name)
    if isinstance(node, Item):
        of, key = _value(node.value, filters), _value(node.key, filters)

        def item(scope: Scope) -> Any:
            owner = of(scope)
            return owner.get(key(scope)) if isinstance(owner, Mapping) else None

        return item
    if isinstance(node, Choose):
        test, yes, no = (_value(x, filters) for x in (node.test, node.yes, node.no))
        return lambda scope: yes(scope) if test(scope) else no(scope)
    function, operands = _function(node.name, filters), [_value(x, filters) for x in node.operands]
    if len(operands) == 1:
        (only,) = operands
        return lambda scope: function(only(scope))
    left, right = operands
    return lambda scope: function(left(scope), right(scope))


def _render(node: Any, filters: Filters, loss: bool) -> Callable[[Scope], Iterator[Part]]:
    if isinstance(node, Output):
        value = _value(node.value, filters)

        def output(scope: Scope) -> Iterator[Part]:
            if text := _shown(value(scope)):
                yield text, loss

        return output
    if isinstance(node, Block):
        parts = [_render(x, filters, loss) for x in node.body]

        def block(scope: Scope) -> Iterator[Part]:
            for part in parts:
                yield from part(scope)

        return block
    if isinstance(node, If):
        test, yes, no = _value(node.test, filters), _render(node.yes, filters, loss), _render(node.no, filters, loss)
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if isinstance(node, For):
        name, values, body = node.name, _value(node.values, filters), _render(node.body, filters, loss)

        def loop(scope: Scope) -> Iterator[Part]:
            # One value ahead, to know the last; the values may be a stream.
            stream = iter(values(scope) or ())
            missing = object()
            now, index = next(stream, missing), 0
            while now is not missing:
                then = next(stream, missing)
                state = {"index0": index, "first": index == 0, "last": then is missing}
                yield from body(scope | {name: now, "loop": state})
                now, index = then, index + 1

        return loop
    if isinstance(node, Set):
        name, value = node.name, _value(node.value, filters)

        def assign(scope: Scope) -> Iterator[Part]:
            scope[name] = value(scope)
            return iter(())

        return assign
    return _render(node.body, filters, True)


def compile_template(source: str, filters: Filters) -> Callable[[Scope], Iterator[Part]]:
    """A function from names to a stream of (text, whether it is under the loss mask)."""
    run = _render(fold(parse(source, filters), filters), filters, False)
    return lambda scope: run(dict(scope))
