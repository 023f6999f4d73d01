"""A boolean query language over records, compiled to Column expressions.

    expr   = term {"OR" term}
    term   = factor {"AND" factor}
    factor = ["NOT"] ("(" expr ")" | reference ("==" | "!=") ("text" | /pattern/) | reference "EXISTS" | function "(" ["text" {"," "text"}] ")")

Functions are registered with `function`; their number of arguments is checked. A reference is a tag of three characters with an optional subfield code, in quotes or bare (245a). == holds if any
occurrence agrees, != if none does, NOT is logical negation.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioframe.records import checks, model

_TOKEN = re.compile(r'\s*(?:(?P<text>"(?:[^"\\]|\\.)*")|(?P<pattern>/(?:[^/\\]|\\.)*/)|(?P<op>==|!=|\(|\)|,)|(?P<word>[A-Za-z0-9]+))')


class QueryError(ValueError):
    pass


#: Name to (number of arguments, maker of the condition from the leader, the fields and the arguments).
FUNCTIONS: dict[str, tuple[int, Callable[..., Column]]] = {}


def function(name: str, arity: int = 0):
    """Registers a function of the query language: f(leader, fields, *texts) gives a boolean Column."""

    def add(f: Callable[..., Column]) -> Callable[..., Column]:
        FUNCTIONS[name] = (arity, f)
        return f

    return add


@function("IsArticle")
def _is_article(leader: Column, fields: Column) -> Column:
    return checks.is_component(leader)


@function("IsSerial")
def _is_serial(leader: Column, fields: Column) -> Column:
    return checks.is_serial(leader)


@function("IsMonograph")
def _is_monograph(leader: Column, fields: Column) -> Column:
    return checks.is_monograph(leader)


@function("IsElectronic")
def _is_electronic(leader: Column, fields: Column) -> Column:
    return checks.is_electronic(leader, fields)


@function("HasValue", 2)
def _has_value(leader: Column, fields: Column, reference: str, value: str) -> Column:
    return F.exists(model.values(fields, reference[:3], reference[3:]), lambda v: v == value)


@dataclass(frozen=True)
class Token:
    kind: str
    value: str


def tokens(query: str) -> list[Token]:
    out, at, query = [], 0, query.rstrip()
    while at < len(query):
        m = _TOKEN.match(query, at)
        if not m:
            raise QueryError(f"unexpected {query[at:at + 10]!r}")
        at = m.end()
        kind, value = next((k, v) for k, v in m.groupdict().items() if v is not None)
        if kind in ("text", "pattern"):
            value = re.sub(r'\\(["/\\])', r"\1", value[1:-1]) if kind == "text" else value[1:-1].replace("\\/", "/")
        out.append(Token(kind, value))
    return out


class _Parser:
    def __init__(self, query: str, fields: Column, leader: Column):
        self.rest, self.fields, self.leader = tokens(query)[::-1], fields, leader

    def peek(self, *values: str) -> bool:
        return bool(self.rest) and self.rest[-1].kind in ("word", "op") and self.rest[-1].value in values

    def take(self) -> Token:
        if not self.rest:
            raise QueryError("the query ends too early")
        return self.rest.pop()

    def expr(self) -> Column:
        out = self.term()
        while self.peek("OR"):
            self.take()
            out = out | self.term()
        return out

    def term(self) -> Column:
        out = self.factor()
        while self.peek("AND"):
            self.take()
            out = out & self.factor()
        return out

    def factor(self) -> Column:
        if self.peek("NOT"):
            self.take()
            return ~self.factor()
        if self.peek("("):
            self.take()
            out = self.expr()
            if not self.peek(")"):
                raise QueryError("a parenthesis is not closed")
            self.take()
            return out
        reference = self.take()
        if reference.kind == "word" and self.peek("("):
            return self.call(reference.value)
        if reference.kind not in ("word", "text") or len(reference.value) not in (3, 4):
            raise QueryError(f"no reference: {reference.value!r}")
        tag, code = reference.value[:3], reference.value[3:] or None
        op = self.take()
        if op.value == "EXISTS":
            return model.has_tag(self.fields, tag) if code is None else model.matches(self.fields, tag, code, "")
        if op.value not in ("==", "!="):
            raise QueryError(f"no comparison: {op.value!r}")
        operand = self.take()
        if operand.kind not in ("text", "pattern"):
            raise QueryError(f"no text or pattern: {operand.value!r}")
        pattern = operand.value if operand.kind == "pattern" else "^" + re.sub(r"([^\w\s])", r"\\\1", operand.value) + "$"
        found = model.matches(self.fields, tag, code, pattern)
        return found if op.value == "==" else ~found

    def call(self, name: str) -> Column:
        self.take()
        given = []
        while not self.peek(")"):
            if given and self.take().value != ",":
                raise QueryError(f"no comma between the arguments of {name}")
            argument = self.take()
            if argument.kind != "text":
                raise QueryError(f"no text: {argument.value!r}")
            given.append(argument.value)
        self.take()
        if name not in FUNCTIONS:
            raise QueryError(f"no function {name!r}")
        arity, make = FUNCTIONS[name]
        if len(given) != arity:
            raise QueryError(f"{name} takes {arity} arguments, not {len(given)}")
        return make(self.leader, self.fields, *given)


def compile_query(query: str, fields: Column | None = None, leader: Column | None = None) -> Column:
    """A boolean Column for the query over an array of fields (by default the columns `fields` and, for functions, `leader`)."""
    parser = _Parser(query, F.col("fields") if fields is None else fields, F.col("leader") if leader is None else leader)
    out = parser.expr()
    if parser.rest:
        raise QueryError(f"unexpected {parser.rest[-1].value!r}")
    return out


def compile_conjunction(conditions: str, fields: Column | None = None) -> Column:
    """TTTc=pattern conditions divided by white space; all must hold."""
    fields = F.col("fields") if fields is None else fields
    out = F.lit(True)
    for part in conditions.split():
        reference, equals, pattern = part.partition("=")
        if not equals or len(reference) not in (3, 4):
            raise QueryError(f"no condition: {part!r}")
        out = out & model.matches(fields, reference[:3], reference[3:] or None, pattern)
    return out
