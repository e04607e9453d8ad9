"""Syntax trees. Expressions are Expr; everything else is made of dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Any


@dataclass(frozen=True)
class Expr:
    """kind and its operands:

    col (parts) | star (parts) | lit (value) | hex (digits) | param (name) | listparam (name) | call (name, args, **more)
    | op (symbol, left, right) | not/neg/plus/inv/binary (x) | between (x, lo, hi, negated) | in (x, items, negated)
    | like (x, pattern, escape, negated) | regexp (x, pattern, negated) | is (x, what, negated) | case (x, whens, other)
    | exists (query, negated) | subquery (query) | quantified (symbol, x, all, query) | tuple (items) | interval (x, unit)
    | cast (x, type) | collate (x, name) | system (name)
    """

    kind: str
    args: tuple = ()
    more: tuple[tuple[str, Any], ...] = ()

    def get(self, name: str, default: Any = None) -> Any:
        return dict(self.more).get(name, default)


def expr(kind: str, *args: Any, **more: Any) -> Expr:
    return Expr(kind, args, tuple(more.items()))


@dataclass
class Item:
    value: Expr
    alias: str | None = None
    text: str = ""  # as written, which names a column without an alias


@dataclass
class Order:
    value: Expr
    descending: bool = False


@dataclass
class TableRef:
    parts: tuple[str, ...]
    alias: str | None = None

    @property
    def name(self) -> str:
        return self.alias or self.parts[-1]


@dataclass
class Derived:
    query: Any
    alias: str
    columns: tuple[str, ...] = ()


@dataclass
class Join:
    kind: str  # INNER, LEFT, RIGHT, FULL, CROSS, LEFT SEMI, LEFT ANTI
    left: Any
    right: Any
    on: Expr | None = None
    using: tuple[str, ...] = ()
    natural: bool = False


@dataclass
class Select:
    items: list[Item]
    source: Any = None
    where: Expr | None = None
    group: list[Expr] = field(default_factory=list)
    grouping: str = ""  # "", ROLLUP, CUBE or SETS
    having: Expr | None = None
    windows: list[tuple[str, Any]] = field(default_factory=list)
    distinct: bool = False
    count_all: bool = False  # SQL_CALC_FOUND_ROWS


@dataclass
class SetOp:
    op: str  # UNION, EXCEPT, INTERSECT
    all: bool
    left: Any
    right: Any


@dataclass
class Query:
    body: Any  # Select, SetOp or Query
    order: list[Order] = field(default_factory=list)
    limit: Expr | None = None
    offset: Expr | None = None
    ctes: list[tuple[str, tuple[str, ...], Any]] = field(default_factory=list)
    recursive: bool = False
    locking: bool = False


@dataclass
class Insert:
    table: TableRef
    columns: tuple[str, ...]
    rows: list[list[Expr]] | None = None
    query: Query | None = None
    ignore: bool = False
    replace: bool = False
    on_duplicate: list[tuple[str, Expr]] = field(default_factory=list)


@dataclass
class Update:
    table: TableRef
    sets: list[tuple[str, Expr]]
    where: Expr | None = None
    order: list[Order] = field(default_factory=list)
    limit: Expr | None = None


@dataclass
class Delete:
    table: TableRef
    where: Expr | None = None
    order: list[Order] = field(default_factory=list)
    limit: Expr | None = None


@dataclass
class Command:
    """SET, SHOW, BEGIN, COMMIT, ROLLBACK, USE; NEXT with a number and a sequence's name"""

    verb: str
    words: tuple[str, ...]


@dataclass
class Statement:
    body: Any
    shard: str | None = None  # of a /*shard=...*/ comment
    params: tuple[str, ...] = ()  # names of binds in order; positional ones are p1, p2, ...


def rebuilt(e: Any, change) -> Any:
    """e with `change` applied to each part below it that is an Expr, or to those in tuples."""
    if isinstance(e, Expr):
        return replace(e, args=tuple(rebuilt_part(a, change) for a in e.args), more=tuple((k, rebuilt_part(v, change)) for k, v in e.more))
    return e


def rebuilt_part(a: Any, change) -> Any:
    if isinstance(a, Expr):
        return change(a)
    if isinstance(a, tuple):
        return tuple(rebuilt_part(x, change) for x in a)
    return a


def parts_of(e: Any):
    """e and the expressions below it, not into subqueries."""
    if isinstance(e, Expr):
        yield e
        for a in (*e.args, *(v for _, v in e.more)):
            yield from parts_of(a)
    elif isinstance(e, tuple):
        for a in e:
            yield from parts_of(a)


def conjuncts(e: Expr | None) -> list[Expr]:
    if e is None:
        return []
    if e.kind == "op" and e.args[0] == "AND":
        return conjuncts(e.args[1]) + conjuncts(e.args[2])
    return [e]
