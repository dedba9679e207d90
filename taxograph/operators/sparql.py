"""A SPARQL subset compiled to DataFrames, over a triple table, a store of ids or stars.

A group's elements are solved in order. Variables that an OPTIONAL or a branch of a UNION may leave
unbound are known, and joins on them take compatible solutions: an unbound one agrees with anything.
A FILTER inside an OPTIONAL is part of its left join and sees the variables from outside.

PREFIX; SELECT [DISTINCT] variables, *, and (COUNT([DISTINCT] ?v | *) AS ?name); groups with triple
patterns (; and , lists, a for rdf:type, paths p*), OPTIONAL, UNION, BIND(?x AS ?y), FILTER with
= != < > <= >= between variables and constants; GROUP BY, ORDER BY [ASC|DESC], LIMIT, OFFSET.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from taxograph import vocab as V
from taxograph.operators import graph as G

TOKEN = re.compile(r"""\s+|\#[^\n]*|(?P<t><[^<>\s]*>|"(?:[^"\\]|\\.)*"(?:\^\^<[^>]*>|\^\^[\w-]*:[\w-]+|@[\w-]+)?|[?$]\w+|[\w-]*:[\w.-]*|!=|<=|>=|[A-Za-z_]\w*|-?\d+(?:\.\d+)?|[{}().;,*=<>])""")

NUMBER = re.compile(r"-?\d+(\.\d+)?")


class Number(str):
    """A number as it is written; other constants compare as texts."""


@dataclass
class Query:
    """A parsed query."""

    select: list = field(default_factory=list)
    distinct: bool = False
    where: list = field(default_factory=list)
    group: list = field(default_factory=list)
    order: list = field(default_factory=list)
    limit: int | None = None
    offset: int = 0


class Parser:
    def __init__(self, text: str):
        self.tokens, at = [], 0
        while at < len(text):
            m = TOKEN.match(text, at)
            if not m:
                raise ValueError(f"cannot read the query at {text[at:at + 30]!r}")
            if m["t"]:
                self.tokens.append(m["t"])
            at = m.end()
        self.at, self.prefixes = 0, dict(V.PREFIXES)

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def take(self, wanted: str | None = None) -> str:
        token = self.peek()
        if wanted is not None and token.upper() != wanted.upper():
            raise ValueError(f"expected {wanted!r}, found {token!r}")
        self.at += 1
        return token

    def word(self, *words: str) -> bool:
        """Take the next token if it is one of the words."""
        if self.peek().upper() in words:
            self.at += 1
            return True
        return False

    def parse(self) -> Query:
        q = Query()
        while self.word("PREFIX"):
            name = self.take()[:-1]
            self.prefixes[name] = self.take()[1:-1]
        self.take("SELECT")
        q.distinct = self.word("DISTINCT")
        while not self.peek().upper() in ("WHERE", "{"):
            q.select.append(self.projection())
        self.word("WHERE")
        q.where = self.group()
        while self.peek():
            if self.word("GROUP"):
                self.take("BY")
                while G.is_variable(self.peek()):
                    q.group.append(self.take()[1:])
            elif self.word("ORDER"):
                self.take("BY")
                while self.peek().upper() in ("ASC", "DESC") or G.is_variable(self.peek()):
                    down = self.peek().upper() == "DESC"
                    if self.word("ASC", "DESC"):
                        self.take("(")
                        q.order.append((self.take()[1:], down))
                        self.take(")")
                    else:
                        q.order.append((self.take()[1:], False))
            elif self.word("LIMIT"):
                q.limit = int(self.take())
            elif self.word("OFFSET"):
                q.offset = int(self.take())
            else:
                raise ValueError(f"unexpected {self.peek()!r}")
        return q

    def projection(self) -> tuple:
        if self.word("*"):
            return ("all",)
        if self.word("("):
            self.take("COUNT")
            self.take("(")
            distinct = self.word("DISTINCT")
            of = self.take()
            self.take(")")
            self.take("AS")
            name = self.take()[1:]
            self.take(")")
            return ("count", distinct, of[1:] if G.is_variable(of) else None, name)
        return ("variable", self.take()[1:])

    def group(self) -> list:
        """The elements of { ... }."""
        self.take("{")
        out: list = []
        while not self.word("}"):
            if self.word("OPTIONAL"):
                out.append(("optional", self.group()))
            elif self.word("BIND"):
                self.take("(")
                value = self.term()
                self.take("AS")
                out.append(("bind", value, self.take()[1:]))
                self.take(")")
            elif self.word("FILTER"):
                self.take("(")
                left, op, right = self.term(), self.take(), self.term()
                self.take(")")
                out.append(("filter", left, op, right))
            elif self.peek() == "{":
                branches = [self.group()]
                while self.word("UNION"):
                    branches.append(self.group())
                out.append(("union", branches))
            elif not self.word("."):
                out += self.patterns()
        return out

    def patterns(self) -> list:
        """subject predicate object, with ; and , lists."""
        subject, out = self.term(), []
        while True:
            predicate = V.RDF + "type" if self.peek() == "a" and self.take() else self.term()
            if self.word("*"):
                predicate += "*"
            while True:
                out.append(("pattern", (subject, predicate, self.term())))
                if not self.word(","):
                    break
            if not self.word(";"):
                break
            if self.peek() in (".", "}"):
                break
        self.word(".")
        return out

    def term(self) -> str:
        t = self.take()
        if t[0] in "?$":
            return "?" + t[1:]
        if t[0] == "<":
            return t[1:-1]
        if t[0] == '"':
            text = re.sub(r"\\(.)", r"\1", re.match(r'"((?:[^"\\]|\\.)*)"', t)[1])
            return Number(text) if '"^^' in t and NUMBER.fullmatch(text) else text
        if NUMBER.fullmatch(t):
            return Number(t)
        if ":" in t:
            prefix, _, name = t.partition(":")
            if prefix not in self.prefixes:
                raise ValueError(f"prefix {prefix!r} is not declared")
            return self.prefixes[prefix] + name
        return t


@dataclass
class Solved:
    """Solutions with a column per variable, and which of these may be unbound (null)."""

    rows: DataFrame
    unsure: set[str] = field(default_factory=set)


class Evaluator:
    """Groups over a source: a triple table, a store (solutions hold ids) or stars."""

    def __init__(self, source: G.Source):
        self.source, self.store = source, source if isinstance(source, G.Store) else None

    def bind(self, term: str, columns: list[str]) -> Column:
        if G.is_variable(term):
            return F.col(term[1:]) if term[1:] in columns else F.lit(None).cast("string")
        if self.store is None:
            return F.lit(term)
        raise ValueError("BIND of a constant needs a triple table")

    def compare(self, left: str, op: str, right: str, value, texts: bool) -> Column:
        """A comparison of the values of a solution; texts: all of them are texts, not ids."""
        a, b = (value(t[1:]) if G.is_variable(t) else F.lit(t) for t in (left, right))
        if not texts:
            if G.is_variable(left) and G.is_variable(right):
                return a == b if op == "=" else a != b
            variable, constant = (a, right) if G.is_variable(left) else (b, left)
            among = variable.isin(self.store.ids_of(constant))
            return among if op == "=" else ~among
        if isinstance(left, Number) or isinstance(right, Number):
            a, b = a.try_cast("double"), b.try_cast("double")
        return {"=": a == b, "!=": a != b, "<": a < b, ">": a > b, "<=": a <= b, ">=": a >= b}[op]

    def on_ids(self, left: str, op: str, right: str) -> bool:
        """Whether a comparison can be made on ids: of equality, and not of numbers."""
        return op in ("=", "!=") and not isinstance(left, Number) and not isinstance(right, Number) and (G.is_variable(left) or G.is_variable(right))

    def filtered(self, rows: DataFrame, left: str, op: str, right: str) -> DataFrame:
        value = lambda v: F.col(v) if v in rows.columns else F.lit(None)
        if self.store is None or self.on_ids(left, op, right):
            return rows.filter(self.compare(left, op, right, value, self.store is None))
        used = {t[1:] for t in (left, right) if G.is_variable(t)} & set(rows.columns)
        shown = lambda v: F.col(f"__text_{v}") if v in used else F.lit(None)
        return self.with_texts(rows, used, "__text_").filter(self.compare(left, op, right, shown, True)).select(*rows.columns)

    def with_texts(self, rows: DataFrame, variables: set[str], mark: str) -> DataFrame:
        """rows with the texts of some variables besides, under marked names."""
        if not variables:
            return rows
        names = [mark + v for v in sorted(variables)]
        return self.store.decoded(rows.select("*", *[F.col(v[len(mark):]).alias(v) for v in names]), names)

    def joined(self, left: Solved | None, right: Solved, how: str = "inner", filters: list = ()) -> Solved:
        if left is None and how == "inner":
            return right
        left = left or Solved(self.spark.range(1).select())
        here, there = set(left.rows.columns), set(right.rows.columns)
        texts = [f for f in filters if self.store is not None and not self.on_ids(*f)]
        used = {t[1:] for f in texts for t in (f[0], f[2]) if G.is_variable(t)}
        a, b = (self.with_texts(side.rows, used & set(side.rows.columns), mark) for side, mark in ((left, "__left_"), (right, "__right_")))

        def condition(value):
            text = lambda v: F.coalesce(value(f"__left_{v}"), value(f"__right_{v}"))
            return reduce(lambda x, y: x & y, [self.compare(*f, text, True) if f in texts else self.compare(*f, value, self.store is None) for f in filters])

        rows = G.compatible(a, b, left.unsure | right.unsure, how, condition if filters else None)
        rows = rows.select(*[c for c in rows.columns if not c.startswith(("__left_", "__right_"))])
        both = (left.unsure - there) | (left.unsure & right.unsure)
        return Solved(rows, both | (right.unsure - here) if how == "inner" else left.unsure | (there - here))

    @property
    def spark(self):
        return self.source.sparkSession if isinstance(self.source, DataFrame) else self.source.spark

    def star(self, elements: list) -> tuple[Solved | None, list]:
        """What stars can answer at the head of a group, and the elements that are left."""
        if not isinstance(self.source, G.Stars):
            return None, elements
        n = next((k for k, e in enumerate(elements) if e[0] != "pattern"), len(elements))
        required, taken = [e[1] for e in elements[:n]], []
        fits = lambda x, subject: x[0] == subject and not G.is_variable(x[1]) and not G.is_path(x)
        if not required or not G.is_variable(required[0][0]) or not all(fits(x, required[0][0]) for x in required):
            return None, elements
        subject = required[0][0]
        names = [subject, *(x[2] for x in required if G.is_variable(x[2]))]
        for e in elements[n:]:
            x = e[1][0][1] if e[0] == "optional" and len(e[1]) == 1 and e[1][0][0] == "pattern" else None
            if x is None or not fits(x, subject) or not G.is_variable(x[2]) or x[2] in names:
                break
            names.append(x[2])
            taken.append(x)
        if len(set(names)) < len(names):
            return None, elements
        rows = self.source.star(subject[1:], [x[1:] for x in required], [x[1:] for x in taken])
        large = self.source.large
        if large is not None:
            rest = G.bgp(large, required)
            for x in taken:
                rest = G.optional(rest, G.pattern(large, x))
            rows = rows.unionByName(rest.select(*rows.columns))
        return Solved(rows, {x[2][1:] for x in taken}), elements[n + len(taken) :]

    def group(self, elements: list, filters: bool = True) -> Solved:
        """The solutions of a group, its elements in order; filters hold for the whole group."""
        own = [e[1:] for e in elements if e[0] == "filter"]
        out, rest = self.star([e for e in elements if e[0] != "filter"])
        while rest:
            kind, *what = rest[0]
            if kind == "pattern":
                n = next((k for k, e in enumerate(rest) if e[0] != "pattern"), len(rest))
                patterns, rest = [e[1] for e in rest[:n]], rest[n:]
                if out is not None and not out.unsure & {t[1:] for x in patterns for t in x if G.is_variable(t)}:
                    out = Solved(G.bgp(self.source, patterns, out.rows), out.unsure)
                else:
                    out = self.joined(out, Solved(G.bgp(self.source, patterns)))
                continue
            rest = rest[1:]
            if kind == "union":
                branches = [self.joined(out, self.group(b)) for b in what[0]]
                names = set().union(*(b.rows.columns for b in branches))
                unsure = set().union(*(b.unsure | (names - set(b.rows.columns)) for b in branches))
                out = Solved(G.union(*(b.rows for b in branches)), unsure)
            elif kind == "optional":
                inside = [e[1:] for e in what[0] if e[0] == "filter"]
                within = self.group(what[0], filters=False)
                out = self.joined(out, within, "left", inside)
            elif kind == "bind":
                out = out or Solved(self.spark.range(1).select())
                value, name = what
                unsure = {name} if G.is_variable(value) and (value[1:] in out.unsure or value[1:] not in out.rows.columns) else set()
                out = Solved(out.rows.withColumn(name, self.bind(value, out.rows.columns)), out.unsure | unsure)
        out = out or Solved(self.spark.range(1).select())
        for f in own if filters else []:
            out = Solved(self.filtered(out.rows, *f), out.unsure)
        return out


def sparql(source: G.Source, text: str) -> DataFrame:
    """The result table of a query; counts are long, everything else strings."""
    q = Parser(text).parse()
    run = Evaluator(source)
    out = run.group(q.where).rows
    counts = [s for s in q.select if s[0] == "count"]
    if counts or q.group:
        agg = [(F.count(F.lit(1)) if of is None else (F.count_distinct(of) if distinct else F.count(of))).alias(name) for _, distinct, of, name in counts]
        if not agg:
            out = out.select(*q.group).distinct()
        else:
            out = out.groupBy(*q.group).agg(*agg)
    if q.select != [("all",)]:
        shown = [s[1] if s[0] == "variable" else s[3] for s in q.select]
        hidden = [c for c, _ in q.order if c not in shown and not q.distinct]
        out = out.select(*shown, *hidden)
    if q.distinct:
        out = out.distinct()
    if run.store is not None:
        columns = out.columns
        out = run.store.decoded(out, [c for c in columns if c not in {s[3] for s in counts}], grouped=bool(counts or q.group)).select(*columns)
    if q.order:
        out = out.orderBy(*[F.col(c).desc() if down else F.col(c) for c, down in q.order])
    if q.select != [("all",)]:
        out = out.select(*shown)
    if q.offset:
        out = out.offset(q.offset)
    return out if q.limit is None else out.limit(q.limit)
