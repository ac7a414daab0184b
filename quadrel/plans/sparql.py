"""SPARQL text compiled to DataFrames.

text -> tokens -> algebra (dataclasses) -> DataFrame.  A solution sequence is a DataFrame
with one STRING column of encoded terms (``quadrel.functions.terms``) for each variable;
null is unbound.  Every triple pattern is one filtered scan, and everything after that is
joins, so that Catalyst prunes, pushes filters into the scans, picks join strategies by
size and re-plans at run time.

Order within a group: with statistics of the quads (:mod:`quadrel.plans.statistics`) the
order in which the fewest rows are expected in between; without them greedily, those with
more constants first.  Neither makes a cross product while a connected pattern is left.  OPTIONAL is a left outer join
whose inner FILTERs stand in the join condition.

A join on a variable that may be unbound on either side (after OPTIONAL or UNION) is
refused with an error; the queries this engine is made for never need one.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from collections import Counter
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrel.functions import terms as T
from quadrel.plans.statistics import Statistics

#: Datatypes whose values are whole numbers.
WHOLE = tuple(T.XSD + x for x in ("integer", "int", "long", "short", "nonNegativeInteger", "positiveInteger"))


class SparqlError(ValueError):
    """The query can't be parsed or isn't supported."""


# --- algebra


@dataclass
class Var:
    name: str


@dataclass
class Term:
    """A constant, as an encoded term."""

    value: str


@dataclass
class Call:
    name: str
    args: list


@dataclass
class Path:
    """A predicate followed once or more; or, with ``empty``, not at all either."""

    term: Term
    empty: bool


@dataclass
class Pattern:
    s: Var | Term
    p: Var | Term | Path
    o: Var | Term


@dataclass
class Group:
    """Elements of a group in order; filters apply to the whole group."""

    elements: list = field(default_factory=list)
    filters: list = field(default_factory=list)


@dataclass
class Optional:
    group: Group


@dataclass
class Minus:
    group: Group


@dataclass
class Union:
    groups: list[Group]


@dataclass
class Graph:
    name: Var | Term
    group: Group


@dataclass
class Bind:
    expression: object
    name: str


@dataclass
class Values:
    names: list[str]
    rows: list[list[str | None]]


@dataclass
class Query:
    select: list[tuple[str, object | None]] | None
    distinct: bool
    where: Group
    group_by: list[str]
    having: list
    order_by: list[tuple[object, bool]]
    limit: int | None
    offset: int
    ask: bool = False


AGGREGATES = {"COUNT", "SUM", "MIN", "MAX", "AVG", "SAMPLE"}

_TOKEN = re.compile(
    r"""(?P<skip>\s+|\#[^\n]*)
      | (?P<iri><[^<>"{}|^`\\\s]*>)
      | (?P<text>"(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')
      | (?P<var>[?$]\w+)
      | (?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
      | (?P<number>\d+(?:\.\d+)?(?:[eE][+-]?\d+)?)
      | (?P<name>(?:[A-Za-z][\w-]*)?:(?:[\w][\w.-]*(?<!\.))?)
      | (?P<word>[A-Za-z_]\w*)
      | (?P<mark>\^\^|&&|\|\||!=|<=|>=|[{}()\[\].;,=<>!*/+-])""",
    re.X,
)


class _Parser:
    def __init__(self, text: str):
        self.items: list[tuple[str, str]] = []
        at = 0
        while at < len(text):
            m = _TOKEN.match(text, at)
            if not m:
                raise SparqlError(f"unexpected text: {text[at : at + 30]!r}")
            at = m.end()
            if m.lastgroup != "skip":
                self.items.append((m.lastgroup, m[0]))
        self.items.append(("end", ""))
        self.at = 0
        self.prefixes: dict[str, str] = {}
        self.blanks = 0

    # tokens

    def peek(self) -> tuple[str, str]:
        return self.items[self.at]

    def take(self) -> tuple[str, str]:
        self.at += 1
        return self.items[self.at - 1]

    def is_(self, *words: str) -> bool:
        kind, text = self.peek()
        return text in words if kind == "mark" else kind == "word" and text.upper() in words

    def accept(self, *words: str) -> bool:
        if self.is_(*words):
            self.at += 1
            return True
        return False

    def expect(self, word: str) -> None:
        if not self.accept(word):
            raise SparqlError(f"expected {word}, found {self.peek()[1]!r}")

    # query

    def query(self) -> Query:
        while self.accept("PREFIX"):
            name = self.take()[1]
            self.prefixes[name[:-1]] = self.take()[1][1:-1]
        ask = self.accept("ASK")
        select, distinct = None, False
        if not ask:
            self.expect("SELECT")
            distinct = self.accept("DISTINCT") or self.accept("REDUCED")
            if not self.accept("*"):
                select = []
                while not self.is_("WHERE", "{"):
                    if self.accept("("):
                        expression = self.expression()
                        self.expect("AS")
                        select.append((self.variable(), expression))
                        self.expect(")")
                    else:
                        select.append((self.variable(), None))
        self.accept("WHERE")
        where = self.group()
        group_by, having, order_by, limit, offset = [], [], [], None, 0
        if self.accept("GROUP"):
            self.expect("BY")
            while self.peek()[0] == "var":
                group_by.append(self.variable())
        if self.accept("HAVING"):
            while self.is_("("):
                having.append(self.bracketed())
        if self.accept("ORDER"):
            self.expect("BY")
            while True:
                if self.is_("ASC", "DESC"):
                    down = self.take()[1].upper() == "DESC"
                    order_by.append((self.bracketed(), down))
                elif self.peek()[0] == "var":
                    order_by.append((Var(self.variable()), False))
                elif self.is_("("):
                    order_by.append((self.bracketed(), False))
                else:
                    break
        while self.is_("LIMIT", "OFFSET"):
            if self.accept("LIMIT"):
                limit = int(self.take()[1])
            else:
                self.take()
                offset = int(self.take()[1])
        if self.peek()[0] != "end":
            raise SparqlError(f"unexpected {self.peek()[1]!r}")
        return Query(select, distinct, where, group_by, having, order_by, limit, offset, ask)

    def variable(self) -> str:
        kind, text = self.take()
        if kind != "var":
            raise SparqlError(f"expected a variable, found {text!r}")
        return text[1:]

    def group(self) -> Group:
        self.expect("{")
        out = Group()
        while not self.accept("}"):
            if self.accept("FILTER"):
                out.filters.append(self.bracketed() if self.is_("(") else self.primary())
            elif self.accept("OPTIONAL"):
                out.elements.append(Optional(self.group()))
            elif self.accept("MINUS"):
                out.elements.append(Minus(self.group()))
            elif self.accept("GRAPH"):
                out.elements.append(Graph(self.node(), self.group()))
            elif self.accept("BIND"):
                self.expect("(")
                expression = self.expression()
                self.expect("AS")
                out.elements.append(Bind(expression, self.variable()))
                self.expect(")")
            elif self.accept("VALUES"):
                out.elements.append(self.values())
            elif self.is_("{"):
                groups = [self.group()]
                while self.accept("UNION"):
                    groups.append(self.group())
                out.elements.append(Union(groups))
            elif self.accept("."):
                pass
            else:
                self.triples(out)
        return out

    def values(self) -> Values:
        if self.accept("("):
            names = []
            while not self.accept(")"):
                names.append(self.variable())
            self.expect("{")
            rows = []
            while not self.accept("}"):
                self.expect("(")
                row = []
                while not self.accept(")"):
                    row.append(self.value())
                rows.append(row)
            return Values(names, rows)
        name = self.variable()
        self.expect("{")
        rows = []
        while not self.accept("}"):
            rows.append([self.value()])
        return Values([name], rows)

    def value(self) -> str | None:
        return None if self.accept("UNDEF") else self.constant().value

    def triples(self, out: Group) -> None:
        subject = self.node()
        while True:
            predicate = self.verb()
            while True:
                out.elements.append(Pattern(subject, predicate, self.node()))
                if not self.accept(","):
                    break
            if not self.accept(";"):
                break
            while self.accept(";"):
                pass
            if self.is_(".", "}"):
                break

    def verb(self) -> Var | Term | Path:
        if self.peek() == ("word", "a"):
            self.take()
            return Term(T.TYPE)
        found = self.node()
        if self.is_("+", "*"):
            if isinstance(found, Var):
                raise SparqlError("a path needs a predicate")
            return Path(found, self.take()[1] == "*")
        return found

    def node(self) -> Var | Term:
        if self.peek()[0] == "var":
            return Var(self.variable())
        return self.constant()

    def constant(self) -> Term:
        kind, text = self.take()
        if kind == "iri":
            return Term(text)
        if kind == "name":
            prefix, _, local = text.partition(":")
            if prefix not in self.prefixes:
                raise SparqlError(f"no such prefix: {prefix!r}")
            return Term(f"<{self.prefixes[prefix]}{local}>")
        if kind == "text":
            body = re.sub(r"\\(.)", lambda m: {"n": "\n", "t": "\t", "r": "\r"}.get(m[1], m[1]), text[1:-1])
            if self.peek()[0] == "lang":
                return Term(f'"{body}"{self.take()[1].lower()}')
            if self.accept("^^"):
                datatype = self.constant().value[1:-1]
                return Term(f'"{body}"' if datatype == T.XSD + "string" else f'"{body}"^^{datatype}')
            return Term(f'"{body}"')
        if kind == "number":
            suffix = "double" if "e" in text.lower() else "decimal" if "." in text else "integer"
            return Term(f'"{text}"^^{T.XSD}{suffix}')
        if kind == "word" and text.lower() in ("true", "false"):
            return Term(f'"{text.lower()}"^^{T.XSD}boolean')
        raise SparqlError(f"not a term: {text!r}")

    # expressions, loosest first

    def bracketed(self):
        self.expect("(")
        out = self.expression()
        self.expect(")")
        return out

    def expression(self):
        out = self.conjunction()
        while self.accept("||"):
            out = Call("||", [out, self.conjunction()])
        return out

    def conjunction(self):
        out = self.comparison()
        while self.accept("&&"):
            out = Call("&&", [out, self.comparison()])
        return out

    def comparison(self):
        out = self.sum()
        if self.is_("=", "!=", "<", ">", "<=", ">="):
            return Call(self.take()[1], [out, self.sum()])
        if self.accept("IN"):
            return Call("IN", [out, *self.arguments()])
        if self.accept("NOT"):
            self.expect("IN")
            return Call("!", [Call("IN", [out, *self.arguments()])])
        return out

    def sum(self):
        out = self.product()
        while self.is_("+", "-"):
            out = Call(self.take()[1], [out, self.product()])
        return out

    def product(self):
        out = self.primary()
        while self.is_("*", "/"):
            out = Call(self.take()[1], [out, self.primary()])
        return out

    def primary(self):
        kind, text = self.peek()
        if self.accept("!"):
            return Call("!", [self.primary()])
        if self.accept("-"):
            return Call("NEG", [self.primary()])
        if text == "(":
            return self.bracketed()
        if kind == "var":
            return Var(self.variable())
        if kind == "word" and text.lower() not in ("true", "false"):
            self.take()
            if text.upper() in AGGREGATES:
                return self.aggregate(text.upper())
            return Call(text.upper(), self.arguments())
        constant = self.constant()
        if self.is_("(") and constant.value.startswith(f"<{T.XSD}"):
            return Call(constant.value[1:-1], self.arguments())
        return constant

    def aggregate(self, name: str) -> Call:
        self.expect("(")
        distinct = self.accept("DISTINCT")
        inner = None if self.accept("*") else self.expression()
        self.expect(")")
        return Call("AGG", [name, distinct, inner])

    def arguments(self) -> list:
        self.expect("(")
        out = []
        while not self.accept(")"):
            out.append(self.expression())
            self.accept(",")
        return out


def parse(text: str) -> Query:
    return _Parser(text).query()


# --- expressions


@dataclass
class Value:
    """A compiled expression: a term column, or a plain string, number or boolean."""

    kind: str
    column: Column

    def term(self) -> Column:
        if self.kind == "term":
            return self.column
        if self.kind == "string":
            return T.literal(self.column)
        if self.kind == "boolean":
            return T.literal(self.column, T.XSD + "boolean")
        return T.literal(self.column, T.XSD + ("integer" if self.kind == "integer" else "double"))

    def text(self) -> Column:
        return T.lexical(self.column) if self.kind == "term" else self.column.cast("string")

    def string(self) -> Column:
        """For functions on strings: the text of a literal; an error, null, for an IRI."""
        return F.when(T.is_literal(self.column), T.lexical(self.column)) if self.kind == "term" else self.column.cast("string")

    def number(self) -> Column:
        if self.kind == "term":
            return T.number(self.column)
        return self.column.cast("double") if self.kind in ("number", "integer") else F.lit(None).cast("double")

    def truth(self) -> Column:
        """Effective boolean value."""
        if self.kind == "boolean":
            return self.column
        if self.kind == "string":
            return self.column != ""
        if self.kind == "term":
            kind = T.datatype(self.column)
            value = T.number(self.column)
            return (
                F.when(kind == T.XSD + "boolean", T.lexical(self.column).isin("true", "1"))
                .when(value.isNotNull(), value != 0)
                .when(kind == T.XSD + "string", T.lexical(self.column) != "")
            )
        return self.column != 0


def compare(op: str, a: Value, b: Value) -> Column:
    x, y = a.number(), b.number()
    numeric = x.isNotNull() & y.isNotNull()
    if op in ("=", "!="):
        if "number" in (a.kind, b.kind) or "integer" in (a.kind, b.kind):
            same = x == y
        elif a.kind == b.kind == "boolean":
            same = a.column == b.column
        else:
            same = F.when(numeric, x == y).otherwise(a.term() == b.term())
        return same if op == "=" else ~same
    less: dict[str, Callable[[Column, Column], Column]] = {"<": lambda p, q: p < q, ">": lambda p, q: p > q, "<=": lambda p, q: p <= q, ">=": lambda p, q: p >= q}
    if "number" in (a.kind, b.kind) or "integer" in (a.kind, b.kind):
        return less[op](x, y)
    comparable = F.lit(True)
    for v in (a, b):
        if v.kind == "term":
            comparable = comparable & T.is_literal(v.column)
    return F.when(numeric, less[op](x, y)).when(x.isNull() & y.isNull() & comparable, less[op](a.text(), b.text()))


class _Expressions:
    def __init__(self, bound: dict[str, Column]):
        self.bound = bound

    def of(self, e) -> Value:
        if isinstance(e, Var):
            return Value("term", self.bound.get(e.name, F.lit(None).cast("string")))
        if isinstance(e, Term):
            return Value("term", F.lit(e.value))
        return self.call(e.name, e.args)

    def call(self, name: str, raw: list) -> Value:
        if name == "BOUND":
            return Value("boolean", self.of(raw[0]).column.isNotNull())
        args = [self.of(x) for x in raw]
        first = args[0] if args else None
        if name in ("&&", "||"):
            p, q = (x.truth() for x in args)
            return Value("boolean", p & q if name == "&&" else p | q)
        if name == "!":
            return Value("boolean", ~first.truth())
        if name in ("=", "!=", "<", ">", "<=", ">="):
            return Value("boolean", compare(name, *args))
        if name == "IN":
            if all(isinstance(x, Term) and x.value.startswith("<") for x in raw[1:]):
                return Value("boolean", first.term().isin([x.value for x in raw[1:]]))
            out = F.lit(False)
            for x in args[1:]:
                out = out | compare("=", first, x)
            return Value("boolean", out)
        if name in ("+", "-", "*", "/"):
            x, y = first.number(), args[1].number()
            return Value("number", {"+": x + y, "-": x - y, "*": x * y, "/": F.try_divide(x, y)}[name])
        if name == "NEG":
            return Value("number", -first.number())
        if name == "STR":
            return Value("string", first.text())
        if name == "LANG":
            return Value("string", T.lang(first.term()))
        if name == "DATATYPE":
            return Value("term", T.iri(T.datatype(first.term())))
        if name == "LANGMATCHES":
            tag, range_ = F.lower(first.string()), F.lower(args[1].string())
            return Value("boolean", F.when(range_ == "*", tag != "").otherwise((tag == range_) | tag.startswith(F.concat(range_, F.lit("-")))))
        if name in ("CONTAINS", "STRSTARTS", "STRENDS"):
            x, y = first.string(), args[1].string()
            return Value("boolean", {"CONTAINS": F.contains, "STRSTARTS": F.startswith, "STRENDS": F.endswith}[name](x, y))
        if name == "REGEX":
            flags = raw[2].value[1:-1] if len(raw) > 2 else ""
            pattern = T.lexical(F.lit(raw[1].value))
            return Value("boolean", F.regexp_like(first.string(), F.concat(F.lit(f"(?{flags})" if flags else ""), pattern)))
        if name == "REPLACE":
            return Value("string", F.regexp_replace(first.string(), args[1].string(), args[2].string()))
        if name == "STRLEN":
            return Value("integer", F.char_length(first.string()).cast("long"))
        if name in ("UCASE", "LCASE"):
            return Value("string", (F.upper if name == "UCASE" else F.lower)(first.string()))
        if name == "CONCAT":
            return Value("string", F.concat(*[x.string() for x in args]))
        if name == "COALESCE":
            if len({x.kind for x in args}) == 1:
                return Value(first.kind, F.coalesce(*[x.column for x in args]))
            return Value("term", F.coalesce(*[x.term() for x in args]))
        if name == "IF":
            yes, no = args[1], args[2]
            kind, pick = (yes.kind, lambda v: v.column) if yes.kind == no.kind else ("term", Value.term)
            # An error in the condition is an error, not the other branch.
            truth = first.truth()
            return Value(kind, F.when(truth, pick(yes)).when(~truth, pick(no)))
        if name in ("ISIRI", "ISURI", "ISBLANK", "ISLITERAL"):
            test = {"ISBLANK": T.is_blank, "ISLITERAL": T.is_literal}.get(name, T.is_iri)
            return Value("boolean", test(first.term()))
        if name == "ISNUMERIC":
            return Value("boolean", first.number().isNotNull())
        if name in ("ABS", "ROUND", "CEIL", "FLOOR"):
            return Value("number", {"ABS": F.abs, "ROUND": F.round, "CEIL": F.ceil, "FLOOR": F.floor}[name](first.number()).cast("double"))
        if name in (T.XSD + "double", T.XSD + "float", T.XSD + "decimal"):
            return Value("number", first.text().try_cast("double"))
        if name == T.XSD + "integer":
            return Value("integer", first.text().try_cast("double").cast("long"))
        if name == T.XSD + "string":
            return Value("string", first.text())
        raise SparqlError(f"no such function: {name}")


# --- groups


@dataclass
class _Bindings:
    """Solutions: a DataFrame of variables, and those that may be unbound."""

    df: DataFrame | None
    names: list[str]
    loose: set[str]
    bounded: bool = False  # as many rows at most as the query's text has


def _mentions(x) -> list[str]:
    """The variables of a part of a query, as often as they occur."""
    if isinstance(x, Var):
        return [x.name]
    if isinstance(x, (list, tuple)):
        return [n for y in x for n in _mentions(y)]
    if isinstance(x, Bind):
        return [x.name, *_mentions(x.expression)]
    if isinstance(x, Values):
        return list(x.names)
    if isinstance(x, (Query, Group, Pattern, Path, Optional, Minus, Union, Graph, Call)):
        return [n for y in vars(x).values() for n in _mentions(y)]
    return []


def _column(name: str) -> str:
    return f"v_{name}"


class Compiler:
    """Compiles queries over ``quads(g, s, p, o)``.

    The default graph is the union of all graphs; a triple that several graphs hold is in it
    once.  ``unique`` says that no two graphs share a triple, which saves that step, as does
    a DISTINCT without aggregates.  Under such a DISTINCT a pattern whose new variables occur
    nowhere else only asks whether there is a triple: a semi-join.  Patterns that share no
    variable are refused, unless one side is as small as the query's text.
    """

    def __init__(self, quads: DataFrame, unique: bool = False, statistics: Statistics | None = None):
        self.quads, self.unique, self.statistics = quads, unique, statistics
        self.as_set = False
        self.once: set[str] = set()

    def select(self, text: str) -> DataFrame:
        """The result of a SELECT, a column of encoded terms for each variable, in order of the ORDER BY."""
        return self.run(parse(text))

    def run(self, query: Query) -> DataFrame:
        self.as_set = query.distinct and not query.group_by and not any(_has_aggregate(e) for _, e in query.select or [])
        if self.as_set and query.select is not None:
            mentioned = Counter([*_mentions(query), *(n for n, _ in query.select)])
            self.once = {n for n, times in mentioned.items() if times == 1}
        found = self.group(query.where, None, _Bindings(None, [], set()))
        df = found.df
        bound = {n: F.col(_column(n)) for n in found.names}
        select = query.select if query.select is not None else [(n, None) for n in found.names]
        if query.group_by or any(_has_aggregate(e) for _, e in select):
            df, bound = self.aggregated(query, select, df, bound)
        else:
            for name, e in select:
                if e is not None:
                    df = df.withColumn(_column(name), _Expressions(bound).of(e).term())
                    bound[name] = F.col(_column(name))
        order = []
        for e, down in query.order_by:
            for key in T.order_key(_Expressions(bound).of(e).term()):
                order.append(key.desc_nulls_last() if down else key.asc_nulls_first())
        names = [n for n, _ in select]
        for n in names:
            if n not in bound:
                df = df.withColumn(_column(n), F.lit(None).cast("string"))
        if query.distinct:
            # Sorting keys that are not selected are gone after DISTINCT, as in the standard.
            df = df.select(*map(_column, names)).distinct()
        if order:
            df = df.orderBy(*order)
        out = df.select(*[F.col(_column(n)).alias(n) for n in names])
        if query.offset:
            out = out.offset(query.offset)
        return out.limit(query.limit) if query.limit is not None else out

    def aggregated(self, query: Query, select: list, df: DataFrame, bound: dict[str, Column]):
        values, havings = [], []

        def lift(e):
            """Replace the aggregates of an expression by columns."""
            if isinstance(e, Call) and e.name == "AGG":
                name, distinct, inner = e.args
                kind, column = self.aggregate(name, distinct, None if inner is None else _Expressions(bound).of(inner), [c for c in df.columns if c.startswith("v_")])
                values.append(Value(kind, column).term().alias(f"v__a{len(values)}"))
                return Var(f"_a{len(values) - 1}")
            return Call(e.name, [lift(x) for x in e.args]) if isinstance(e, Call) else e

        lifted = [(n, None if e is None else lift(e)) for n, e in select]
        havings = [lift(e) for e in query.having]
        keys = [_column(n) for n in query.group_by]
        df = df.groupBy(*keys).agg(*values) if values else df.select(*keys).distinct()
        after = {n: F.col(_column(n)) for n in [*query.group_by, *(f"_a{i}" for i in range(len(values)))]}
        for e in havings:
            df = df.where(_Expressions(after).of(e).truth())
        for name, e in lifted:
            if e is not None:
                df = df.withColumn(_column(name), _Expressions(after).of(e).term())
                after[name] = F.col(_column(name))
        return df, after

    def aggregate(self, name: str, distinct: bool, value: Value | None, columns: list[str]) -> tuple[str, Column]:
        """Kind and column of an aggregate; DISTINCT sums and means take each number once, and over nothing they are 0."""
        if name == "COUNT":
            if value is None:
                return "integer", F.count_distinct(F.struct(*map(F.col, columns))) if distinct and columns else F.count(F.lit(1))
            return "integer", F.count_distinct(value.term()) if distinct else F.count(value.term())
        if name in ("SUM", "AVG"):
            number, kind = value.number(), T.datatype(value.term())
            whole = F.count_if(number.isNotNull() & ~kind.isin(*WHOLE)) == 0
            total, count = (F.sum_distinct(number), F.count_distinct(number)) if distinct else (F.sum(number), F.count(number))
            as_whole = T.literal(F.coalesce(total, F.lit(0)).cast("decimal(38,0)"), T.XSD + "integer")
            if name == "SUM":
                return "term", F.when(whole, as_whole).otherwise(T.literal(total, T.XSD + "double"))
            return "term", F.when(count == 0, F.lit(f'"0"^^{T.XSD}integer')).otherwise(T.literal(total / count, T.XSD + "double"))
        pick = {"MIN": F.min, "MAX": F.max, "SAMPLE": F.min}[name]
        key = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(T.order_key(value.term()))], value.term().alias("t"))
        return "term", pick(F.when(value.term().isNotNull(), key))["t"]

    def group(self, group: Group, graph: Var | Term | None, start: _Bindings) -> _Bindings:
        out = start
        pending: list[Pattern] = []

        def flush() -> None:
            nonlocal out
            if self.statistics is not None and len(pending) > 1:
                side = lambda t: ("var", t.name) if isinstance(t, Var) else ("term", t.term.value if isinstance(t, Path) else t.value)
                known = {n: 1.0 for n in out.names} if out.df is not None else {}
                ordered = [pending[i] for i in self.statistics.order([(side(x.s), side(x.p), side(x.o)) for x in pending], known)]
                pending[:] = ordered
            while pending:
                found = self.scan(pending.pop(0 if self.statistics is not None else self.next_pattern(pending, out.names)), graph)
                new = [n for n in found.names if n not in out.names]
                if out.df is not None and new and set(new) <= self.once and len(new) < len(found.names):
                    keys = [_column(n) for n in self.shared(out, found)]
                    out = _Bindings(out.df.join(found.df.select(*keys), keys, "left_semi"), out.names, out.loose)
                else:
                    out = self.join(out, found)

        for x in group.elements:
            if isinstance(x, Pattern):
                pending.append(x)
                continue
            if isinstance(x, Values) and pending:
                out = self.join(out, self.values(x)) if set(x.names) & set(out.names) or out.df is None else out
                if not set(x.names) <= set(out.names):
                    flush()
                    out = self.join(out, self.values(x))
                continue
            flush()
            if isinstance(x, Values):
                out = self.join(out, self.values(x))
            elif isinstance(x, Optional):
                out = self.optional(out, x.group, graph)
            elif isinstance(x, Minus):
                out = self.minus(out, x.group, graph)
            elif isinstance(x, Union):
                out = self.join(out, self.union([self.group(g, graph, _Bindings(None, [], set())) for g in x.groups]))
            elif isinstance(x, Graph):
                out = self.join(out, self.group(x.group, x.name, _Bindings(None, [], set())))
            elif isinstance(x, Group):
                out = self.join(out, self.group(x, graph, _Bindings(None, [], set())))
            elif isinstance(x, Bind):
                if x.name in out.names:
                    raise SparqlError(f"?{x.name} is bound already")
                bound = {n: F.col(_column(n)) for n in out.names}
                df = out.df if out.df is not None else self.quads.sparkSession.range(1)
                out = _Bindings(df.withColumn(_column(x.name), _Expressions(bound).of(x.expression).term()), [*out.names, x.name], {*out.loose, x.name}, out.bounded or out.df is None)
        flush()
        if out.df is None:
            out = _Bindings(self.quads.sparkSession.range(1).select(), [], set(), True)
        for e in group.filters:
            out = _Bindings(out.df.where(self.truth(e, out.names)), out.names, out.loose, out.bounded)
        return out

    def truth(self, e, names: list[str]) -> Column:
        return _Expressions({n: F.col(_column(n)) for n in names}).of(e).truth()

    @staticmethod
    def next_pattern(pending: list[Pattern], bound: list[str]) -> int:
        """The pattern to join next: connected, then the most constants (a constant object counts double), then as written."""

        def weight(x: Pattern) -> tuple:
            names = {t.name for t in (x.s, x.p, x.o) if isinstance(t, Var)}
            constants = sum(isinstance(t, Term) for t in (x.s, x.p, x.o)) + isinstance(x.o, Term)
            return (bool(names & set(bound)) or not bound, constants + len(names & set(bound)))

        return max(range(len(pending)), key=lambda i: (weight(pending[i]), -i))

    def reached(self, x: Pattern, graph: Var | Term | None) -> DataFrame:
        """(g, s, p, o) of the pairs that a path joins, each once.

        Semi-naive: a round joins the pairs that the last one found with the edges, and keeps
        those that are new; a cycle ends it as does a last edge.  From a constant end only what
        can be reached from there is followed.  Each round is a table in the shared folder.
        """
        from quadrel.sources.sinks import scratch

        if isinstance(graph, Var):
            raise SparqlError("a path within a graph that is a variable")
        quads = self.quads if graph is None else self.quads.where(F.col("g") == graph.value)
        spark = quads.sparkSession

        def kept(df: DataFrame) -> DataFrame:
            path = scratch(spark, "path")
            df.write.parquet(path)
            return spark.read.schema("a string, b string").parquet(path)

        backward = isinstance(x.o, Term) and not isinstance(x.s, Term)
        start, end = ("o", "s") if backward else ("s", "o")
        edges = kept(quads.where(F.col("p") == x.p.term.value).select(F.col(start).alias("a"), F.col(end).alias("b")).distinct())
        fixed = x.o if backward else x.s
        found = new = edges.where(F.col("a") == fixed.value) if isinstance(fixed, Term) else edges
        step = edges.select(F.col("a").alias("b"), F.col("b").alias("c"))
        while not new.isEmpty():
            further = new.join(step, "b").select("a", F.col("c").alias("b")).distinct()
            new = kept(further.join(found, ["a", "b"], "left_anti"))
            found = found.unionByName(new)
        if x.p.empty:
            ends = [F.lit(t.value) for t in (x.s, x.o) if isinstance(t, Term)]
            every = quads.select(F.explode(F.array("s", "o")).alias("a")) if not ends else spark.range(1).select(F.explode(F.array(*ends)).alias("a"))
            found = found.unionByName(every.distinct().select("a", F.col("a").alias("b"))).distinct()
        return found.select(F.lit("").alias("g"), F.col("a").alias(start), F.lit(x.p.term.value).alias("p"), F.col("b").alias(end))

    def scan(self, x: Pattern, graph: Var | Term | None) -> _Bindings:
        df = self.quads
        if isinstance(x.p, Path):
            df, graph = self.reached(x, graph), None
        parts = [("s", x.s), ("p", x.p), ("o", x.o)]
        if isinstance(graph, Term):
            df = df.where(F.col("g") == graph.value)
        for c, t in parts:
            if isinstance(t, Term):
                df = df.where(F.col(c) == t.value)
        if isinstance(graph, Var):
            parts = [("g", graph), *parts]
        seen: dict[str, str] = {}
        for c, t in parts:
            if isinstance(t, Var):
                if t.name in seen:
                    df = df.where(F.col(c) == F.col(seen[t.name]))
                else:
                    seen[t.name] = c
        if graph is None and not self.unique and not self.as_set and not isinstance(x.p, Path):
            df = df.select("s", "p", "o").distinct()
        # A pattern without variables is one triple or none.
        return _Bindings(df.select(*[F.col(c).alias(_column(n)) for n, c in seen.items()]), list(seen), set(), not seen)

    def values(self, x: Values) -> _Bindings:
        """Inline rows; as many as the query's text has."""
        schema = ", ".join(f"{_column(n)} string" for n in x.names)
        df = self.quads.sparkSession.createDataFrame([tuple(r) for r in x.rows], schema)
        return _Bindings(F.broadcast(df), list(x.names), {n for i, n in enumerate(x.names) if any(r[i] is None for r in x.rows)}, True)

    def shared(self, a: _Bindings, b: _Bindings) -> list[str]:
        names = [n for n in a.names if n in b.names]
        if loose := [n for n in names if n in a.loose or n in b.loose]:
            raise SparqlError(f"join on ?{loose[0]}, which may be unbound")
        return names

    def join(self, a: _Bindings, b: _Bindings) -> _Bindings:
        if a.df is None:
            return b
        names = self.shared(a, b)
        if names:
            df = a.df.join(b.df, [_column(n) for n in names])
        else:
            self.refuse_product(a, b)
            df = a.df.join(b.df)
        return _Bindings(df, [*a.names, *(n for n in b.names if n not in a.names)], a.loose | b.loose, a.bounded and b.bounded)

    @staticmethod
    def refuse_product(a: _Bindings, b: _Bindings) -> None:
        if not (a.bounded or b.bounded):
            raise SparqlError(f"no variable joins {a.names} with {b.names}")

    def optional(self, a: _Bindings, group: Group, graph: Var | Term | None) -> _Bindings:
        inner = self.group(Group(group.elements, []), graph, _Bindings(None, [], set()))
        if a.df is None:
            return inner
        names = self.shared(a, inner)
        if not names:
            self.refuse_product(a, inner)
        new = [n for n in inner.names if n not in a.names]
        right = inner.df.select(*[F.col(_column(n)).alias(f"o_{n}") for n in inner.names])
        condition = F.lit(True)
        for n in names:
            condition = condition & (F.col(_column(n)) == F.col(f"o_{n}"))
        bound = {n: F.col(_column(n)) for n in a.names} | {n: F.col(f"o_{n}") for n in new}
        for e in group.filters:
            condition = condition & F.coalesce(_Expressions(bound).of(e).truth(), F.lit(False))
        df = a.df.join(right, condition, "left")
        df = df.select(*[_column(n) for n in a.names], *[F.col(f"o_{n}").alias(_column(n)) for n in new])
        return _Bindings(df, [*a.names, *new], {*a.loose, *inner.loose, *new})

    def minus(self, a: _Bindings, group: Group, graph: Var | Term | None) -> _Bindings:
        inner = self.group(group, graph, _Bindings(None, [], set()))
        names = self.shared(a, inner)
        if not names:
            return a
        keys = [_column(n) for n in names]
        return _Bindings(a.df.join(inner.df.select(*keys), keys, "left_anti"), a.names, a.loose)

    def union(self, parts: list[_Bindings]) -> _Bindings:
        names = list(dict.fromkeys(n for p in parts for n in p.names))
        loose = {n for n in names if any(n not in p.names or n in p.loose for p in parts)}
        rows = [p.df.select(*[(F.col(_column(n)) if n in p.names else F.lit(None).cast("string")).alias(_column(n)) for n in names]) for p in parts]
        df = rows[0]
        for r in rows[1:]:
            df = df.unionByName(r)
        return _Bindings(df, names, loose, all(p.bounded for p in parts))


def _has_aggregate(e) -> bool:
    return isinstance(e, Call) and (e.name == "AGG" or any(_has_aggregate(x) for x in e.args))


def select(quads: DataFrame, text: str, unique: bool = False, statistics: Statistics | None = None) -> DataFrame:
    """The result of a SELECT over ``quads(g, s, p, o)``; with ``statistics``, patterns are joined in the order that they suggest."""
    return Compiler(quads, unique, statistics).select(text)
