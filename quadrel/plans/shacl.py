"""SHACL shapes compiled to DataFrames, all shapes at once.

Shapes are read on the driver (they are a few hundred at most) into three small tables:
targets, property shapes and constraints.  Each *component* is then evaluated once for
all shapes: the focus nodes of all targets are found with one pass over the quads, their
values with one join, and the checks of a component with one join against its parameter
table.  Validation is of each graph for itself; no inference is made.

Reusable shapes (``sh:node``) and alternatives (``sh:or``) are evaluated as sets of
violating nodes: a node violates an alternative if it is in every member's set.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrel.functions import terms as T
from quadrel.sources.turtle import parse

SH = "http://www.w3.org/ns/shacl#"


@dataclass
class Constraint:
    """A component with its parameter: an IRI, a number, a shape, or a list of shapes."""

    component: str
    value: object


@dataclass
class Shape:
    ident: str
    path: str | None = None
    constraints: list[Constraint] = field(default_factory=list)
    properties: list[Shape] = field(default_factory=list)
    targets: list[tuple[str, str]] = field(default_factory=list)
    severity: str = "Violation"
    message: str = ""


_TARGETS = {"targetClass": "class", "targetSubjectsOf": "subjects", "targetObjectsOf": "objects", "targetNode": "node"}
_NUMBERS = ("minCount", "maxCount", "minInclusive", "maxInclusive", "minExclusive", "maxExclusive", "minLength", "maxLength")


class ShapeReader:
    """Shapes from the triples of a shapes graph; statements on one shape are merged, whatever their order."""

    def __init__(self, text: str):
        self.of: dict[str, list[tuple[str, str]]] = {}
        for s, p, o in dict.fromkeys(parse(text).triples):
            self.of.setdefault(s, []).append((p[1:-1], o))
        self.done: dict[str, Shape] = {}

    def items(self, node: str) -> list[str]:
        out = []
        while node != f"<{T.RDF}nil>":
            pairs = dict(self.of[node])
            out.append(pairs[T.RDF + "first"])
            node = pairs[T.RDF + "rest"]
        return out

    def shape(self, ident: str) -> Shape:
        if ident in self.done:
            return self.done[ident]
        out = self.done[ident] = Shape(ident)
        number = lambda o: float(o[1 : o.rindex('"')])
        for p, o in self.of.get(ident, []):
            name = p.removeprefix(SH) if p.startswith(SH) else ""
            if name in _TARGETS:
                out.targets.append((_TARGETS[name], o))
            elif name == "path":
                out.path = o
            elif name == "property":
                out.properties.append(self.shape(o))
            elif name == "message":
                out.message = o[1 : o.rindex('"')]
            elif name == "severity":
                out.severity = o[1:-1].removeprefix(SH)
            elif name == "node":
                out.constraints.append(Constraint("node", self.shape(o)))
            elif name in ("or", "and"):
                members = [self.shape(x) for x in self.items(o)]
                out.constraints += [Constraint("or", members)] if name == "or" else [Constraint("node", m) for m in members]
            elif name == "not":
                out.constraints.append(Constraint("not", self.shape(o)))
            elif name == "in":
                out.constraints.append(Constraint("in", self.items(o)))
            elif name in _NUMBERS:
                out.constraints.append(Constraint(name, number(o)))
            elif name in ("class", "datatype", "nodeKind"):
                out.constraints.append(Constraint(name, o[1:-1]))
            elif name == "hasValue":
                out.constraints.append(Constraint(name, o))
            elif name == "pattern":
                out.constraints.append(Constraint(name, o[1 : o.rindex('"')]))
            elif name and name not in ("name", "description", "order", "group", "deactivated"):
                raise ValueError(f"no such component: sh:{name}")
        return out

    def targeted(self) -> list[Shape]:
        """All shapes with a target."""
        for ident in list(self.of):
            pairs = self.of[ident]
            if any(p.startswith(SH) and p.removeprefix(SH) in _TARGETS for p, _ in pairs):
                self.shape(ident)
        return [s for s in self.done.values() if s.targets]


def read_shapes(text: str) -> list[Shape]:
    return ShapeReader(text).targeted()


def alternatives(c: Constraint, component: str) -> set[str]:
    """The classes or datatypes of which the constraint asks for one; empty if it isn't of that form."""
    if c.component == component:
        return {c.value}
    if c.component not in ("node", "or"):
        return set()
    out: set[str] = set()
    for s in c.value if c.component == "or" else [c.value]:
        found = alternatives(s.constraints[0], component) if len(s.constraints) == 1 and not s.properties and s.path is None else set()
        if not found:
            return set()
        out |= found
    return out


REPORT = ["g", "shape", "focus", "path", "value", "component", "severity", "message"]


class Validator:
    """Evaluates shapes over ``quads(g, s, p, o)``."""

    def __init__(self, quads: DataFrame):
        self.quads = quads
        self.spark: SparkSession = quads.sparkSession
        self.types = quads.where(F.col("p") == T.TYPE).select("g", F.col("s").alias("value"), F.col("o").alias("class")).distinct().persist()

    def table(self, rows: list[tuple], schema: str) -> DataFrame:
        """Rows of the shapes' text, a few hundred at most."""
        return F.broadcast(self.spark.createDataFrame(rows, schema))

    def focus(self, shapes: list[Shape]) -> DataFrame:
        """(g, shape, focus) of all targets, each once."""
        rows = [(s.ident, kind, x) for s in shapes for kind, x in s.targets]
        of = lambda kind: [(s, x) for s, k, x in rows if k == kind]
        parts = []
        if by := of("class"):
            parts.append(self.types.join(self.table([(s, x) for s, x in by], "shape string, class string"), "class").select("g", "shape", F.col("value").alias("focus")))
        for kind, column in (("subjects", "s"), ("objects", "o")):
            if by := of(kind):
                found = self.quads.where(F.col("p").isin(sorted({x for _, x in by}))).join(self.table(by, "shape string, p string"), "p")
                parts.append(found.select("g", "shape", F.col(column).alias("focus")))
        if by := of("node"):
            graphs = self.quads.select("g").distinct()
            parts.append(graphs.join(self.table(by, "shape string, focus string")))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.distinct()

    def violators(self, nodes: DataFrame, shape: Shape) -> DataFrame:
        """(g, value) of those of ``nodes(g, value)`` that don't conform to a shape used as a test."""
        parts = []
        for c in shape.constraints:
            bad = self.value_violations(nodes.withColumn("key", F.lit(0)), c.component, [(0, c.value)])
            parts.append(bad.select("g", "value"))
        for prop in shape.properties:
            report = self.properties(nodes.select("g", F.col("value").alias("focus")).withColumn("shape", F.lit(shape.ident)), [(shape.ident, prop)])
            parts.append(report.select("g", F.col("focus").alias("value")))
        if not parts:
            return nodes.where("false")
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.distinct()

    def value_violations(self, values: DataFrame, component: str, parameters: list[tuple[int, object]]) -> DataFrame:
        """Rows of ``values(key, g, value, ...)`` that violate a component; ``parameters`` has its values by key."""
        if component == "class":
            wanted = values.join(self.table([(k, f"<{v}>") for k, v in parameters], "key int, class string"), "key")
            return wanted.join(self.types, ["g", "value", "class"], "left_anti").drop("class")
        if component == "datatype":
            wanted = values.join(self.table(parameters, "key int, datatype string"), "key")
            value = F.col("value")
            good = (T.datatype(value) == F.col("datatype")) & T.valid_lexical(value)
            return wanted.where(~F.coalesce(good, F.lit(False))).drop("datatype")
        if component in _NUMBERS[2:6]:
            wanted = values.join(self.table([(k, float(v)) for k, v in parameters], "key int, bound double"), "key")
            n, bound = T.number(F.col("value")), F.col("bound")
            good = {"minInclusive": n >= bound, "maxInclusive": n <= bound, "minExclusive": n > bound, "maxExclusive": n < bound}[component]
            return wanted.where(~F.coalesce(good, F.lit(False))).drop("bound")
        if component in ("minLength", "maxLength"):
            wanted = values.join(self.table([(k, float(v)) for k, v in parameters], "key int, bound double"), "key")
            n = F.char_length(T.lexical(F.col("value")))
            good = n >= F.col("bound") if component == "minLength" else n <= F.col("bound")
            return wanted.where(~F.coalesce(good, F.lit(False))).drop("bound")
        if component == "pattern":
            wanted = values.join(self.table(parameters, "key int, pattern string"), "key")
            return wanted.where(~F.coalesce(F.regexp_like(T.lexical(F.col("value")), F.col("pattern")), F.lit(False))).drop("pattern")
        if component == "nodeKind":
            wanted = values.join(self.table([(k, str(v).removeprefix(SH)) for k, v in parameters], "key int, kind string"), "key")
            v, kind = F.col("value"), F.col("kind")
            good = (T.is_iri(v) & kind.contains("IRI")) | (T.is_blank(v) & kind.contains("BlankNode")) | (T.is_literal(v) & kind.contains("Literal"))
            return wanted.where(~good).drop("kind")
        if component == "in":
            wanted = values.join(self.table([(k, x) for k, v in parameters for x in v], "key int, member string"), "key")
            listed = wanted.where(F.col("value") == F.col("member")).select("key", "g", "value").distinct()
            return values.join(self.table([(k,) for k, _ in parameters], "key int"), "key").join(listed, ["key", "g", "value"], "left_anti")
        if component in ("node", "or", "not"):
            out = None
            # One evaluation for each distinct test, however many shapes use it.
            tests: dict[tuple, list[int]] = {}
            for k, v in parameters:
                tests.setdefault(tuple(s.ident for s in v) if isinstance(v, list) else (v.ident,), []).append(k)
            shapes = {(tuple(s.ident for s in v) if isinstance(v, list) else (v.ident,)): v for _, v in parameters}
            for test, keys in tests.items():
                mine = values.where(F.col("key").isin(keys))
                nodes = mine.select("g", "value").distinct()
                members = shapes[test] if isinstance(shapes[test], list) else [shapes[test]]
                bad = nodes
                for m in members:
                    bad = self.violators(bad, m)
                part = mine.join(bad, ["g", "value"], "left_anti" if component == "not" else "left_semi").select(*values.columns)
                out = part if out is None else out.unionByName(part)
            return out
        raise ValueError(f"no such component: {component}")

    def checked(self, values: DataFrame, owners: list[tuple[int, Shape]]) -> list[DataFrame]:
        """Violations of the value components of ``owners``, by key.

        Tests that come down to a set of classes, of which a value needs one, or a set of
        datatypes are evaluated together, whatever component they are written with.
        """
        out = []
        classes, datatypes, others = [], [], {}
        for key, shape in owners:
            for use, c in enumerate(shape.constraints):
                if c.component in ("minCount", "maxCount", "hasValue"):
                    continue
                if found := alternatives(c, "class"):
                    classes += [(key, use, c.component, f"<{x}>") for x in sorted(found)]
                elif found := alternatives(c, "datatype"):
                    datatypes.append((key, c.component, sorted(found)))
                else:
                    others.setdefault((c.component, sum(x.component == c.component for x in shape.constraints[:use])), []).append((key, c.value))
        if classes:
            uses = self.table(sorted({x[:3] for x in classes}), "key int, use int, component string")
            members = self.table([(k, u, x) for k, u, _, x in classes], "key int, use int, class string")
            kept = values.join(members, "key").join(self.types, ["g", "value", "class"]).select("key", "use", "g", "value").distinct()
            out.append(values.join(uses, "key").join(kept, ["key", "use", "g", "value"], "left_anti").drop("use"))
        if datatypes:
            wanted = values.join(self.table(datatypes, "key int, component string, datatypes array<string>"), "key")
            good = F.array_contains("datatypes", T.datatype(F.col("value"))) & T.valid_lexical(F.col("value"))
            out.append(wanted.where(~F.coalesce(good, F.lit(False))).drop("datatypes"))
        for (name, _), parameters in sorted(others.items(), key=lambda x: x[0]):
            out.append(self.value_violations(values, name, parameters).withColumn("component", F.lit(name)))
        return out

    def properties(self, focus: DataFrame, owned: list[tuple[str, Shape]]) -> DataFrame:
        """Violations (g, shape, focus, path, value, component, severity, message) of property shapes, by their node shapes' focus nodes."""
        keyed = list(enumerate(p for _, p in owned))
        table = self.table(
            [(k, shape, p.path, p.severity, p.message) for (k, p), (shape, _) in zip(keyed, owned, strict=True)],
            "key int, shape string, path string, severity string, message string",
        )
        wanted = focus.join(table, "shape")
        paths = sorted({p.path for _, p in keyed})
        values = self.quads.where(F.col("p").isin(paths)).select("g", F.col("s").alias("focus"), F.col("p").alias("path"), F.col("o").alias("value")).distinct()
        joined = wanted.join(values, ["g", "focus", "path"], "left").persist()
        out = []
        bounds = [(k, c.component, c.value) for k, p in keyed for c in p.constraints if c.component in ("minCount", "maxCount")]
        if bounds:
            counts = joined.groupBy("key", "g", "shape", "focus", "path", "severity", "message").agg(F.count("value").alias("n"))
            checks = counts.join(self.table(bounds, "key int, component string, bound double"), "key")
            bad = checks.where(((F.col("component") == "minCount") & (F.col("n") < F.col("bound"))) | ((F.col("component") == "maxCount") & (F.col("n") > F.col("bound"))))
            out.append(bad.withColumn("value", F.lit(None).cast("string")))
        out += self.checked(joined.where("value IS NOT NULL"), keyed)
        has = [(k, c.value) for k, p in keyed for c in p.constraints if c.component == "hasValue"]
        if has:
            need = wanted.join(self.table(has, "key int, value string"), "key")
            out.append(need.join(values, ["g", "focus", "path", "value"], "left_anti").withColumn("component", F.lit("hasValue")).withColumn("value", F.lit(None).cast("string")))
        if not out:
            return wanted.where("false").withColumns({"value": F.lit(None).cast("string"), "component": F.lit("")}).select(*REPORT)
        whole = out[0].select(*REPORT)
        for x in out[1:]:
            whole = whole.unionByName(x.select(*REPORT))
        return whole

    def report(self, shapes: list[Shape], only: DataFrame | None = None) -> DataFrame:
        """All results, one row each; with ``only``, those of its (g, focus) alone."""
        if not shapes:
            return self.spark.createDataFrame([], ", ".join(f"{c} string" for c in REPORT))
        focus = self.focus(shapes)
        focus = (focus if only is None else focus.join(only, ["g", "focus"], "left_semi")).persist()
        parts = []
        owners = list(enumerate(s for s in shapes if s.constraints))
        if owners:
            table = self.table([(k, s.ident, s.severity, s.message) for k, s in owners], "key int, shape string, severity string, message string")
            values = focus.join(table, "shape").withColumn("value", F.col("focus")).withColumn("path", F.lit(None).cast("string"))
            parts += self.checked(values.persist(), owners)
        owned = [(s.ident, p) for s in shapes for p in s.properties]
        if owned:
            parts.append(self.properties(focus, owned))
        whole = parts[0].select(*REPORT)
        for x in parts[1:]:
            whole = whole.unionByName(x.select(*REPORT))
        return whole


def validate(quads: DataFrame, shapes: str | list[Shape]) -> DataFrame:
    """The report of ``quads(g, s, p, o)`` against shapes (Turtle text, or read before)."""
    return Validator(quads).report(read_shapes(shapes) if isinstance(shapes, str) else shapes)


def _held(c: Constraint) -> list[Shape]:
    """The shapes within a constraint."""
    inner = c.value if isinstance(c.value, (list, tuple)) else [c.value]
    return [x for x in inner if isinstance(x, Shape)]


def reach(shape: Shape) -> int:
    """How many steps from a focus node the triples are, at most, that a shape's results depend on."""
    return max([0, *(reach(x) for c in shape.constraints for x in _held(c)), *(1 + reach(p) for p in shape.properties)])


def _paths(shape: Shape) -> set[str]:
    return ({shape.path} if shape.path else set()).union(*(_paths(p) for p in shape.properties), *(_paths(x) for c in shape.constraints for x in _held(c)))


def affected(old: DataFrame, new: DataFrame, shapes: list[Shape]) -> DataFrame:
    """(g, focus): the nodes whose results can differ between two versions of graphs.

    These are the ends of the triples that were added or removed, and what leads to such an
    end, before or after, along the shapes' paths, as many steps as the shapes look ahead;
    in a graph that changed, also the nodes that shapes name.
    """
    from quadrel.sources.sinks import scratch

    def kept(df: DataFrame) -> DataFrame:
        path = scratch(df.sparkSession, "affected")
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    columns = ["g", "s", "p", "o"]
    before, after = (df.select(*columns).distinct() for df in (old, new))
    changed = kept(before.join(after, columns, "left_anti").unionByName(after.join(before, columns, "left_anti")))
    near = changed.select("g", F.explode(F.array("s", "o")).alias("focus"))
    named = sorted({x for s in shapes for kind, x in s.targets if kind == "node"})
    if named:
        near = near.unionByName(changed.select("g").distinct().select("g", F.explode(F.array(*map(F.lit, named))).alias("focus")))
    near = kept(near.distinct())
    paths = sorted(set().union(*map(_paths, shapes)))
    edges = before.unionByName(after).where(F.col("p").isin(paths)).select("g", "s", F.col("o").alias("focus"))
    for _ in range(max([0, *map(reach, shapes)])):
        near = kept(near.unionByName(edges.join(near, ["g", "focus"], "left_semi").select("g", F.col("s").alias("focus"))).distinct())
    return near


def revalidate(old: DataFrame, new: DataFrame, report: DataFrame, shapes: str | list[Shape]) -> DataFrame:
    """The report of ``new``, from that of ``old``: only the nodes that a change can concern are looked at again.

    What is read besides the changed triples are the graphs that have some.  ``report`` and the
    quads are read more than once: written tables, or versions of a store.
    """
    shapes = read_shapes(shapes) if isinstance(shapes, str) else shapes
    only = affected(old, new, shapes)
    graphs = only.select("g").distinct()
    again = Validator(new.join(graphs, "g", "left_semi")).report(shapes, only)
    return report.join(only, ["g", "focus"], "left_anti").select(*REPORT).unionByName(again.select(*REPORT))


def unknown_types(quads: DataFrame, ontology: DataFrame, namespaces: list[str]) -> DataFrame:
    """(g, s, class): types in the given namespaces that the ontology doesn't define as classes."""
    classes = ontology.where((F.col("p") == T.TYPE) & F.col("o").isin(f"<{T.OWL}Class>", f"<{T.RDFS}Class>")).select(F.col("s").alias("class")).distinct()
    inside = F.lit(False)
    for n in namespaces:
        inside = inside | F.col("class").startswith(f"<{n}")
    found = quads.where(F.col("p") == T.TYPE).select("g", "s", F.col("o").alias("class")).where(inside & (F.col("class") != f"<{T.OWL}NamedIndividual>"))
    return found.distinct().join(classes, "class", "left_anti").select("g", "s", "class")


def verdicts(graphs: DataFrame, report: DataFrame, unknown: DataFrame | None = None, errors: DataFrame | None = None) -> DataFrame:
    """(g, violations, warnings, unknown, conforms) of each graph of ``graphs(g)``; warnings don't fail, errors do."""
    counts = report.groupBy("g").agg(
        F.count_if(F.col("severity") == "Violation").alias("violations"), F.count_if(F.col("severity") != "Violation").alias("warnings")
    )
    out = graphs.select("g").distinct().join(counts, "g", "left").fillna(0, ["violations", "warnings"])
    if unknown is not None:
        out = out.join(unknown.groupBy("g").agg(F.count_distinct("class").alias("unknown")), "g", "left").fillna(0, ["unknown"])
    else:
        out = out.withColumn("unknown", F.lit(0).cast("long"))
    good = (F.col("violations") == 0) & (F.col("unknown") == 0)
    if errors is not None:
        out = out.join(errors.select("g").distinct().withColumn("error", F.lit(True)), "g", "left")
        return out.withColumn("conforms", good & F.col("error").isNull()).drop("error")
    return out.withColumn("conforms", good)


def rendered(report: DataFrame) -> DataFrame:
    """(g, text): each graph's results as text, a line each, ordered by focus, path, component and value."""
    line = F.concat_ws(" | ", *[F.coalesce(F.col(c), F.lit("-")) for c in ("severity", "focus", "path", "component", "value", "message")])
    order = F.struct(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("focus", "path", "component", "value")], line.alias("line"))
    return report.groupBy("g").agg(F.array_join(F.transform(F.sort_array(F.collect_list(order)), lambda x: x["line"]), "\n").alias("text"))
