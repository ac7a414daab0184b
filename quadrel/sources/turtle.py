"""Turtle text with quoted-triple annotations: reading, splitting and writing.

Files are read whole and parsed in parallel, one file a row.  Annotation lines, which
begin with ``<<``, are told from the rest line by line with built-in functions.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrel.functions.terms import RDF, TYPE, XSD

PROV_DERIVED = "http://www.w3.org/ns/prov#wasDerivedFrom"
DCT_SOURCE = "http://purl.org/dc/terms/source"

_TOKEN = re.compile(
    r"""(?P<skip>\s+|\#[^\n]*)
      | (?P<iri><(?!<)[^<>"{}|^`\\\x00-\x20]*>)
      | (?P<long>\"{3}(?:[^"\\]|\\.|"(?!""))*\"{3}|'{3}(?:[^'\\]|\\.|'(?!''))*'{3})
      | (?P<text>"(?:[^"\\\n]|\\.)*"|'(?:[^'\\\n]|\\.)*')
      | (?P<lang>@[A-Za-z]+(?:-[A-Za-z0-9]+)*)
      | (?P<number>[+-]?(?:\d+\.\d+|\.\d+|\d+)(?:[eE][+-]?\d+)?)(?![\w:])
      | (?P<blank>_:[\w.-]*[\w-])
      | (?P<name>(?:[^\W\d_][\w.-]*)?:(?:(?:[\w:%-]|\\.|\.(?=[\w:%-]))*)|true\b|false\b|a(?=[\s<]))
      | (?P<word>PREFIX\b|BASE\b)
      | (?P<mark>\^\^|<<|>>|\{\||\|\}|[;,.\[\](){}])""",
    re.X | re.I,
)
_ESCAPE = re.compile(r"\\(?:([tbnrf\"'\\])|u([0-9A-Fa-f]{4})|U([0-9A-Fa-f]{8}))")
_PLAIN = {"t": "\t", "b": "\b", "n": "\n", "r": "\r", "f": "\f", '"': '"', "'": "'", "\\": "\\"}


class TurtleError(ValueError):
    """The text isn't Turtle as far as it is read here."""


def unescape(text: str) -> str:
    if "\\" not in text:
        return text
    return _ESCAPE.sub(lambda m: _PLAIN[m[1]] if m[1] else chr(int(m[2] or m[3], 16)), text)


def tokens(text: str) -> Iterator[tuple[str, str]]:
    at = 0
    while at < len(text):
        m = _TOKEN.match(text, at)
        if not m:
            raise TurtleError(f"unexpected text at {at}: {text[at : at + 40]!r}")
        at = m.end()
        if m.lastgroup != "skip":
            yield m.lastgroup, m[0]
    yield "end", ""


class Parser:
    """Recursive-descent reader of one document; blank nodes are named by ``scope`` and their label, or ``mark`` and their order."""

    def __init__(self, text: str, scope: str = "b", base: str = "", prefixes: dict[str, str] | None = None, mark: str = ""):
        self.items = list(tokens(text))
        self.at = 0
        self.scope, self.base, self.prefixes, self.mark = scope, base, dict(prefixes or {}), mark
        self.triples: list[tuple[str, str, str]] = []
        self.annotations: list[tuple[str, str, str, str, str]] = []
        self.blanks = 0

    def take(self, wanted: str | None = None) -> tuple[str, str]:
        item = self.items[self.at]
        if wanted is not None and item[1] != wanted:
            raise TurtleError(f"expected {wanted!r}, found {item[1]!r}")
        self.at += 1
        return item

    def peek(self) -> tuple[str, str]:
        return self.items[self.at]

    def blank(self) -> str:
        self.blanks += 1
        return f"_:{self.scope}.{self.mark}{self.blanks}"

    def document(self) -> Parser:
        while self.peek()[0] != "end":
            kind, text = self.peek()
            if kind == "lang" and text.lower() in ("@prefix", "@base") or kind == "word":
                self.take()
                if text.lower().endswith("prefix"):
                    name = self.take()[1]
                    self.prefixes[name[:-1]] = self.resolve(self.take()[1])
                else:
                    self.base = self.resolve(self.take()[1])
                if kind == "lang":
                    self.take(".")
                continue
            if text == "<<":
                self.annotation()
            else:
                subject = self.subject()
                if self.peek()[1] != ".":
                    self.predicates(subject)
            self.take(".")
        return self

    def resolve(self, reference: str) -> str:
        found = unescape(reference[1:-1])
        return urljoin(self.base, found) if self.base and not re.match(r"[A-Za-z][\w+.-]*:", found) else found

    def named(self, name: str) -> str:
        prefix, _, local = name.partition(":")
        if prefix not in self.prefixes:
            raise TurtleError(f"no such prefix: {prefix!r}")
        return self.prefixes[prefix] + re.sub(r"\\(.)", r"\1", local)

    def subject(self) -> str:
        return self.term(subject=True)

    def term(self, subject: bool = False) -> str:
        kind, text = self.take()
        if kind == "iri":
            return f"<{self.resolve(text)}>"
        if kind == "blank":
            return f"_:{self.scope}.l-{text[2:]}"  # a label may be a number too
        if text == "[":
            node = self.blank()
            if self.peek()[1] != "]":
                self.predicates(node)
            self.take("]")
            return node
        if text == "(":
            return self.collection()
        if kind == "name" and text in ("true", "false") and not subject:
            return f'"{text}"^^{XSD}boolean'
        if kind == "name":
            return f"<{self.named(text)}>"
        if subject:
            raise TurtleError(f"not a subject: {text!r}")
        if kind == "number":
            suffix = "double" if "e" in text.lower() else "decimal" if "." in text else "integer"
            return f'"{text}"^^{XSD}{suffix}'
        if kind in ("text", "long"):
            value = unescape(text[3:-3] if kind == "long" else text[1:-1])
            following, more = self.peek()
            if following == "lang":
                self.take()
                return f'"{value}"{more.lower()}'
            if more == "^^":
                self.take()
                datatype = self.term()[1:-1]
                return f'"{value}"' if datatype == XSD + "string" else f'"{value}"^^{datatype}'
            return f'"{value}"'
        raise TurtleError(f"not a term: {text!r}")

    def collection(self) -> str:
        members = []
        while self.peek()[1] != ")":
            members.append(self.term())
        self.take(")")
        head = f"<{RDF}nil>"
        for member in reversed(members):
            node = self.blank()
            self.triples += [(node, f"<{RDF}first>", member), (node, f"<{RDF}rest>", head)]
            head = node
        return head

    def predicate(self) -> str:
        if self.peek()[1] == "a":
            self.take()
            return TYPE
        return self.term(subject=True)

    def predicates(self, subject: str) -> None:
        while True:
            predicate = self.predicate()
            while True:
                self.triples.append((subject, predicate, self.term()))
                if self.peek()[1] != ",":
                    break
                self.take()
            while self.peek()[1] == ";":
                self.take()
                if self.peek()[1] in (".", "]", ";"):
                    continue
            if self.items[self.at - 1][1] != ";" or self.peek()[1] in (".", "]"):
                return

    def annotation(self) -> None:
        self.take("<<")
        quoted = (self.subject(), self.predicate(), self.term())
        self.take(">>")
        held = self.triples
        self.triples = []
        self.predicates("_:annotation")
        found = self.triples
        self.triples = held
        source = next((o for _, p, o in found if p == f"<{DCT_SOURCE}>"), None)
        for _, p, o in found:
            if p == f"<{PROV_DERIVED}>":
                self.annotations.append((*quoted, o, source))


def parse(text: str, scope: str = "b", base: str = "") -> Parser:
    """Triples (in order, repeats included) and annotations of one document."""
    return Parser(text, scope, base).document()


def is_annotation_line(line: Column) -> Column:
    """The validator's rule: the line begins with ``<<``."""
    return F.ltrim(line).startswith("<<")


def is_annotation_line_for_repair(line: Column) -> Column:
    """The repair rule: as above, or the line ends a quoted triple and states a provenance."""
    return is_annotation_line(line) | (line.contains(">>") & line.contains("prov:wasDerivedFrom"))


def strip_annotations(text: Column, repair: bool = False) -> Column:
    """Text without its annotation lines."""
    rule = is_annotation_line_for_repair if repair else is_annotation_line
    return F.array_join(F.filter(F.split(text, "\n", -1), lambda line: ~rule(line)), "\n")


def extract_annotations(text: Column) -> Column:
    """array<string> of a text's annotation lines."""
    return F.filter(F.split(text, "\n", -1), is_annotation_line)


def quoted_triple(line: Column) -> Column:
    """struct<s, p, o> as written in an annotation line; null if it holds none."""
    part = r"(<[^<>\s]+>|_:[\w.-]+|[\w.-]*:[^\s]+)"
    shape = rf'^\s*<<\s*{part}\s+{part}\s+(.+?)\s*>>'
    return F.when(line.rlike(shape), F.struct(*[F.regexp_extract(line, shape, i + 1).alias(c) for i, c in enumerate("spo")]))


def graph_name(file_name: Column, namespace: str) -> Column:
    """Graph IRI of a file: the namespace and the lower-case stem."""
    return F.concat(F.lit(namespace), F.lower(F.regexp_replace(file_name, r"\.[^.]*$", "")))


def plain_name(name: Column) -> Column:
    """A file's name as it was given, without the escapes of a path."""
    return F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))


def read_documents(spark: SparkSession, path: str, glob: str = "*.ttl", namespace: str = "urn:graph:") -> DataFrame:
    """(g, file, text) of the files below ``path`` that match ``glob`` and don't begin with two underscores."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob).select("value", plain_name(F.col("_metadata.file_name")).alias("file"))
    return files.where(~F.col("file").startswith("__")).select(graph_name(F.col("file"), namespace).alias("g"), "file", F.col("value").alias("text"))


def read_existing(spark: SparkSession, paths: list[str], namespace: str = "urn:graph:") -> DataFrame:
    """(g, file, text) of those of the files that are there."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    there = [p for p in paths if (q := jvm.org.apache.hadoop.fs.Path(p)).getFileSystem(conf).exists(q)]
    if not there:
        return spark.createDataFrame([], "g string, file string, text string")
    files = spark.read.text(there, wholetext=True).select("value", plain_name(F.col("_metadata.file_name")).alias("file"))
    return files.select(graph_name(F.col("file"), namespace).alias("g"), "file", F.col("value").alias("text"))


def chosen_files(argument: str | None, named: str | None, folder: str) -> tuple[str, str]:
    """(path, glob) of the files to read: one file given as an argument, else the one that the environment names, else the folder's Turtle files."""
    for one in (argument, named):
        if one and one.strip():
            head, _, tail = one.strip().replace("\\", "/").rpartition("/")
            return head or ".", tail
    return folder, "*.ttl"


def parse_documents(documents: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Quads (a set), annotations (repeats kept) and errors (g, error) of documents (g, text).

    A document that can't be parsed gives an error row and nothing else.
    """

    def run(batches):
        for b in batches:
            rows = []
            for g, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    found = parse(text or "", scope=(g or "").rsplit("/", 1)[-1], base=g or "")
                except (TurtleError, IndexError) as e:
                    rows.append(("error", g, None, None, None, str(e), None))
                    continue
                rows += [("quad", g, *t, None, None) for t in dict.fromkeys(found.triples)]
                rows += [("annotation", g, *a) for a in found.annotations]
            for at in range(0, len(rows), 50_000):
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows[at : at + 50_000], strict=True)], names=_ROWS)

    parsed = documents.select("g", "text").mapInArrow(run, ", ".join(f"{c} string" for c in _ROWS))
    of = lambda kind: parsed.where(F.col("kind") == kind)
    return of("quad").select("g", "s", "p", "o"), of("annotation").drop("kind"), of("error").select("g", F.col("evidence").alias("error"))


_ROWS = ["kind", "g", "s", "p", "o", "evidence", "source"]


def _written(term: str) -> str:
    if not term.startswith('"'):
        return term
    body, suffix = term[1:].rsplit('"', 1)
    text = '"' + body.replace("\\", "\\\\").replace('"', '\\"').replace("\n", "\\n").replace("\r", "\\r").replace("\t", "\\t") + '"'
    return text + (f"^^<{suffix[2:]}>" if suffix.startswith("^^") else suffix)


def write_text(triples: Iterable[tuple[str, str, str]], annotations: Iterable[tuple[str, str, str, str, str | None]] = ()) -> str:
    """Turtle of one graph, a line for each triple, in order; annotations follow after an empty line."""
    lines = sorted({f"{s} {p} {_written(o)} ." for s, p, o in triples})
    notes = [
        f"<< {s} {p} {_written(o)} >> <{PROV_DERIVED}> {_written(e)}" + (f" ; <{DCT_SOURCE}> {_written(u)}" if u else "") + " ."
        for s, p, o, e, u in annotations
    ]
    return "\n".join(lines) + "\n" + ("\n" + "\n".join(notes) + "\n" if notes else "")


def to_documents(quads: DataFrame, annotations: DataFrame | None = None) -> DataFrame:
    """(g, text): the Turtle text of each graph."""

    def text_of(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        triples = zip(*(left.column(c).to_pylist() for c in "spo"), strict=True)
        notes = zip(*(right.column(c).to_pylist() for c in ("s", "p", "o", "evidence", "source")), strict=True)
        return pa.table({"g": pa.array([key[0].as_py()], pa.string()), "text": [write_text(triples, notes)]})

    if annotations is None:
        annotations = quads.sparkSession.createDataFrame([], "g string, s string, p string, o string, evidence string, source string")
    columns = ["g", "s", "p", "o", "evidence", "source"]
    return quads.groupBy("g").cogroup(annotations.select(*columns).groupBy("g")).applyInArrow(text_of, "g string, text string")
