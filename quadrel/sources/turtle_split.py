"""Large Turtle files read in parts.

The text reader deals a file out by blocks, wherever the cluster keeps it; a block begins
and ends anywhere.  What a block's text means depends on what is before it in two ways
only: whether it begins within a long string, and which prefixes hold.

*Where statements end.*  Each block is read under every assumption about its beginning
(outside a long string, within one of either quote), which gives the ends of its
statements and the state that it leaves; the states of a file's blocks then follow from one
another, a row for each block.  Assumptions that don't occur in a block cost nothing: a
block without long quotes is read once.

*Pieces.*  What lies between a block's first and last end of a statement is cut into pieces
of whole statements; the rest, before and behind, is put together with its neighbours'
into the one statement that crosses the blocks.

*Prefixes.*  The directives of all pieces, with their places, are gathered for each file
and handed to its pieces, each of which takes those before it.

Blank nodes with a label are the same in all pieces of a file, those without are named by
the place of their piece.  A file with an error gives an error row and nothing else, as in
:func:`quadrel.sources.turtle.parse_documents`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrel.sources.sinks import scratch
from quadrel.sources.turtle import _TOKEN, Parser, TurtleError, graph_name, plain_name, tokens

#: Characters that a piece has at least, unless its block has fewer.
PIECE = 1 << 20
#: The quotes of long strings; a block begins outside (0) or within one of them.
QUOTES = ("", '"""', "'''")
_CLOSES = (None, re.compile(r'(?:[^"\\]|\\.|"(?!""))*"""', re.S), re.compile(r"(?:[^'\\]|\\.|'(?!''))*'''", re.S))
_DIRECTIVE = re.compile(r"@prefix\b|@base\b|\bprefix\b|\bbase\b", re.I)


def scan(text: str, state: int) -> tuple[list[int], int]:
    """(ends of statements, state at the end) of a block that begins in ``state``."""
    at, ends = 0, []
    if state:
        closed = _CLOSES[state].match(text)
        if not closed:
            return ends, state
        at = closed.end()
    while at < len(text):
        for opened in (1, 2):
            if text.startswith(QUOTES[opened], at):
                closed = _CLOSES[opened].match(text, at + 3)
                if not closed:
                    return ends, opened
                at = closed.end()
                break
        else:
            m = _TOKEN.match(text, at)
            if not m:
                raise TurtleError(f"unexpected text: {text[at : at + 40]!r}")
            at = m.end()
            if m.lastgroup == "mark" and m[0] == ".":
                ends.append(at)
    return ends, 0


def directives(text: str) -> list[tuple[str, str, str]]:
    """(keyword, name, reference) of the prefixes and bases that whole statements declare, in order."""
    if not _DIRECTIVE.search(text):
        return []
    out, before, held = [], "", []
    for kind, t in tokens(text):
        if held:
            held.append(t)
            if len(held) == (3 if held[0] == "prefix" else 2):
                out.append((held[0], held[1] if len(held) == 3 else "", held[-1]))
                held = []
        elif (kind == "word" or kind == "lang" and before not in ("text", "long")) and t.lower().lstrip("@") in ("prefix", "base"):
            held = [t.lower().lstrip("@")]
        before = kind
    return out


def _blocks(batches) -> Iterator[tuple[str, int, str]]:
    """(file, start, text) of each block in a stream of lines."""
    key, lines = None, []
    for b in batches:
        for file, start, line in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            if (file, start) != key:
                if key is not None:
                    yield *key, "\n".join(lines) + "\n"
                key, lines = (file, start), []
            lines.append(line)
    if key is not None:
        yield *key, "\n".join(lines) + "\n"


def _scanned(batches):
    """What each block gives under each state: a row for its head, pieces and tail, and one that says how it ends."""
    names = ["file", "start", "state", "kind", "seq", "text", "leaves"]
    for file, start, text in _blocks(batches):
        rows = []
        for state in (0, 1, 2):
            if state and QUOTES[state] not in text:
                rows.append(("middle", 0, None, state, state))  # all of it is within the string; its text is in the row below
                continue
            try:
                ends, leaves = scan(text, state)
            except TurtleError as e:
                rows.append(("error", 0, str(e), state, 0))
                continue
            if not ends:
                rows.append(("middle", 0, text, state, leaves))
                continue
            rows.append(("head", 0, text[: ends[0]], state, leaves))
            first, seq = ends[0], 1
            for end in ends[1:]:
                if end - first >= PIECE or end == ends[-1]:
                    rows.append(("piece", seq, text[first:end], state, leaves))
                    first, seq = end, seq + 1
            rows.append(("tail", seq, text[ends[-1] :], state, leaves))
        if any(r[2] is None for r in rows):
            rows.append(("text", 0, text, -1, 0))
        for at in range(0, len(rows), 16):
            kind, seq, said, state, leaves = zip(*rows[at : at + 16], strict=True)
            n = len(kind)
            yield pa.RecordBatch.from_arrays([pa.array([file] * n), pa.array([start] * n, pa.int64()), pa.array(state, pa.int32()), pa.array(kind), pa.array(seq, pa.int32()), pa.array(said, pa.string()), pa.array(leaves, pa.int32())], names=names)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(spark: SparkSession, path: str, glob: str = "*.ttl") -> tuple[DataFrame, DataFrame]:
    """(file, start, seq, text) of whole statements, and (file, error) of the files below ``path``; names that begin with two underscores are left out."""
    lines = spark.read.option("lineSep", "\n").text(path, pathGlobFilter=glob)
    lines = lines.where(~plain_name(F.col("_metadata.file_name")).startswith("__"))
    lines = lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), "value")
    rows = _written(lines.mapInArrow(_scanned, "file string, start long, state int, kind string, seq int, text string, leaves int"), "turtle-blocks")
    # A file's blocks in order, each with the state that it leaves for each it may begin in.
    ends = rows.where("kind IN ('head', 'middle', 'error')").select("file", "start", "state", "leaves", (F.col("kind") == "head").alias("whole"))
    of_block = ends.groupBy("file", "start").agg(F.map_from_entries(F.collect_list(F.struct("state", F.struct("leaves", "whole")))).alias("by"))
    ordered = of_block.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("start", F.map_entries("by").alias("by")))).alias("blocks"))
    entry = "filter(b.by, x -> x.key = a.state)[0].value"
    walked = F.expr(f"""
        aggregate(blocks, struct(0 AS state, 0 AS ends, CAST(array() AS array<struct<start: bigint, state: int, ends: int>>) AS seen),
          (a, b) -> struct({entry}.leaves AS state, a.ends + int({entry}.whole) AS ends, array_append(a.seen, struct(b.start AS start, a.state AS state, a.ends AS ends)) AS seen)).seen""")
    states = ordered.select("file", F.explode(walked).alias("b")).select("file", "b.*")
    texts = rows.where("kind = 'text'").select("file", "start", F.col("text").alias("_text"))
    real = rows.where("kind <> 'text'").join(states, ["file", "start", "state"]).join(texts, ["file", "start"], "left").withColumn("text", F.coalesce("text", "_text")).drop("_text")
    # A statement that crosses blocks: what is behind the last end so far, whole blocks without an end, what is before the next end.
    group = F.col("ends") + (F.col("kind") == "tail").cast("int")
    parts = real.where("kind IN ('head', 'middle', 'tail')").groupBy("file", group.alias("statement")).agg(F.sort_array(F.collect_list(F.struct("start", "seq", "text"))).alias("parts"))
    joined = parts.select("file", F.get("parts", F.lit(0))["start"].alias("start"), F.get("parts", F.lit(0))["seq"].alias("seq"), F.array_join(F.transform("parts", lambda x: x["text"]), "").alias("text"))
    whole = real.where("kind = 'piece'").select("file", "start", "seq", "text").unionByName(joined)
    return whole, real.where("kind = 'error'").select("file", F.col("text").alias("error"))


def _said(batches):
    for b in batches:
        found = [directives(t) for t in b.column(3).to_pylist()]
        keep = [i for i, f in enumerate(found) if f]
        kind = pa.list_(pa.struct([("keyword", pa.string()), ("name", pa.string()), ("reference", pa.string())]))
        said = pa.array([[dict(zip(("keyword", "name", "reference"), d, strict=True)) for d in found[i]] for i in keep], kind)
        yield pa.RecordBatch.from_arrays([*(b.column(k).take(pa.array(keep, pa.int32())) for k in range(3)), said], names=["file", "start", "seq", "said"])


def _parsed(batches):
    names = ["kind", "file", "s", "p", "o", "evidence", "source"]
    for b in batches:
        rows = []
        for file, g, start, seq, text, said in zip(*(b.column(k).to_pylist() for k in range(6)), strict=True):
            try:
                parser = Parser("", (g or "").rsplit("/", 1)[-1], g or "", mark=f"{start}.{seq}.")
                for d in said or []:
                    if (d["start"], d["seq"]) < (start, seq):
                        for x in d["said"]:
                            if x["keyword"] == "prefix":
                                parser.prefixes[x["name"][:-1]] = parser.resolve(x["reference"])
                            else:
                                parser.base = parser.resolve(x["reference"])
                parser.items = list(tokens(text))
                found = parser.document()
            except (TurtleError, IndexError) as e:
                rows.append(("error", file, None, None, None, str(e), None))
                continue
            rows += [("quad", file, *t, None, None) for t in dict.fromkeys(found.triples)]
            rows += [("annotation", file, *a) for a in found.annotations]
        for at in range(0, len(rows), 50_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows[at : at + 50_000], strict=True)], names=names)


def read_parts(spark: SparkSession, path: str, glob: str = "*.ttl", namespace: str = "urn:graph:") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Quads (a set), annotations (repeats kept) and errors (g, error) of the files below ``path`` that match ``glob``, each read in as many parts as it has blocks."""
    whole, errors = pieces(spark, path, glob)
    whole = _written(whole, "turtle-pieces")
    kind = "file string, start long, seq int, said array<struct<keyword: string, name: string, reference: string>>"
    said = whole.where(F.col("text").rlike("(?i)prefix|base")).mapInArrow(_said, kind)
    said = said.groupBy("file").agg(F.sort_array(F.collect_list(F.struct("start", "seq", "said"))).alias("said"))
    name: Column = plain_name(F.substring_index("file", "/", -1))
    g = graph_name(name, namespace)
    told = whole.join(said, "file", "left").select("file", g.alias("g"), "start", "seq", "text", "said")
    parsed = _written(told.mapInArrow(_parsed, "kind string, file string, s string, p string, o string, evidence string, source string"), "turtle-parsed")
    of = lambda k: parsed.where(F.col("kind") == k)
    bad = errors.unionByName(of("error").select("file", F.col("evidence").alias("error"))).groupBy("file").agg(F.min("error").alias("error"))
    good = lambda k: of(k).join(bad.select("file"), "file", "left_anti").withColumn("g", g)
    return good("quad").select("g", "s", "p", "o").distinct(), good("annotation").select("g", "s", "p", "o", "evidence", "source"), bad.select(g.alias("g"), "error")
