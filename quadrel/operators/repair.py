"""Repair of graphs that fail validation: guards around a pluggable fixer."""

from __future__ import annotations

import json
import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from quadrel.functions.slug import without_base_folder
from quadrel.plans.shacl import Shape, validate, verdicts

#: A graph below this many triples is never too short, and one repaired to less than this share is.
SMALL, SHARE, LEAST = 20, 0.8, 10


def is_too_short(original: Column, repaired: Column) -> Column:
    """Whether a repaired graph lost too much: under max(10, floor(0.8 * original)) triples, of 20 at least."""
    return (original >= SMALL) & (repaired < F.greatest(F.lit(LEAST).cast("long"), F.floor(original * F.lit(8) / 10)))


def guarded(original: DataFrame, repaired: DataFrame) -> DataFrame:
    """(g, original, repaired, rejected) of each graph of ``original``."""
    count = lambda df, name: df.select("g", "s", "p", "o").distinct().groupBy("g").agg(F.count("*").alias(name))
    both = count(original, "original").join(count(repaired, "repaired"), "g", "left").fillna(0, ["repaired"])
    return both.withColumn("rejected", is_too_short(F.col("original"), F.col("repaired")))


def restored_annotations(annotations: DataFrame, repaired: DataFrame) -> DataFrame:
    """The annotations, repeats included, whose statement is still in its graph."""
    return annotations.join(repaired.select("g", "s", "p", "o").distinct(), ["g", "s", "p", "o"], "left_semi")


def web_provenance(annotations: DataFrame, source_url: Column) -> DataFrame:
    """Annotations whose source is a literal path cite the web address instead."""
    is_path = F.coalesce(F.col("source").startswith('"'), F.lit(False))
    return annotations.withColumn("source", F.when(is_path & source_url.isNotNull(), F.concat(F.lit("<"), source_url, F.lit(">"))).otherwise(F.col("source")))


def normalized_provenance(annotations: DataFrame, folder: Column, source_url: Column) -> DataFrame:
    """Annotations with paths in their evidence and source relative to ``folder``, and the web address in place of a source that is a path."""
    relative = annotations.withColumns({c: without_base_folder(F.col(c), folder) for c in ("evidence", "source")})
    return web_provenance(relative, source_url)


def ask(rows: DataFrame, prompt: str, client: Callable[[str], str], again: Callable[[str, str, int], str], asks: int = 3, waits: list[int] | None = None, limited: tuple[type[Exception], ...] = (), per_second: float | None = None, lanes: int = 8) -> DataFrame:
    """``rows`` with (reply, error): the JSON object of a service's reply to each prompt.

    A reply without a JSON object is asked for again, ``asks`` times in all, with the prompt
    that ``again(prompt, reply, number)`` makes of it: first a shorter answer, then the bad
    one mended.  An exception of the kinds ``limited`` is waited out, in turn by ``waits``.
    What fails for good is an error of its row and stops no other.

    With ``per_second`` the cluster as a whole calls no more often than that: rows are dealt
    into ``lanes``, each of which leaves ``lanes / per_second`` seconds between the starts of its
    calls, those that ask again or after a wait included.  A task that runs again keeps its
    lane's pace from its own first call, which comes a whole interval after it starts; so
    that no lane runs twice at a time, such a job should not be speculative.
    """
    if per_second is not None and (per_second <= 0 or lanes < 1):
        raise ValueError("a pace and its lanes are above nothing")
    interval = None if per_second is None else lanes / per_second
    due: list[float] = []
    pauses = retry_waits() if waits is None else waits

    def call(text: str) -> str:
        for pause in [*pauses, None]:
            if interval is not None:
                if not due:
                    from pyspark import TaskContext

                    # Lanes begin one after another within an interval.
                    due.append(time.monotonic() + interval + TaskContext.get().partitionId() % lanes * interval / lanes)
                time.sleep(max(0.0, due[0] - time.monotonic()))
                due[0] = max(due[0], time.monotonic()) + interval
            try:
                return client(text)
            except limited:
                if pause is None:
                    raise
                time.sleep(pause)
        raise AssertionError

    def answer(text: str) -> tuple[str | None, str | None]:
        asked, decoder = text, json.JSONDecoder()
        error = "no prompt"
        for number in range(asks if text is not None else 0):
            try:
                reply = call(asked)
            except Exception as e:  # noqa: BLE001 - the row's own failure
                return None, str(e)
            try:
                found = decoder.raw_decode(reply, reply.index("{"))[0]
                return json.dumps(found, ensure_ascii=False), None
            except ValueError as e:
                error, asked = str(e), again(text, reply, number + 1)
        return None, error

    names = [*rows.columns, "reply", "error"]

    def run(batches):
        for b in batches:
            found = [answer(t) for t in b.column(b.schema.get_field_index(prompt)).to_pylist()]
            columns = [pa.array(c, pa.string()) for c in zip(*found, strict=True)] or [pa.array([], pa.string())] * 2
            yield pa.RecordBatch.from_arrays([*b.columns, *columns], names=names)

    dealt = rows if interval is None else rows.repartition(lanes)
    return dealt.mapInArrow(run, StructType([*rows.schema.fields, StructField("reply", StringType()), StructField("error", StringType())]))


def retry_waits(tries: int = 6, step: int = 30) -> list[int]:
    """Seconds to wait after each try of a service that limits its rate."""
    return [step * n for n in range(1, tries + 1)]


def repair(
    quads: DataFrame,
    shapes: list[Shape],
    fix: Callable[[DataFrame, DataFrame], DataFrame],
    keep: Callable[[DataFrame], DataFrame],
    rounds: int = 5,
    baseline_is_original: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Quads after up to ``rounds`` rounds of repair, and their verdicts.

    Each round validates all graphs, hands those that fail with their report to ``fix``, and
    takes its graphs unless they are too short for the baseline: the original text or, with
    ``baseline_is_original`` false, the current one.  Graphs that conform are never touched.
    ``keep`` stores a round's quads (a written table) and reads them back.
    """
    original = current = keep(quads)
    for _ in range(rounds):
        report = validate(current, shapes)
        failing = verdicts(current, report).where("NOT conforms").select("g")
        if failing.isEmpty():
            break
        broken = current.join(failing, "g", "left_semi")
        fixed = keep(fix(broken, report.join(failing, "g", "left_semi")))
        taken = guarded(original.join(failing, "g", "left_semi") if baseline_is_original else broken, fixed).where("NOT rejected").select("g")
        current = keep(current.join(taken, "g", "left_anti").unionByName(fixed.join(taken, "g", "left_semi").select(*current.columns)))
    return current, verdicts(current, validate(current, shapes))
