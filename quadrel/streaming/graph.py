"""Graphs kept up to date from streams."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from quadrel.operators.quadstore import COLUMNS, QuadStore


def latest_graphs(batch: DataFrame) -> DataFrame:
    """Of quads (version, g, s, p, o), those of each graph's newest version."""
    newest = batch.groupBy("g").agg(F.max("version").alias("version"))
    return batch.join(newest, ["g", "version"]).select(*COLUMNS)


def newer_only(stream: DataFrame, time: str | None = None, late: str = "1 day", keep_seconds: int = 7 * 86_400) -> DataFrame:
    """The quads of ``stream(version, g, s, p, o)`` whose version is above all that earlier batches had of their graph.

    A graph's newest version is the query's state, kept with its checkpoint, one number a
    graph.  With an event-time column ``time``, rows later than ``late`` are left out, and a graph
    of which nothing has come for ``keep_seconds`` of event time is forgotten; without one
    state is kept for ever.  A graph's quads pass through in the batches they come in.
    """

    def run(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get[0] if state.exists else None
        best, last = held, None
        for part in parts:
            if time:
                last = max(x for x in (last, part[time].max()) if x is not None)
            newer = part if held is None else part[part["version"] > held]
            if len(newer):
                top = int(newer["version"].max())
                best = top if best is None else max(best, top)
                yield newer[_VERSIONED]
        if best is not None:
            state.update((best,))
            if time:
                until = int(last.timestamp() * 1000) + 1000 * keep_seconds
                state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))

    rows = stream.select(F.col("version").cast("long").alias("version"), *COLUMNS, *([time] if time else []))
    rows = rows.withWatermark(time, late) if time else rows
    until = GroupStateTimeout.EventTimeTimeout if time else GroupStateTimeout.NoTimeout
    return rows.groupBy("g").applyInPandasWithState(run, "version long, g string, s string, p string, o string", "version long", "append", until)


_VERSIONED = ["version", *COLUMNS]


def upsert(stream: DataFrame, store: QuadStore, checkpoint: str, time: str | None = None, late: str = "1 day", **trigger) -> StreamingQuery:
    """Replace each graph by its newest version, batch by batch.

    ``stream(version, g, s, p, o)`` carries a version of a graph within one batch.  A version
    that is no newer than what an earlier batch had of its graph is left out
    (:func:`newer_only`); a batch that runs again replaces the same graphs by the same quads.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.persist()  # read for the newest versions and for the quads
        if not batch.isEmpty():
            store.replace(latest_graphs(batch))
        batch.unpersist()

    rows = newer_only(stream, time, late)
    return rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_counts(events: DataFrame, time: str, keys: list[str], width: str, late: str, slide: str | None = None) -> DataFrame:
    """Counts of statements by time window and keys; events later than ``late`` are left out."""
    span = F.window(time, width, slide) if slide else F.window(time, width)
    return events.withWatermark(time, late).groupBy(span, *keys).agg(F.count("*").alias("n"))


def sessions(events: DataFrame, time: str, keys: list[str], gap: str, late: str) -> DataFrame:
    """Sessions of statements by keys, apart by ``gap``."""
    return events.withWatermark(time, late).groupBy(F.session_window(time, gap), *keys).agg(F.count("*").alias("n"))


def to_quads(stream: DataFrame, mapping: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """A stream of documents mapped to quads; the mapping has to be row-wise."""
    return mapping(stream)
