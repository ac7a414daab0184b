"""Periodic runs of words by power-of-two naming.

Words are numbered, and names are given to all stretches of 1, 2, 4, ... words: a
stretch's name is the number of its pair of half-length names among the distinct pairs
(Karp, Miller and Rosenberg), so equal names mean equal words, without hashes.  How far
two places agree, forward or backward, is found by descending through the levels.

A run of period q and length L has L - q words that equal the word q on.  With L of at
least three periods these hold a place of every grid that is no wider than
L - q - 2**k + 1, from which 2**k words at least agree with those q on.  So for each q
one comparison of level-k names on a grid finds every run's candidates, and hardly any
others; a candidate is extended both ways to the run that holds it.  A stretch found
under several periods has its smallest one, as the others are multiples of it.

Documents are taken many at a time, in order of length, with a word of its own after each,
so that a period's comparison covers all documents that are long enough for it at once, and
a level is named for those alone that need it.  A batch holds up to ``BATCH`` words, or one
document; a document of n words needs some 4 bytes for each word and level, and 60 for each
candidate in hand (``CANDIDATES`` at a time).  Nothing is shuffled.

Defined cases: a null text is empty and has no words and no runs; texts of any length are
taken whole; repeated rows are treated each; a null id is kept (and counts as the empty
string in :func:`planted`); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrel.llm.shared import text_of

#: A run has at least so many words and so many periods.
LEAST, PERIODS = 24, 3
#: Words that are named together, unless one document has more; candidates that are extended together.
BATCH, CANDIDATES = 60_000, 1_000_000
#: Fixed value: a word, as a pattern.
WORD = "[^\\x20\\x09-\\x0D]+"


def grid(period: int, least: int = LEAST, periods: int = PERIODS) -> tuple[int, int]:
    """(level, step): every run of ``period`` holds a place of the grid of ``step`` from which 2**level words agree with those a period on."""
    agree = max(least, periods * period) - period
    level = (agree // 2).bit_length() - 1
    return level, agree - (1 << level) + 1


def names(words: np.ndarray, sizes: np.ndarray) -> list[np.ndarray]:
    """Names of all stretches of 1, 2, 4, ... words, as long as some document has as many words.

    ``words`` is the documents one after another, longest first, ``sizes[i]`` words with a
    separator after them.  A level covers only the documents that are long enough for it.
    """
    levels, ends = [words.astype(np.int32)], np.cumsum(sizes + 1)
    span = 1
    while 2 * span <= sizes[0]:
        upto = int(ends[np.searchsorted(-sizes, -2 * span, side="right") - 1])
        last = levels[-1]
        n = min(upto, len(last) - span)
        pairs = last[:n].astype(np.int64) * (int(last.max()) + 1) + last[span : span + n]
        levels.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))
        span *= 2
    return levels


def agreement(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, forward: bool) -> np.ndarray:
    """How many words from places i on, or before them, equal those at places j > i.

    A level is taken once at most: two of its stretches are one of the next, which failed or
    is longer than the document.
    """
    total = np.zeros(len(i), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        level, span = levels[k], 1 << k
        x, y = (i + total, j + total) if forward else (i - total - span, j - total - span)
        near = np.flatnonzero((y < len(level)) & (x >= 0))
        same = near[level[x[near]] == level[y[near]]]
        total[same] += span
    return total


def runs_of(words: np.ndarray, sizes: np.ndarray, least: int = LEAST, periods: int = PERIODS) -> np.ndarray:
    """(start, length, period) of all runs in documents laid out as :func:`names` has them, by start, then period."""
    found = []
    pending: list[tuple[np.ndarray, np.ndarray]] = []
    held = 0
    levels = names(words, sizes) if len(sizes) and sizes[0] >= least else []
    ends = np.cumsum(sizes + 1)

    def extend() -> None:
        at, q = (np.concatenate(x) for x in zip(*pending, strict=True))
        ahead, behind = agreement(levels, at, at + q, True), agreement(levels, at, at + q, False)
        start, length = at - behind, ahead + behind + q
        good = length >= np.maximum(least, periods * q)
        found.append(_smallest(np.stack([start[good], length[good], q[good]], axis=1)))

    for period in range(1, (int(sizes[0]) // periods if levels else 0) + 1):
        need = max(least, periods * period)
        if sizes[0] < need:
            break
        upto = int(ends[np.searchsorted(-sizes, -need, side="right") - 1])
        level, step = grid(period, least, periods)
        named = levels[level]
        stop = min(upto, len(named)) - period
        at = np.flatnonzero(named[0:stop:step] == named[period : period + stop : step]) * step
        if len(at):
            pending.append((at, np.full(len(at), period, np.int64)))
            held += len(at)
            if held >= CANDIDATES:
                extend()
                pending, held = [], 0
    if pending:
        extend()
    return _smallest(np.concatenate(found)) if found else np.zeros((0, 3), np.int64)


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Each (start, length) with its smallest period, by start, then period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    new = np.ones(len(runs), bool)
    new[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    runs = runs[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """(numbers of the words, words of each text, the words themselves) of all texts, one after another."""
    lists = pc.ascii_split_whitespace(texts)
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    owner = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))[real.to_numpy(zero_copy_only=False)]
    words = flat.filter(real)
    numbers = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    return numbers, np.bincount(owner, minlength=len(lists)).astype(np.int64), words


def _collapsed(words: pa.Array, keep: np.ndarray, texts: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by a space; ``texts`` are the texts' first words, and the end."""
    kept = words.filter(pa.array(keep))
    ends = np.concatenate(([0], np.cumsum(keep)))[texts]
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), kept), pa.scalar(" ", kept.type))


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _batch(ident: pa.Array, texts: pa.Array, least: int, periods: int) -> pa.RecordBatch:
    numbers, sizes, words = _words(texts)
    order = np.argsort(-sizes, kind="stable")
    firsts = np.concatenate(([0], np.cumsum(sizes)))
    # Documents by length, each with a separator of its own behind it.
    places = np.repeat(firsts[:-1][order] - np.concatenate(([0], np.cumsum(sizes[order])))[:-1], sizes[order]) + np.arange(len(numbers))
    laid = np.empty(len(numbers) + len(sizes), np.int64)
    behind = np.cumsum(sizes[order] + 1) - 1
    inner = np.ones(len(laid), bool)
    inner[behind] = False
    laid[inner] = numbers[places]
    laid[behind] = (int(numbers.max()) + 1 if len(numbers) else 0) + np.arange(len(sizes))
    runs = runs_of(laid, sizes[order], least, periods)
    rank = np.searchsorted(behind, runs[:, 0])  # of the run's document by length
    begun = behind[rank] - sizes[order][rank]
    document, start = order[rank], runs[:, 0] - begun
    # Words that a run repeats: from its second period on.
    marks = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(marks, firsts[document] + start + runs[:, 2], 1)
    np.add.at(marks, firsts[document] + start + runs[:, 1], -1)
    keep = np.cumsum(marks)[:-1] == 0
    by_document = np.argsort(document, kind="stable")
    offsets = np.searchsorted(document[by_document], np.arange(len(sizes) + 1))
    items = pa.StructArray.from_arrays([pa.array(x[by_document]) for x in (start, runs[:, 1], runs[:, 2])], fields=list(_RUNS.value_type))
    columns = [ident, pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), items), _collapsed(words, keep, firsts)]
    return pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(df: DataFrame, text: str = "text", ident: str = "doc_id", least: int = LEAST, periods: int = PERIODS) -> DataFrame:
    """(doc_id, n_words, runs, collapsed) for each row: its runs by start, then period, and its words less those that a run repeats.

    A run is a stretch of words with smallest period ``period``, at least ``least`` words and
    ``periods`` periods long, that neither neighbour extends keeping the period.  ``periods``
    has to be 2 or more.
    """
    if periods < 2 or least < periods:
        raise ValueError("a run needs two periods, and a word for each")

    def run(batches):
        for b in batches:
            texts = b.column(1)
            # A word takes two bytes with its space at least, so this bounds words.
            cuts, held = [0], 0
            for i, size in enumerate(pc.binary_length(texts).to_numpy(zero_copy_only=False)):
                if held and held + size > 6 * BATCH:
                    cuts.append(i)
                    held = 0
                held += int(size)
            for lo, hi in zip(cuts, [*cuts[1:], b.num_rows], strict=True):
                if hi > lo:
                    yield _batch(b.column(0).slice(lo, hi - lo), texts.slice(lo, hi - lo).cast(pa.large_string()), least, periods).cast(schema)

    kind = df.schema[ident].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema([("doc_id", to_arrow_type(kind)), ("n_words", pa.int64()), ("runs", _RUNS), ("collapsed", pa.string())])
    rows = df.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def planted(df: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """(doc_id, text): a tenth of the texts, by a checksum of the id, repeat a period of their own words from a place on."""
    rows = df.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"), F.crc32(F.coalesce(F.col(ident).cast("string"), F.lit(""))).alias("h"))
    chosen = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    cut = rows.withColumn("words", chosen).withColumns({"n": F.size("words").cast("long"), "g": F.floor(F.col("h") / 10).cast("long")})
    cut = cut.withColumn("a", F.when(F.col("n") > 0, F.expr("g % n"))).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    again = F.expr("array_join(transform(sequence(0, int(n) - 1), i -> words[int(if(i < a, i, a + (i - a) % p))]), ' ')")
    return cut.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), again).otherwise(F.col("text")).alias("text"))


def greatest(runs: Column) -> Column:
    """The run with the greatest length for its period, compared exactly; the first by start and period of equal ones; null of none."""
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(runs, none, lambda best, r: F.when(best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r).otherwise(best))


def digests(df: DataFrame, text: str = "text", ident: str = "doc_id") -> DataFrame:
    """Number of runs, the greatest run, and digests of all runs and of the collapsed text, of the texts as :func:`planted` has them."""
    found = periodic_runs(planted(df, text, ident)).withColumn("best", greatest(F.col("runs")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("(1000 * best.length) div best.period").alias("exponent_milli"),
        F.sha2(F.encode(F.array_join(lines, ""), "UTF-8"), 256).alias("runs_sha256"),
        F.sha2(F.encode("collapsed", "UTF-8"), 256).alias("collapsed_sha256"),
    )
