"""Packing by non-negative least squares over a length histogram.

A document is its token ids and a closing id.  Whole windows are cut off first; what is
left, shorter than a window, is cut into a body of whole units and a tail shorter than a
unit.  The bodies' lengths make a histogram of ``window // unit`` bins, however large the
corpus.  All multisets of up to ``depth`` lengths that fill a window exactly are
candidate combinations; non-negative least squares (active sets) finds how often to use
each so that the histogram is met, the solution is rounded down to counts that the
histogram can supply, and body number r of a bin takes the r-th slot that the plan has
for its length.  Bodies beyond the plan, and all tails, are residuals: they follow one
another through further windows, each window being filled before the next is begun, and
a piece that meets a window's end is cut there.  The last, partly filled window is cut
into sequences whose lengths are powers of two, which need no padding.

No row needs another row to know its place: a partition counts its own full windows,
bodies of each length and tail tokens while it tokenises, the partitions' totals are
summed over a table with a row for each partition and length, and a place is arithmetic
on these.  Texts are never shuffled, nor are ids as long as the offsets of the runs, a row
for each run and length, are small enough to be broadcast; beyond, ids are shuffled once.

Defined cases: null text is empty and gives its closing id alone; texts of any length
are tokenised whole; repeated rows are packed each for itself; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrel.llm.shared import size_batches, text_of, written

WINDOW = 4096
UNIT = 64
DEPTH = 4
CLOSING = 2
#: Words whose ids a worker remembers at most.
CACHE = 1_000_000
PIECES = "doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"

_encoders: dict[str, WordCache] = {}


class WordCache:
    """Ids, as little-endian 16-bit bytes, of words met before.

    A text of plain characters is cut into the pre-tokeniser's words here.  New words are
    encoded many at a time, as one text with spaces between; a word's last token is the
    one that carries the end-of-word mark.  Any other text is cut at ASCII white space,
    which nothing crosses in the tokenizer's normaliser and pre-tokeniser; its plain
    stretches go the same way, and the rest are handed to the tokenizer as they are.
    """

    #: Characters that lower-casing and composition treat one by one, with ASCII white space, and the words of the pre-tokeniser among them.
    PLAIN = re.compile(r"[\x09-\x0d\x20-\x7e\xc0-\xff]*")
    WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff\s]+")

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("ids need 16 bits")
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.ends[number] = token.endswith("</w>")
        self.known: dict[str, bytes] = {}

    def words(self, text: str) -> list[str] | None:
        """The pre-tokeniser's words of a plain text; None if it isn't plain."""
        if self.PLAIN.fullmatch(text) and "<|" not in text:
            return self.WORDS.findall(text.lower())
        return None

    def learn(self, words: set[str]) -> None:
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHE:
            known.clear()
            new = list(words)
        for at in range(0, len(new), 1024):
            part = new[at : at + 1024]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids, "<u2")
            cuts = 2 * (np.nonzero(self.ends[ids])[0] + 1)
            if len(cuts) != len(part):
                raise ValueError("the tokenizer doesn't mark the end of each word once")
            whole, cuts = ids.tobytes(), cuts.tolist()
            known.update(zip(part, [whole[lo:hi] for lo, hi in zip([0, *cuts], cuts, strict=False)], strict=True))

    def _other(self, text: str) -> bytes:
        out = []
        stretches = text.encode("utf-8").split()
        for x in stretches:
            stretch = x.decode("utf-8")
            words = self.words(stretch)
            if words is None:
                ids = self.tokenizer.encode(stretch, add_special_tokens=False).ids
                out.append(np.array(ids, "<u2").tobytes())
            else:
                if not all(w in self.known for w in words):
                    self.learn(set(words))
                out += [self.known[w] for w in words]
        return b"".join(out)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each whole text."""
        cut = [self.words(t) for t in texts]
        self.learn(set().union(*(words for words in cut if words)))
        find = self.known.__getitem__
        plain = [None if words is None else b"".join(map(find, words)) for words in cut]
        return [self._other(t) if ids is None else ids for t, ids in zip(texts, plain, strict=True)]


def encoder(path: str) -> WordCache:
    if path not in _encoders:
        _encoders[path] = WordCache(path)
    return _encoders[path]


def tokenised(df: DataFrame, tokenizer: str, text: str = "text", ident: str = "doc_id", closing: int = CLOSING, window: int = WINDOW, unit: int = UNIT) -> DataFrame:
    """One row for each document: its ids and what its partition counted before it."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        words = encoder(tokenizer)
        end = np.array([closing], "<u2").tobytes()
        full = tail = 0
        ranks = [0] * (window // unit)
        for b in batches:
            texts = b.column(1).to_pylist()
            for lo, hi in size_batches([len(t) for t in texts], 200, 400_000):
                rows = []
                for ids in words.encode_all(texts[lo:hi]):
                    ids += end
                    n = len(ids) // 2
                    rest = n % window
                    size, left = divmod(rest, unit)
                    rows.append((ids, n, number, full, size, ranks[size], tail))
                    full += n // window
                    ranks[size] += 1
                    tail += left
                columns = [b.column(0).slice(lo, hi - lo), *(pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TOKENISED, strict=True))]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "n", "run", "full", "size", "rank", "tail"])

    kind = df.schema[ident].dataType.simpleString()
    return df.select(F.col(ident).alias("doc_id"), text_of(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids binary, n long, run int, full long, size int, rank long, tail long"
    )


_TOKENISED = (pa.binary(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64())


def combinations(units: int, depth: int) -> list[tuple[int, ...]]:
    """All multisets of 2 to ``depth`` lengths, in units, that fill a window of ``units``."""
    found = []

    def extend(chosen: tuple[int, ...], left: int) -> None:
        if left == 0 and len(chosen) > 1:
            found.append(chosen)
        elif len(chosen) < depth:
            for size in range(min(left, chosen[-1] if chosen else units - 1), 0, -1):
                extend((*chosen, size), left - size)

    extend((), units)
    return found


def nnls(a: np.ndarray, b: np.ndarray, rounds: int | None = None) -> np.ndarray:
    """x >= 0 that minimises |ax - b|, by active sets."""
    n = a.shape[1]
    x, active = np.zeros(n), np.zeros(n, bool)
    tolerance = 1e-9 * max(1.0, float(np.abs(a.T @ b).max(initial=0)))
    for _ in range(rounds or 3 * a.shape[0]):
        gradient = a.T @ (b - a @ x)
        gradient[active] = -np.inf
        enter = int(np.argmax(gradient))
        if gradient[enter] <= tolerance:
            break
        active[enter] = True
        while True:
            trial = np.zeros(n)
            trial[active] = np.linalg.lstsq(a[:, active], b, rcond=None)[0]
            low = active & (trial <= 1e-12)
            if not low.any():
                x = trial
                break
            shrink = np.min(x[low] / np.maximum(x[low] - trial[low], 1e-300))
            x = x + shrink * (trial - x)
            active &= x > 1e-12
            x[~active] = 0
            if not active.any():
                break
    return x


@dataclass
class Plan:
    """Where each body of each length goes."""

    #: For each length: (first rank, end rank, first sequence, offset in units) of its slots, by rank.
    slots: list[list[tuple[int, int, int, int]]]
    #: For each length: ranks from here on are residuals.
    planned: list[int]
    #: Sequences that the combinations use.
    sequences: int


def plan(histogram: list[int], units: int, depth: int = DEPTH) -> Plan:
    """Repeat counts of the combinations that meet ``histogram`` (bodies of each length), and their slots."""
    shapes = combinations(units, depth)
    supply = np.array(histogram, np.int64)
    supply[0] = 0
    a = np.zeros((units, len(shapes)))
    for j, shape in enumerate(shapes):
        for size in shape:
            a[size, j] += 1
    scale = max(1, int(supply.max(initial=0)))
    counts = np.floor(nnls(a, supply / scale) * scale + 1e-6).astype(np.int64)
    slots: list[list[tuple[int, int, int, int]]] = [[] for _ in range(units)]
    used, sequences = [0] * units, 0
    for j in np.argsort(-counts, kind="stable"):
        need = {s: shapes[j].count(s) for s in shapes[j]}
        times = min(int(counts[j]), *(int(supply[s] - used[s]) // k for s, k in need.items()))
        if times <= 0:
            continue
        at = 0
        for size in shapes[j]:
            slots[size].append((used[size], used[size] + times, sequences, at))
            used[size] += times
            at += size
        sequences += times
    return Plan(slots, used, sequences)


def residual_cuts(total: int, window: int) -> list[tuple[int, int]]:
    """(start, length) of the sequences that the last, partly filled window is cut into: powers of two."""
    at, left, out = total - total % window, total % window, []
    for bit in range(left.bit_length() - 1, -1, -1):
        if left >> bit & 1:
            out.append((at, 1 << bit))
            at += 1 << bit
    return out


def pack(df: DataFrame, tokenizer: str, text: str = "text", ident: str = "doc_id", closing: int = CLOSING, window: int = WINDOW, unit: int = UNIT, depth: int = DEPTH) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    units = window // unit
    docs = written(tokenised(df, tokenizer, text, ident, closing, window, unit), "packing-ids")
    by_size = docs.groupBy("run", "size").agg(
        F.count("*").alias("bodies"), F.sum(F.floor(F.col("n") / window)).alias("fulls"), F.sum(F.col("n") % unit).alias("tails")
    )
    by_size = written(by_size, "packing-runs")
    histogram = [0] * units
    fulls = tails = 0
    for row in by_size.groupBy("size").agg(F.sum("bodies"), F.sum("fulls"), F.sum("tails")).collect():  # a row for each length: units at most
        histogram[row[0]] = row[1]
        fulls += row[2]
        tails += row[3]
    made = plan(histogram, units, depth)
    starts, at = [0] * units, 0  # of each length's residuals in the residual stream
    for size in range(units):
        starts[size] = at
        at += (histogram[size] - made.planned[size]) * size * unit if size else 0
    tail_start, total = at, at + tails
    first_residual = fulls + made.sequences
    last = residual_cuts(total, window)

    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_size.select(
        "run", "size", F.coalesce(F.sum("bodies").over(before.partitionBy("size").orderBy("run")), F.lit(0)).alias("rank_before")
    )
    per_run = by_size.groupBy("run").agg(F.sum("fulls").alias("fulls"), F.sum("tails").alias("tails"))
    per_run = per_run.select(
        "run",
        F.coalesce(F.sum("fulls").over(before.orderBy("run")), F.lit(0)).alias("full_before"),
        F.coalesce(F.sum("tails").over(before.orderBy("run")), F.lit(0)).alias("tail_before"),
    )
    placed = docs.join(written(ranks.join(per_run, "run"), "packing-offsets"), ["run", "size"]).select(
        "doc_id", "ids", "size", (F.col("full") + F.col("full_before")), (F.col("rank") + F.col("rank_before")), (F.col("tail") + F.col("tail_before"))
    )

    def residual(position: int, start: int, length: int):
        """Pieces of residual tokens from ``position`` of the residual stream."""
        while length:
            number, offset = divmod(position, window)
            room = window - offset
            if last and position >= last[0][0]:
                for k, (at, size) in enumerate(last):
                    if at <= position < at + size:
                        number, offset, room = total // window + k, position - at, at + size - position
            now = min(length, room)
            yield start, now, first_residual + number, offset
            position, start, length = position + now, start + now, length - now

    def run(batches):
        import bisect

        froms = [[s[0] for s in slots] for slots in made.slots]
        for b in batches:
            out = []
            for doc, ids, size, full, rank, tail in zip(*(b.column(i).to_pylist() for i in range(6)), strict=True):
                wide = np.frombuffer(ids, "<u2").astype("<u4")
                n = len(wide)
                pieces = [(k * window, window, full + k, 0) for k in range(n // window)]
                body = n - n % window
                if size:
                    if rank < made.planned[size]:
                        first, _, sequence, at = made.slots[size][bisect.bisect_right(froms[size], rank) - 1]
                        pieces.append((body, size * unit, fulls + sequence + rank - first, at * unit))
                    else:
                        pieces += residual(starts[size] + (rank - made.planned[size]) * size * unit, body, size * unit)
                if n % unit:
                    pieces += residual(tail_start + tail, n - n % unit, n % unit)
                out += [(doc, s, k, zlib.crc32(wide[s : s + k]), n, q, o) for s, k, q, o in pieces]
            for at in range(0, len(out), 50_000):
                columns = list(zip(*out[at : at + 50_000], strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(columns[0], b.schema.field(0).type), *(pa.array(c, pa.int64()) for c in columns[1:])], names=_PIECES)

    return placed.mapInArrow(run, PIECES.format(kind=df.schema[ident].dataType.simpleString()))


_PIECES = [x.split()[0] for x in PIECES.split(", ")]
