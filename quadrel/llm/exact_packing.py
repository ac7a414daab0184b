"""Best-fit packing by exact complements.

A document is its token ids and a closing id.  One longer than a window is cut into whole
windows, which are sequences of their own, after a first piece of what is left over; every
other document is one piece.  Pieces shorter than a window make a histogram with a bin for
each length, ``window - 1`` however large the corpus, and a plan is made from it alone:

* Available lengths are indexed by the sums of one, two and three of them (:class:`Sums`).
* A sequence is begun with the longest length there is.  If one, two or three available
  lengths sum to its gap exactly, the fewest that do are taken, long ones first; that
  combination is a pattern, used as often as all its lengths last.
* If none do, the longest length that fits is added (best fit), and the smaller gap is
  looked up again, until it is filled or nothing fits.

Each pattern uses up one of its lengths, or leaves fewer of it than the pattern took, so
the number of patterns is bounded by the window (by its harmonic sum), not by the corpus.
Pattern by pattern, each length's pieces are then dealt in the order of their ranks.

No piece needs another piece to know its place: a partition counts its pieces of each
length while it tokenises, the counts are summed over a table with a row for each
partition and length, and a place is arithmetic on these.  The written table has ids,
lengths and checksums, no texts and no token ids unless they are asked for.

Tokens are those of the ``tokenizers`` library.  For a byte-level BPE the same ids come from
``tiktoken`` with the vocabulary's ranks, several times as fast (the tests hold one against
the other on every character); texts that its matcher refuses (very long stretches of white
space) go to the tokenizer itself.

Defined cases: a null text is empty and gives its closing id alone; texts of any length are
tokenised whole; repeated rows are packed each for itself; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quadrel.llm.shared import size_batches, text_of, written

WINDOW = 2048
CLOSING = 0
#: Fixed value: how a byte-level BPE's pre-tokeniser cuts a text.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_encoders: dict[str, Encoder] = {}


class Encoder:
    """Ids of whole texts, from a ``tokenizers`` file of a byte-level BPE."""

    def __init__(self, path: str):
        import json

        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            said = json.load(f)
        before = said["pre_tokenizer"] or {}
        if said["model"]["type"] != "BPE" or said["normalizer"] or (before.get("type"), before.get("use_regex"), before.get("add_prefix_space")) != ("ByteLevel", True, False):
            raise ValueError("not a byte-level BPE of plain texts")
        special = {t["content"]: t["id"] for t in said["added_tokens"]}
        ranks = {self._bytes(t, ByteLevel.alphabet()): n for t, n in said["model"]["vocab"].items() if t not in special}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)

    _byte_of: dict[str, int] = {}

    @classmethod
    def _bytes(cls, token: str, alphabet: list[str]) -> bytes:
        """The bytes that a token of the byte alphabet stands for: printable Latin-1 stands for itself, other bytes follow in order from 256 on."""
        if not cls._byte_of:
            own = {c for c in alphabet if ord(c) < 256}
            others = [b for b in range(256) if chr(b) not in own]
            cls._byte_of = {c: ord(c) for c in own} | {chr(256 + k): b for k, b in enumerate(others)}
        return bytes(cls._byte_of[c] for c in token)

    def ids(self, text: str) -> np.ndarray:
        try:
            return np.asarray(self.fast.encode_to_numpy(text, allowed_special="all"), "<u4")
        except ValueError:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokenised(df: DataFrame, tokenizer: str, text: str = "text", ident: str = "doc_id", closing: int = CLOSING, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row for each document: its pieces' checksums and what its partition counted before it."""

    def run(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        encode = encoder(tokenizer)
        full = 0
        ranks = [0] * window
        end = np.array([closing], "<u4")
        for b in batches:
            texts = b.column(1)
            for lo, hi in size_batches(pc.binary_length(texts).to_pylist(), 2_000, 2_000_000):
                rows = []
                for t in texts.slice(lo, hi - lo):
                    ids = np.concatenate((encode.ids(t.as_py()), end))
                    size = len(ids) % window
                    cuts = [*([0] if size else []), *range(size, len(ids), window), len(ids)]
                    sums = [zlib.crc32(ids[a:z]) for a, z in zip(cuts, cuts[1:])]  # noqa: B905, RUF007
                    rows.append((sums, len(ids), number, full, size, ranks[size], ids.tobytes() if with_ids else None))
                    full += len(ids) // window
                    ranks[size] += 1
                columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TOKENISED, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), *columns], names=["doc_id", "sums", "n", "run", "full", "size", "rank", "ids"])

    kind = df.schema[ident].dataType.simpleString()
    return df.select(F.col(ident).alias("doc_id"), text_of(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, sums array<long>, n long, run int, full long, size int, rank long, ids binary"
    )


_TOKENISED = (pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.binary())


class Sums:
    """Lengths that are available, found by the sums of one, two and three of them.

    ``left[a]`` pieces of length a are left.  ``pairs[s]`` counts the pairs of different
    available lengths that sum to s; it is kept up to date as lengths run out.  Triples are
    found as a length whose complement is in the index of pairs, or twice a length.
    """

    def __init__(self, histogram: np.ndarray):
        self.left = histogram.astype(np.int64).copy()
        self.left[0] = 0
        self.window = len(histogram)
        have = (self.left > 0).astype(np.int64)
        self.pairs = np.convolve(have, have)
        self.pairs[2 * np.flatnonzero(have)] -= 1
        self.pairs //= 2

    def take(self, length: int, count: int) -> None:
        self.left[length] -= count
        if count and self.left[length] == 0:
            self.pairs[length + np.flatnonzero(self.left > 0)] -= 1

    def pair(self, total: int, least: np.ndarray, most: int) -> tuple[int, int] | None:
        """Two lengths, ``most`` at most, that sum to ``total``, the longest first, with ``least`` more pieces in use than taken."""
        high = np.arange(min(most, total - 1), (total - 1) // 2, -1)
        free = self.left - least
        fits = (free[high] > 0) & (free[total - high] > 0) & ((2 * high != total) | (free[high] > 1))
        at = int(fits.argmax()) if len(high) else 0
        return (int(high[at]), total - int(high[at])) if len(high) and fits[at] else None

    def complement(self, gap: int, used: np.ndarray) -> tuple[int, ...] | None:
        """The fewest available lengths, three at most and long ones first, that sum to ``gap``; ``used`` pieces of each length are spoken for."""
        free = self.left - used
        if free[gap] > 0:
            return (gap,)
        if (found := self.pair(gap, used, gap - 1)) is not None:
            return found
        first = np.arange(gap - 2, (gap + 2) // 3 - 1, -1)
        rest = gap - first
        even = rest % 2 == 0
        likely = (free[first] > 0) & ((self.pairs[rest] > 0) | (even & (free[rest // 2] > 1)))
        for a in first[likely]:
            used[a] += 1
            found = self.pair(gap - int(a), used, int(a))
            used[a] -= 1
            if found is not None:
                return int(a), *found
        return None

    def longest(self, limit: int, used: np.ndarray) -> int:
        """The longest length with a piece to spare, ``limit`` at most; 0 if there is none."""
        some = np.flatnonzero((self.left - used)[: limit + 1] > 0)
        return int(some[-1]) if len(some) else 0


@dataclass
class Plan:
    """Patterns of lengths, as slots of each length by rank."""

    window: int
    #: Sequences that the patterns use.
    sequences: int = 0
    #: Rows of (length, first rank, pieces in a sequence, first sequence, offset of the first of them).
    slots: list[tuple[int, int, int, int, int]] = field(default_factory=list)

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """The slots by length and rank, and the key that they are searched by."""
        rows = np.array(sorted(self.slots), np.int64).reshape(-1, 5)
        return rows, (rows[:, 0] << 48) + rows[:, 1]


def plan(histogram: np.ndarray) -> Plan:
    """Which pieces go together, from the number of pieces of each length below ``len(histogram)``, the window."""
    window = len(histogram)
    sums, made = Sums(histogram), Plan(window)
    ranks = np.zeros(window, np.int64)
    used = np.zeros(window, np.int64)
    while length := sums.longest(window - 1, used):
        pattern, gap = [], window
        while length:
            pattern.append(length)
            used[length] += 1
            gap -= length
            if not gap:
                break
            if (found := sums.complement(gap, used)) is not None:
                for x in found:
                    used[x] += 1
                pattern += found
                break
            length = sums.longest(gap, used)
        needs = {x: int(used[x]) for x in dict.fromkeys(pattern)}
        times = min(int(sums.left[x]) // k for x, k in needs.items())
        at = 0
        for x, k in needs.items():
            made.slots.append((x, int(ranks[x]), k, made.sequences, at))
            ranks[x] += k * times
            at += k * x
            sums.take(x, k * times)
            used[x] = 0
        made.sequences += times
    return made


def pack(df: DataFrame, tokenizer: str, text: str = "text", ident: str = "doc_id", closing: int = CLOSING, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset; with ``with_ids`` also its ids, 32 bits each, little-endian."""
    docs = written(tokenised(df, tokenizer, text, ident, closing, window, with_ids), "exact-packing-ids")
    by_size = written(docs.groupBy("run", "size").agg(F.count("*").alias("pieces"), F.sum(F.floor(F.col("n") / window)).alias("fulls")), "exact-packing-runs")
    histogram, fulls = np.zeros(window, np.int64), 0
    for size, pieces, whole in by_size.groupBy("size").agg(F.sum("pieces"), F.sum("fulls")).collect():  # a row for each length: the window at most
        histogram[size] = pieces
        fulls += whole
    slots, keys = plan(histogram).table()

    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    ranks = by_size.select("run", "size", F.coalesce(F.sum("pieces").over(before.partitionBy("size").orderBy("run")), F.lit(0)).alias("rank_before"))
    # A row for each partition.
    per_run = by_size.groupBy("run").agg(F.sum("fulls").alias("fulls")).select("run", F.coalesce(F.sum("fulls").over(before.orderBy("run")), F.lit(0)).alias("full_before"))
    offsets = written(ranks.join(per_run, "run"), "exact-packing-offsets")
    placed = docs.join(offsets, ["run", "size"]).select(
        "doc_id", "sums", "n", "size", (F.col("full") + F.col("full_before")).alias("full"), (F.col("rank") + F.col("rank_before")).alias("rank"), *(["ids"] if with_ids else [])
    )

    def run(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 20_000):
                b = whole.slice(at, 20_000)
                n, size, full, rank = (b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (2, 3, 4, 5))
                count = -(-n // window)
                row = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                short = (piece == 0) & (size[row] > 0)
                start = np.where(short | (size[row] == 0), piece * window, size[row] + (piece - 1) * window)
                length = np.where(short, size[row], window)
                sequence = full[row] + piece - (size[row] > 0)
                offset = np.zeros(len(row), np.int64)
                if short.any():
                    own = row[short]
                    slot = slots[np.searchsorted(keys, (size[own] << 48) + rank[own], side="right") - 1]
                    turn, place = np.divmod(rank[own] - slot[:, 1], slot[:, 2])
                    sequence[short] = fulls + slot[:, 3] + turn
                    offset[short] = slot[:, 4] + place * slot[:, 0]
                columns = [b.column(0).take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), b.column(1).flatten(), pa.array(sequence), pa.array(offset)]
                if with_ids:
                    ids = b.column(6)
                    columns.append(pa.array([ids[r].as_py()[4 * s : 4 * (s + k)] for r, s, k in zip(row.tolist(), start.tolist(), length.tolist(), strict=True)], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = df.schema[ident].dataType.simpleString()
    said = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long" + (", ids binary" if with_ids else "")
    names = [x.split()[0] for x in said.split(", ")]
    return placed.mapInArrow(run, said)
