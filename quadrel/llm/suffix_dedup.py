"""Removal of repeated passages with suffix arrays over shards of the corpus.

A byte goes when a ``length``-byte string that covers it starts anywhere else in the
corpus, in the same text or another.

*Sharding.*  Every window of ``length`` bytes has an anchor: of the ``ANCHOR``-byte
strings in it, the one with the least hash, the leftmost on a tie.  Equal windows have
equal anchors at the same place, so a window can repeat only among windows of its own
anchor.  A run of neighbouring windows with one anchor is a *segment*, the stretch of text
that they cover; segments of anchors that occur once are dropped, of equal segments with
equal anchors one copy is kept (windows in a segment that has copies repeat, and are
settled), and the others go to the shard of their anchor.  Only the distinct segments
whose anchor has several of them move, as text.

*Suffix arrays.*  A shard's segments, divided by a separator, get a suffix array by
induced sorting and its permuted common prefixes; a window whose suffix shares ``length``
bytes with the one before or after it in order repeats.

*Hot anchors.*  An anchor with more than ``HOT`` distinct segments would be an unbounded
group.  Its windows are told apart by their offset from the anchor and a 128-bit hash of
their bytes, counted with aggregation before the shuffle, and repeat where the count is
above one: the same answer without bringing the group together.

Texts are compared as bytes throughout and shuffled compressed, once to fetch segments and
once to cut.  A row is known by a 64-bit hash of its id and its text; rows that repeat
wholly share it and get one answer.

Segments with a thousandth of all copies or more, such as a line that every other text has,
are known to be few and are settled by broadcast, so that their rows don't meet in one task.

Defined cases: null text is empty; very long texts are read whole, in overlapping blocks; texts shorter than ``length`` stay whole; what is left
of a text may be no valid UTF-8, so the result's text is binary; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrel.llm.induced import common_prefixes, suffix_array
from quadrel.llm.shared import size_batches, sliced, text_of, written

LENGTH = 200
ANCHOR = 64
#: Distinct segments of an anchor that may stand in one shard.
HOT = 20_000
#: A segment with more than one in so many of all copies is heavy.
HEAVY = 1000
#: Bytes of text that a shard is meant to have, and bytes that are hashed at a time.
SHARD_BYTES = 1_500_000
BLOCK = 500_000
#: Low bits of a sort key that hold the place within a block.
PLACE_BITS = 23


def _mixed(x: np.ndarray) -> np.ndarray:
    """SplitMix64 finaliser; its constants are fixed values."""
    x = x + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Rolling:
    """Hashes of any stretch of a byte string from running sums of byte codes times powers of an odd base."""

    def __init__(self, base: int, first: int):
        self.codes = _mixed(np.arange(first, first + 256, dtype=np.uint64))
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _upto(self, n: int) -> None:
        if len(self.powers) <= n:
            n = max(n, 2 * len(self.powers))
            for name, value in (("powers", self.base), ("inverses", self.inverse)):
                steps = np.full(n + 1, value, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def sums(self, data: np.ndarray) -> np.ndarray:
        self._upto(len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.powers[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * self.inverses[start]

    def windows(self, sums: np.ndarray, width: int) -> np.ndarray:
        n = len(sums) - width
        return (sums[width:] - sums[:-width]) * self.inverses[:n]


_ONE = _Rolling(0xD1342543DE82EF95, 0)
_TWO = _Rolling(0x2545F4914F6CDD1D, 1000)


def _window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """Least key of each ``width`` neighbours, from running minima of blocks read both ways."""
    n = len(keys) - width + 1
    blocks = np.concatenate((keys, np.full(-len(keys) % width, ~np.uint64(0)))).reshape(-1, width)
    forth = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], forth[width - 1 : width - 1 + n])


def segments(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Segments of texts that stand one after another in ``data``: text number, anchor hash, segment hash, first byte, end byte."""
    if len(data) < length:
        return [np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64)]
    if len(data) > 1 << PLACE_BITS:
        raise ValueError("block too large")
    one, two = _ONE.sums(data), _TWO.sums(data)
    hashes = _mixed(_ONE.windows(one, anchor))
    mask = np.uint64((1 << PLACE_BITS) - 1)
    keys = (hashes & ~mask) | np.arange(len(hashes), dtype=np.uint64)
    at = _window_minima(keys, length - anchor + 1) & mask
    edges = np.zeros(len(data) + 1, np.int32)
    long = ends - starts >= length
    np.add.at(edges, starts[long], 1)
    np.add.at(edges, ends[long] - length + 1, -1)
    window = np.nonzero(np.cumsum(edges)[: len(at)] > 0)[0]
    if not len(window):
        return [np.zeros(0, t) for t in (np.int64, np.uint64, np.uint64, np.int64, np.int64)]
    at = at[window].astype(np.int64)
    text = np.searchsorted(starts, window, side="right") - 1
    new = np.ones(len(window), bool)
    new[1:] = (at[1:] != at[:-1]) | (text[1:] != text[:-1])
    first = np.nonzero(new)[0]
    lo, hi = window[first], window[np.append(first[1:], len(window)) - 1] + length
    where = at[first]
    shape = (where - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (hi - lo).astype(np.uint64)
    return text[first], hashes[where], _mixed(_TWO.of(two, lo, hi) + shape), lo, hi


def _text_blocks(texts: list[bytes], overlap: int):
    """Blocks (data, starts, ends, row, shift) of whole texts, long ones in pieces that overlap by ``overlap`` bytes."""
    pieces = [(i, at) for i, t in enumerate(texts) for at in range(0, max(1, len(t) - overlap), BLOCK)]
    sizes = [min(len(texts[i]) - at, BLOCK + overlap) for i, at in pieces]
    for lo, hi in size_batches(sizes, 1 << 16, BLOCK):
        part, ends = pieces[lo:hi], np.cumsum(sizes[lo:hi])
        data = np.frombuffer(b"".join(texts[i][at : at + BLOCK + overlap] for i, at in part), np.uint8)
        yield data, ends - sizes[lo:hi], ends, np.array([i for i, _ in part]), np.array([at for _, at in part])


def _scan(length: int, anchor: int):
    def run(batches):
        for b in sliced(batches):
            keys = b.column(0).to_numpy(zero_copy_only=False)
            texts = [t.encode("utf-8") for t in b.column(1).to_pylist()]
            for data, starts, ends, row, shift in _text_blocks(texts, length - 1):
                text, a, s, lo, hi = segments(data, starts, ends, length, anchor)
                base = starts[text] - shift[text]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(s.view(np.int64)), pa.array(keys[row[text]]), pa.array((lo - base).astype(np.int64)), pa.array((hi - lo).astype(np.int32))],
                    names=["anchor", "segment", "row", "start", "size"],
                )

    return run


def _pack(batches):
    pack = zstandard.ZstdCompressor(level=3)
    for b in sliced(batches):
        packed = [pack.compress(t.encode("utf-8")) for t in b.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary()), *b.columns[2:]], names=b.schema.names)


def repeated_windows(texts: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """For each text, the starts of its windows that start also elsewhere in ``texts``."""
    whole = np.zeros(sum(map(len, texts)) + len(texts) + 1, np.uint16)
    left = np.zeros(len(whole), np.int64)
    firsts, at = [], 0
    for t in texts:
        firsts.append(at)
        whole[at : at + len(t)] = np.frombuffer(t, np.uint8).astype(np.uint16) + 2
        left[at : at + len(t)] = np.arange(len(t), 0, -1)
        whole[at + len(t)] = 1
        at += len(t) + 1
    sa = suffix_array(whole, length)
    shared = common_prefixes(whole, sa, length)[sa]
    full = left[sa] >= length
    tie = (shared >= length) & full
    tie[1:] &= full[:-1]
    tie[0] = False
    found = tie.copy()
    found[:-1] |= tie[1:]
    places = np.sort(sa[found])
    cuts = np.searchsorted(places, firsts)
    return [places[a:b] - f for a, b, f in zip(cuts, [*cuts[1:], len(places)], firsts, strict=True)]


def _runs(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Stretches that windows of rising ``starts`` cover."""
    if not len(starts):
        return []
    new = np.nonzero(np.diff(starts) > length)[0]
    return list(zip(starts[np.concatenate(([0], new + 1))].tolist(), (starts[np.append(new, len(starts) - 1)] + length).tolist(), strict=True))


def cut(data: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """What is left of ``data`` without ``spans``, which may overlap, and the number of maximal removed runs."""
    kept, at, runs, end = [], 0, 0, -1
    for a, b in sorted(spans):
        if a > end:
            kept.append(data[at:a])
            runs += 1
            end = b
        end = max(end, b)
        at = end
    kept.append(data[at:])
    return b"".join(kept), runs


def remove_repeats(df: DataFrame, text: str = "text", ident: str = "doc_id", length: int = LENGTH, anchor: int = ANCHOR, texts: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of each row, and the remaining bytes, ``kept``, with ``texts``."""
    kind = df.schema[ident].dataType.simpleString()
    docs = df.select(F.xxhash64(F.col(ident), text_of(text)).alias("row"), text_of(text).alias("text"), F.col(ident).alias("doc_id"))
    scanned = docs.where(F.octet_length("text") >= length).select("row", "text")
    scanned = written(scanned.mapInArrow(_scan(length, anchor), "anchor long, segment long, row long, start long, size int"), "all-segments")
    # Written, so that both sides of the join are plain exchanges, whose skewed partitions Spark splits.
    repeated = written(scanned.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor"), "repeated-anchors")
    found = written(scanned.join(repeated, "anchor", "left_semi"), "segments")
    distinct = written(found.groupBy("anchor", "segment").agg(F.count("*").alias("copies"), F.min(F.struct("row", "start", "size")).alias("one")), "segment-counts")
    several = written(distinct.groupBy("anchor").agg(F.count("*").alias("members")), "anchor-counts")
    distinct = written(distinct.join(several, "anchor"), "distinct-segments")

    # Segments with over a thousandth of all copies are fewer than a thousand: their rows meet them by broadcast and are not shuffled.
    most = (distinct.agg(F.sum("copies")).first()[0] or 0) // HEAVY
    again = distinct.where("copies > 1").select("anchor", "segment", "copies")
    heavy = F.broadcast(again.where(F.col("copies") > most).select("anchor", "segment"))
    key = ["anchor", "segment"]
    light = found.join(heavy, key, "left_anti").join(again.where(F.col("copies") <= most), key, "left_semi")
    settled = found.join(heavy, key, "left_semi").unionByName(light)
    spans = settled.select("row", "start", (F.col("start") + F.col("size")).alias("end"))

    wanted = distinct.where("members > 1").select(
        F.col("one.row").alias("row"), F.col("one.start").alias("start"), F.col("one.size").alias("size"), "anchor", (F.col("copies") > 1).alias("settled"), (F.col("members") > HOT).alias("hot")
    )
    total = distinct.where(f"members > 1 AND members <= {HOT}").agg(F.sum("one.size")).first()[0] or 0
    shards = max(1, -(-total // SHARD_BYTES))
    lists = wanted.groupBy("row").agg(F.collect_list(F.struct("start", "size", "anchor", "settled", "hot")).alias("wanted"))
    packed = docs.where(F.octet_length("text") >= length).select("row", "text").mapInArrow(_pack, "row long, text binary")
    held = written(packed.join(lists, "row").mapInArrow(_fetch, FETCHED), "shard-segments")

    def shard(table: pa.Table) -> pa.Table:
        rows, starts = (table.column(c).to_numpy() for c in ("row", "start"))
        open_ = ~table.column("settled").to_numpy(zero_copy_only=False)
        windows = repeated_windows([x.as_py() for x in table.column("data")], length)
        out = [(int(rows[i]), int(starts[i]) + a, int(starts[i]) + b) for i in np.nonzero(open_)[0] for a, b in _runs(windows[i], length)]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["row", "start", "end"])

    cold = held.where("NOT hot").dropDuplicates(["row", "start", "anchor"])
    by_shard = cold.groupBy(F.pmod(F.col("anchor"), F.lit(shards)).alias("shard")).applyInArrow(shard, "row long, start long, end long")
    spans = spans.unionByName(by_shard)
    hot = held.where("hot").dropDuplicates(["row", "start", "anchor"])
    if not hot.isEmpty():
        spans = spans.unionByName(_hot_spans(hot, length))
    cuts = spans.groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def finish(batches):
        unpack = zstandard.ZstdDecompressor()
        for b in sliced(batches):
            out = []
            for data, found in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                data = unpack.decompress(data)
                kept, runs = cut(data, [(s["start"], s["end"]) for s in found or ()])
                out.append((len(data), len(data) - len(kept), runs, hashlib.sha256(kept).hexdigest(), kept)[: 5 if texts else 4])
            columns = zip(*out, strict=True) if out else [[]] * (5 if texts else 4)
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()][: 5 if texts else 4]
            yield pa.RecordBatch.from_arrays([b.column(1), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))], names=names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 6 if texts else 5]
    whole = docs.mapInArrow(_pack, f"row long, text binary, doc_id {kind}").select("row", "doc_id", "text")
    schema = f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * texts
    return whole.join(cuts, "row", "left").mapInArrow(finish, schema)


FETCHED = "row long, start long, anchor long, settled boolean, hot boolean, data binary"


def _fetch(batches):
    unpack = zstandard.ZstdDecompressor()
    for b in sliced(batches):
        rows = []
        for row, data, wanted in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
            data = unpack.decompress(data)
            rows += [(row, w["start"], w["anchor"], w["settled"], w["hot"], data[w["start"] : w["start"] + w["size"]]) for w in wanted]
        for at in range(0, len(rows), 20_000):
            columns = zip(*rows[at : at + 20_000], strict=True)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=[x.split()[0] for x in FETCHED.split(", ")])


def _hot_spans(hot: DataFrame, length: int) -> DataFrame:
    """Spans of repeated windows of hot anchors, by counting window hashes."""

    def hashes(batches):
        for b in batches:
            for row, start, anchor, settled, data in zip(*(b.column(c).to_pylist() for c in ("row", "start", "anchor", "settled", "data")), strict=True):
                whole = np.frombuffer(data, np.uint8)
                one, two = (_mixed(r.windows(r.sums(whole), length)).view(np.int64) for r in (_ONE, _TWO))
                n = len(one)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, row)), pa.array(start + np.arange(n)), pa.array(np.full(n, anchor)), pa.array(np.full(n, settled)), pa.array(one), pa.array(two)],
                    names=["row", "start", "anchor", "settled", "one", "two"],
                )

    windows = written(hot.mapInArrow(hashes, "row long, start long, anchor long, settled boolean, one long, two long"), "hot-windows")
    twice = windows.groupBy("anchor", "one", "two").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    open_ = windows.where("NOT settled").join(twice, ["anchor", "one", "two"], "left_semi")
    return open_.select("row", "start", (F.col("start") + length).alias("end"))
