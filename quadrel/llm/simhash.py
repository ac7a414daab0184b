"""SimHash near-duplicates found by Golay-code fuzzy hashing.

A text's 64-bit fingerprint is the majority, bit by bit, of the XXH64 hashes of its word
shingles.  Texts whose fingerprints differ in at most two bits are linked.

*Keys.*  The fingerprint is cut into segments of 22, 21 and 21 bits.  Among three
segments, two wrong bits leave one segment exact (pigeonhole), and each of the others
with two wrong bits at most.  A segment, taken as a 23-bit word, is decoded with the
perfect binary Golay code (23, 12, 7), itself and with each bit flipped: the codewords
met are its fuzzy keys, one for a word close to a codeword and about six otherwise.  Two
words at distance two have a word between them, one flip from either, whose codeword
both of them list.  A key is thus (exact segment, codeword index of the next segment),
33 or 34 bits; linked fingerprints always share one.

*Verification.*  Distinct fingerprints that share a key are compared by the number of
differing bits.  A bucket of up to ``BUCKET`` fingerprints is compared in blocks, in one
task, which hands on a spanning forest of the links found, never all pairs.  The
fingerprints of larger buckets take an exact way of linear size: two fingerprints differ
in two bits or fewer just when some word is at most one flip from both, so all that list
the same such word are linked with each other and hang on the least of them.

Copies share a fingerprint and take part once.  Components are formed on fingerprints.

*Near copies by similarity.*  :func:`similar_classes` links all texts whose sets of five-word
shingles have a Jaccard similarity of 0.8 or more.  The first pairs are those whose fingerprints
are linked through Golay keys (:func:`golay_pairs`), checked on the texts; what they link isn't
compared again.  No radius of fingerprints bounds a similarity, so the pairs beyond two bits are
completed by shingles: such sets, each put in one common order
with frequent shingles last, share a shingle among their first ``n - ceil(0.8 n) + 1``; the
order decides the cost alone, so it comes from a sample.  Two texts are brought together by
the first shingle they share: what stands before it in either is not shared, so its place
bounds the size of any partner, and the smaller of two similar texts has it further to the
front than most texts that merely share a template.  A bucket in which no text has it so
far in front is left before any row is copied; in others each row meets those alone that
have.  What is left is thinned by exact bounds only, sizes and a bound on the symmetric
difference from 512 parity bits, and checked on the texts.  In crowded buckets neighbours
by size are checked first; what they link isn't compared again.

Defined cases: null or wordless texts have fingerprint zero, linked as any other; very long
texts are read whole; other columns, whatever their names, are carried as one struct or
ignored; fewer words than a shingle holds make one shingle; rows that repeat get the same answer; an
empty table gives an empty result; null ids never become a component's id unless all of
its ids are null.
"""

from __future__ import annotations

from functools import lru_cache
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrel.llm.components import components
from quadrel.llm.shared import sliced, text_of, written

SEED = 42
RADIUS = 2
#: Start and width of the fingerprint's segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
#: Fingerprints of one key that one task compares; larger buckets take the linear way.
BUCKET = 4096
#: Fixed value: generator polynomial of the binary Golay code.
GOLAY_GENERATOR = 0xAE3


def fingerprint(text: str | None, words: int = 3) -> int:
    """The 64-bit SimHash of a text's shingles of ``words`` words, repeats counted."""
    parts = (text or "").encode("utf-8").lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(parts) - words + 1].tolist(), ends[words - 1 :].tolist(), strict=True)
    return _majority(np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64))


def _majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        part = hashes[at : at + (1 << 14)]
        bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(bits * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


@lru_cache(1)
def _golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Syndromes of the low 12 and the high 11 bits of a word, and the error of each syndrome."""

    def remainder(v: int) -> int:
        for bit in range(22, 10, -1):
            if v >> bit & 1:
                v ^= GOLAY_GENERATOR << (bit - 11)
        return v

    unit = [remainder(1 << b) for b in range(23)]

    def table(first: int, width: int) -> np.ndarray:
        out = np.zeros(1 << width, np.uint32)
        for b in range(width):
            out[1 << b : 2 << b] = out[: 1 << b] ^ unit[first + b]
        return out

    errors = np.zeros(2048, np.uint32)
    for a in range(23):
        for b in range(a, 23):
            for c in range(b, 23):
                chosen = {a, b, c}
                syndrome = 0
                for x in chosen:
                    syndrome ^= unit[x]
                errors[syndrome] = sum(1 << x for x in chosen)
    return table(0, 12), table(12, 11), errors


def decode(words: np.ndarray) -> np.ndarray:
    """Index (message bits) of the codeword within three flips of each 23-bit word."""
    low, high, errors = _golay()
    words = words.astype(np.uint32)
    return (words ^ errors[low[words & 0xFFF] ^ high[words >> 12]]) >> 11


def fuzzy_indices(words: np.ndarray) -> np.ndarray:
    """(n, 24) codeword indices of each word and of its 23 neighbours; repeats stand beside each other."""
    flips = np.concatenate(([0], 1 << np.arange(23, dtype=np.uint32))).astype(np.uint32)
    return np.sort(decode(words[:, None].astype(np.uint32) ^ flips[None, :]), axis=1)


def keys_of(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``prints``, key) of all keys, each once."""
    cut = [((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)) for at, width in SEGMENTS]
    places, keys = [], []
    for i in range(3):
        near = fuzzy_indices(cut[(i + 1) % 3])
        new = np.ones(near.shape, bool)
        new[:, 1:] = near[:, 1:] != near[:, :-1]
        place, column = np.nonzero(new)
        places.append(place)
        keys.append((np.int64(i) << 40) | (cut[i][place].astype(np.int64) << 12) | near[place, column].astype(np.int64))
    return np.concatenate(places), np.concatenate(keys)


def forest(prints: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (member, least member of its part) that join all of ``prints`` within ``radius`` of each other."""
    prints = np.unique(prints)
    root = np.arange(len(prints))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for at in range(0, len(prints), 512):
        block = prints[at : at + 512]
        rest = prints[at:]
        a, b = np.nonzero(np.bitwise_count(block[:, None] ^ rest[None, :]) <= radius)
        for x, y in zip((a + at)[a < b].tolist(), (b + at)[a < b].tolist(), strict=True):
            x, y = find(x), find(y)
            root[max(x, y)] = min(x, y)
    roots = np.array([find(x) for x in range(len(prints))], np.int64)
    moved = roots != np.arange(len(prints))
    return prints[moved], prints[roots[moved]]


def fingerprints(df: DataFrame, text: str = "text", ident: str = "doc_id", words: int = 3) -> DataFrame:
    """(ident, print) of each row; print is the fingerprint as a signed long."""

    def run(batches):
        for b in batches:
            prints = np.array([fingerprint(t, words) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints)], names=["ident", "print"])

    kind = df.schema[ident].dataType.simpleString()
    return df.select(F.col(ident).alias("ident"), text_of(text).alias("text")).mapInArrow(run, f"ident {kind}, print long")


def links(prints: DataFrame) -> DataFrame:
    """(a, b): links that connect all distinct values of ``print`` which a chain of links joins."""

    def emit_keys(batches):
        for b in batches:
            signed = b.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(signed), 1 << 14):
                part = signed[at : at + (1 << 14)]
                place, key = keys_of(part.view(np.uint64))
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(part[place])], names=["key", "print"])

    def verify(batches):
        for b in batches:
            found = [forest(np.array(x, np.int64).view(np.uint64)) for x in b.column(0).to_pylist()]
            one, other = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.uint64)]).view(np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(one), pa.array(other)], names=["a", "b"])

    keyed = written(prints.select("print").distinct().mapInArrow(emit_keys, "key long, print long"), "golay-keys")
    counts = keyed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")
    shared = written(keyed.join(counts, "key"), "golay-buckets")
    small = shared.where(F.col("members") <= BUCKET).groupBy("key").agg(F.collect_list("print").alias("prints")).select("prints")
    flips = F.array(F.lit(0).cast("long"), *[F.lit((1 << b) - (1 << 64 if b == 63 else 0)).cast("long") for b in range(64)])
    large = shared.where(F.col("members") > BUCKET).select("print").distinct()
    between = large.select("print", F.explode(flips).alias("flip")).select("print", F.col("print").bitwiseXOR(F.col("flip")).alias("between"))
    least = between.groupBy("between").agg(F.min("print").alias("least"), F.count("*").alias("n")).where("n > 1")
    hung = between.join(least, "between").where("print != least").select(F.col("print").alias("a"), F.col("least").alias("b"))
    return small.mapInArrow(verify, "a long, b long").unionByName(hung).distinct()


def near_classes(df: DataFrame, text: str = "text", ident: str = "doc_id", words: int = 3) -> DataFrame:
    """(ident, print, component) of each row; component is the smallest ident reachable by links."""
    prints = written(fingerprints(df, text, ident, words), "simhash")
    owners = prints.groupBy("print").agg(F.min("ident").alias("least"))
    roots = components(links(prints), "simhash-links")
    rooted = owners.join(roots, owners["print"] == roots["node"], "left").select("print", "least", F.coalesce("root", "print").alias("root"))
    best = rooted.groupBy("root").agg(F.min("least").alias("component"))
    # A table of its own, so that adaptive execution can split the rows of a much-used print, which an aggregate before the join would forbid.
    told = written(rooted.join(best, "root").select("print", "component"), "simhash-components")
    return prints.join(told, "print").select("ident", "print", "component")


def golay_pairs(prints: DataFrame) -> DataFrame:
    """(one, two): rows of ``prints(row, print)`` that join all whose fingerprints a chain of links joins; of a print's rows each is joined with the least."""
    holders = written(prints.groupBy("print").agg(F.min("row").alias("holder")), "simhash-holders")
    end = lambda name: holders.select(F.col("print").alias(name), F.col("holder").alias(f"{name}_row"))
    met = links(holders).join(end("a"), "a").join(end("b"), "b").select(F.col("a_row").alias("one"), F.col("b_row").alias("two"))
    same = prints.join(holders, "print").where("row != holder").select(F.col("row").alias("one"), F.col("holder").alias("two"))
    return met.unionByName(same).select(F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two"))


#: For similar texts: words of a shingle and least similarity.
SHINGLE = 5
SIMILARITY = 0.8
#: The order of shingles comes from this many texts, or of more from one in ``SAMPLED``.
ORDERING = 200_000
SAMPLED = 16
#: Frequent shingles that the order knows at most, and the count in the sample that makes one.
FREQUENT = 1 << 20
OFTEN = 3
#: Texts of a bucket above which neighbours by size are checked first.
CROWDED = 16
PARITY_BITS = 512


def shingle_set(text: str, words: int = SHINGLE) -> set[bytes]:
    """The distinct shingles of a text; fewer words make one."""
    parts = text.encode("utf-8").lower().split()
    return {b" ".join(parts[i : i + words]) for i in range(max(1, len(parts) - words + 1))}


def shingle_hashes(text: str, words: int = SHINGLE) -> np.ndarray:
    """Sorted 64-bit hashes of :func:`shingle_set`, made of the words' hashes."""
    parts = text.encode("utf-8").lower().split()
    if len(parts) < words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(parts), SEED)], np.uint64)
    digest = xxhash.xxh64_intdigest
    single = np.array([digest(w, SEED) for w in parts], np.uint64)
    n = len(parts) - words + 1
    out = np.zeros(n, np.uint64)
    for k in range(words):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + single[k : k + n]
    out = (out ^ (out >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return np.unique(out ^ (out >> np.uint64(29)))


def needed_of(size: int, similarity: float) -> int:
    """Least number of its ``size`` shingles that a text shares with any similar one."""
    return max(1, ceil(similarity * size - 1e-9))


def front_of(hashes: np.ndarray, frequent: np.ndarray, counts: np.ndarray, similarity: float) -> np.ndarray:
    """The first of a text's shingles by (count, hash), one of which every similar text has among its own first."""
    met = np.zeros(len(hashes), np.int64)
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
        met = np.where(frequent[at] == hashes, counts[at], 0)
    return hashes[np.argsort(met, kind="stable")[: len(hashes) - needed_of(len(hashes), similarity) + 1]]


def parity_of(hashes: np.ndarray) -> bytes:
    """Parities of the hashes' counts by their low bits; two texts' differ in no more bits than shingles."""
    return np.packbits(np.bincount((hashes % np.uint64(PARITY_BITS)).astype(np.int64), minlength=PARITY_BITS) & 1).tobytes()


def _may_be_similar(one: tuple, two: tuple, similarity: float) -> np.ndarray:
    """Whether sizes and parities, (sizes, (n, 8) words) that broadcast, leave ``similarity`` possible."""
    (n, p), (m, q) = one, two
    differing = sum(np.bitwise_count(p[..., k] ^ q[..., k]).astype(np.int16) for k in range(p.shape[-1]))
    return (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-6) & (differing * (1 + similarity) <= (n + m) * (1 - similarity) + 1e-6)


def _parities(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, PARITY_BITS // 64)


def _frequent(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the shingles met most often in a sample of ``texts(row, text)``, and their counts."""

    def run(batches):
        for b in sliced(batches):
            found = [shingle_hashes(t, words) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["hash"])

    one_in = min(SAMPLED, max(1, texts.count() // ORDERING))
    sample = texts.where(F.pmod(F.xxhash64("row"), F.lit(one_in)) == 0).select("text")
    counted = sample.mapInArrow(run, "hash long").groupBy("hash").agg(F.count("*").alias("n")).where(F.col("n") >= OFTEN)
    counted = written(counted, "similar-frequent")
    room, least = FREQUENT, None
    for n, hashes in sorted(map(tuple, counted.groupBy("n").count().collect()), reverse=True):
        if hashes > room:
            break
        room, least = room - hashes, n
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    table = counted.where(F.col("n") >= least).toArrow()
    hashes, counts = table.column("hash").to_numpy().view(np.uint64), table.column("n").to_numpy()
    order = np.argsort(hashes)
    return hashes[order], counts[order]


def _shared(batches):
    """Of a stream of (token, row, place) sorted by token and row, the rows of tokens that others have too, each once."""
    token = row = np.zeros(0, np.int64)
    place = np.zeros(0, np.int32)
    again = False  # the row held back has the token of the one before it
    for b in batches:
        token = np.concatenate((token, b.column(0).to_numpy()))
        row = np.concatenate((row, b.column(1).to_numpy()))
        place = np.concatenate((place, b.column(2).to_numpy()))
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (row[1:] != row[:-1])
        token, row, place = token[new], row[new], place[new]
        if not len(token):
            continue
        same = token[1:] == token[:-1]
        before = np.concatenate(([again], same))
        keep = before[:-1] | same
        yield pa.RecordBatch.from_arrays([pa.array(x[:-1][keep]) for x in (token, row, place)], names=["token", "row", "place"])
        token, row, place, again = token[-1:], row[-1:], place[-1:], bool(before[-1])
    if again:
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (token, row, place)], names=["token", "row", "place"])


def _neighbours(similarity: float):
    """Neighbours (one, two) that may be similar in a stream of (token, row, size, parity) sorted by token and size."""

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            token, row, size = (b.column(i).to_numpy() for i in range(3))
            now = (token, row, size.astype(np.int64), _parities(b.column(3)))
            token, row, size, parity = now if held is None else (np.concatenate(x) for x in zip(held, now, strict=True))
            held = (token[-1:], row[-1:], size[-1:], parity[-1:])
            close = (token[1:] == token[:-1]) & _may_be_similar((size[1:], parity[1:]), (size[:-1], parity[:-1]), similarity)
            one, two = row[1:][close], row[:-1][close]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], names=["one", "two"])

    return run


def _pairs_of_buckets(similarity: float):
    """Pairs (one, two) of unlinked members that may be similar, of each run of equal keys in a sorted stream.

    A run has members (early: false) and those that they are compared with (early: true);
    of two that are both, the one with the smaller row is taken as the member.
    """

    def of(row, size, most, root, early, own, parity):
        left, right = np.flatnonzero(~early), np.flatnonzero(early)
        for at in range(0, len(left), 512):
            a = left[at : at + 512, None]
            may = (root[a] != root[right]) & (size[right] <= most[a]) & (size[a] <= most[right]) & (~own[a] | (row[a] < row[right]))
            x, y = np.nonzero(may)
            for cut in range(0, len(x), 1 << 17):
                i, j = left[at : at + 512][x[cut : cut + (1 << 17)]], right[y[cut : cut + (1 << 17)]]
                close = _may_be_similar((size[i], parity[i]), (size[j], parity[j]), similarity)
                i, j = row[i[close]], row[j[close]]
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(i, j)), pa.array(np.maximum(i, j))], names=["one", "two"])

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(7)] + [_parities(b.column(7))]
            now[2], now[3] = now[2].astype(np.int64), now[3].astype(np.int64)
            held = now if held is None else [np.concatenate(x) for x in zip(held, now, strict=True)]
            starts = np.concatenate(([0], np.nonzero(np.diff(held[0]))[0] + 1))
            for first, end in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                yield from of(*(x[first:end] for x in held[1:]))
            held = [x[starts[-1] :] for x in held]
        if held is not None:
            yield from of(*held[1:])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, similarity: float, words: int) -> DataFrame:
    """(a, b): those of ``pairs(one, two)`` whose ``texts(row, text)`` are similar."""

    def pack(batches):
        press = zstandard.ZstdCompressor(level=3)
        for b in batches:
            packed = [press.compress(t.encode("utf-8")) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(packed, pa.binary())], names=["row", "packed"])

    def verify(batches):
        press = zstandard.ZstdDecompressor()
        sets: dict[int, set[bytes]] = {}
        for b in batches:
            same = []
            for one, two, x, y in zip(*(b.column(c).to_pylist() for c in ("one", "two", "x", "y")), strict=True):
                if len(sets) > 256:
                    sets.clear()
                for row, packed in ((one, x), (two, y)):
                    if row not in sets:
                        sets[row] = shingle_set(press.decompress(packed).decode("utf-8"), words)
                shared = len(sets[one] & sets[two])
                same.append(shared >= similarity * (len(sets[one]) + len(sets[two]) - shared))
            keep = pa.array(same, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("one").filter(keep), b.column("two").filter(keep)], names=["a", "b"])

    needed = pairs.select(F.col("one").alias("row")).unionByName(pairs.select(F.col("two").alias("row"))).distinct()
    packed = texts.mapInArrow(pack, "row long, packed binary").join(needed, "row", "left_semi").dropDuplicates(["row"])
    packed = written(packed, "similar-texts")
    x, y = (packed.select(F.col("row").alias(r), F.col("packed").alias(c)) for r, c in (("one", "x"), ("two", "y")))
    return pairs.join(x, "one").join(y, "two").select("one", "two", "x", "y").mapInArrow(verify, "a long, b long")


def similar_pairs(members: DataFrame, similarity: float) -> DataFrame:
    """(one, two): rows of ``members(token, row, place, size, parity, root)`` of unlike root that may be similar.

    The smaller of two similar texts has the first token that they share so far in front that
    a text of its own size could still be similar to it; only such members, the early ones,
    are handed to others.  Buckets are cut into chunks of members and chunks of early
    ones, and every two of these meet in a run of their own: of n members, k of them
    early, n * k / 2048 rows are made, or n + k where k is small.
    """
    runs = bucket_runs(members, similarity)
    found = runs.repartition("key").sortWithinPartitions("key").mapInArrow(_pairs_of_buckets(similarity), "one long, two long")
    return found.distinct()


def bucket_runs(members: DataFrame, similarity: float) -> DataFrame:
    """The rows of :func:`similar_pairs` by the run that they take part in, its ``key``."""
    most = (F.col("size") - F.col("place")) * F.lit((1 + similarity) / similarity) - F.col("size") + 1e-6
    members = members.withColumn("most", F.floor(most).cast("int")).withColumn("own", F.col("most") >= F.col("size"))
    parts = lambda n: F.ceil(n * 2 / BUCKET).cast("int")
    mixed = members.groupBy("token").agg(F.min("root").alias("first"), F.max("root").alias("last"), parts(F.count("*")).alias("chunks"), parts(F.count_if("own")).alias("early"))
    chunks = members.join(mixed.where("first != last AND early > 0").select("token", "chunks", "early"), "token")
    part = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["row", "size", "most", "root"]
    left = chunks.select("token", part("chunks").alias("c"), each("early").alias("e"), *columns, F.lit(False).alias("early"), "own", "parity")
    right = chunks.where("own").select("token", each("chunks").alias("c"), part("early").alias("e"), *columns, F.lit(True).alias("early"), "own", "parity")
    return left.unionByName(right).select(F.xxhash64("token", "c", "e").alias("key"), *columns, "early", "own", "parity")


def similar_classes(df: DataFrame, text: str = "text", ident: str = "doc_id", similarity: float = SIMILARITY, words: int = SHINGLE) -> DataFrame:
    """(row, ident, component, kept) of each distinct row; component is the smallest ident reachable by links of similar texts.

    ``row`` is :func:`row_of` the row, ``kept`` the row of the component with the smallest ident, null last, and then the smallest hash.  Texts of one shingle set take part once.
    """
    keyed = df.select(row_of(text, ident).alias("row"), F.col(ident).alias("ident"), text_of(text).alias("text"))
    texts = keyed.select("row", "text")
    kind = df.schema[ident].dataType.simpleString()

    def measure(batches):
        for b in sliced(batches):
            found = [shingle_hashes(t, words) for t in b.column(2).to_pylist()]
            more = [
                pa.array([xxhash.xxh3_128_digest(h.tobytes()) for h in found], pa.binary()),
                pa.array([len(h) for h in found], pa.int32()),
                pa.array([parity_of(h) for h in found], pa.binary()),
                pa.array(np.array([fingerprint(t) for t in b.column(2).to_pylist()], np.uint64).view(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *more], names=["row", "ident", "shingles", "size", "parity", "print"])

    prints = written(keyed.mapInArrow(measure, f"row long, ident {kind}, shingles binary, size int, parity binary, print long"), "similar-prints")
    order = df.sparkSession.sparkContext.broadcast(_frequent(texts, words))

    def fronts(batches):
        for b in sliced(batches):
            found = [front_of(shingle_hashes(t, words), *order.value, similarity) for t in b.column(1).to_pylist()]
            rows = np.repeat(b.column(0).to_numpy(), [len(f) for f in found])
            places = np.concatenate([np.arange(len(f), dtype=np.int32) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), pa.array(rows), pa.array(places)], names=["token", "row", "place"])

    owners = written(prints.groupBy("shingles").agg(F.min_by(F.struct("row", "size", "parity"), "row").alias("o")).select("shingles", "o.*"), "similar-owners")
    tokens = texts.mapInArrow(fronts, "token long, row long, place int")
    buckets = tokens.repartition("token").sortWithinPartitions("token", "row").mapInArrow(_shared, "token long, row long, place int")
    members = buckets.join(owners.select("row", "size", "parity"), "row")
    members = written(members.select("token", "row", "place", "size", "parity"), "similar-members")
    order.destroy()

    crowded = members.groupBy("token").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED).select("token")
    near = members.join(crowded, "token").select("token", "row", "size", "parity").repartition("token").sortWithinPartitions("token", "size", "row")
    near = written(near.mapInArrow(_neighbours(similarity), "one long, two long").distinct(), "similar-neighbours")
    copies = prints.join(owners.select("shingles", F.col("row").alias("owner")), "shingles").where("row != owner")
    first = golay_pairs(prints.select("row", "print")).unionByName(near)
    first = first.unionByName(copies.select(F.least("row", "owner").alias("one"), F.greatest("row", "owner").alias("two"))).distinct()
    first = written(_verified(written(first, "similar-first"), texts, similarity, words), "similar-links")
    linked = components(first, "similar-links").withColumnRenamed("node", "row")
    rooted = members.join(linked, "row", "left").withColumn("root", F.coalesce("root", "row"))
    pairs = written(similar_pairs(rooted, similarity), "similar-pairs")
    verified = _verified(pairs, texts, similarity, words)

    roots = components(first.unionByName(verified), "similar-links")
    rooted = prints.join(roots, prints["row"] == roots["node"], "left").select("row", "ident", F.coalesce("root", "row").alias("root"))
    first = F.min_by("row", F.struct(F.col("ident").isNull(), "ident", "row"))
    best = rooted.groupBy("root").agg(F.min("ident").alias("component"), first.alias("kept"))
    return rooted.join(best, "root").select("row", "ident", "component", "kept").distinct()


def row_of(text: str = "text", ident: str = "doc_id"):
    """What a row is known by: a 64-bit hash of its id and its text."""
    return F.xxhash64(F.col(f"`{ident}`"), text_of(f"`{text}`"))


def deduplicate(df: DataFrame, text: str = "text", ident: str = "doc_id", similarity: float = SIMILARITY, words: int = SHINGLE) -> DataFrame:
    """``df`` with one row, of the smallest id, of each group of similar texts; rows that repeat id and text share one decision."""
    classes = written(similar_classes(df, text, ident, similarity, words), "similar-classes")
    gone = classes.where("row != kept").select(F.col("row").alias("_row"))
    marked = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole"), row_of(text, ident).alias("_row"))
    return marked.join(gone, "_row", "left_anti").select("whole.*")
