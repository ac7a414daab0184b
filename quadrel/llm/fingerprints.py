"""Document fingerprints from closed syncmers of words.

A k-mer is ``K`` consecutive words; its inner substrings are the runs of ``S`` words in
it, ordered by hash.  The k-mer is a *closed syncmer*, and so an anchor, when the least
of its inner substrings is its first or its last.  Whether it is depends on its own
words alone, not on what stands around it, so that two texts which share a passage share
the passage's anchors, wherever it stands in either.  About two in ``K - S + 1`` k-mers
are anchors.

The fingerprint of a text is a sample, drawn alike from all texts, of the anchors of the
whole text, each with the position where it stands first: those whose 32-bit hash is in the
lowest of ``PARTS`` parts of the range, and the ``SKETCH`` least ones at least.  It thus
grows with the text.  It is written as ``hash@position`` in hexadecimal, by rising hash.  The
likeness of two fingerprints estimates the Jaccard similarity of the anchor sets, from the
stretch of hashes that both cover.  :func:`anchors` gives all anchors, and :func:`offsets`
the shifts at which two texts match.

Everything is DataFrame functions; a text's anchors are found in one pass over arrays
within its row, without exploding it.

Defined cases: a null text is empty; very long texts are read whole; an anchor that repeats
counts once; other columns, whatever their names, are ignored; a text of fewer than ``K`` words has one anchor, its
word sequence; a text without words has none, its fingerprint is the empty string, it is
like (1.0) another without anchors and unlike (0.0) all others; rows that repeat follow
one another in an order fixed by id, then text hash; null ids come first; a single row is
its own successor; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quadrel.llm.shared import let, text_of

K = 5
S = 2
SKETCH = 64
PARTS = 16
#: Low bits of an entry, which hold the position.
PLACE_BITS = 31
BREAKS = "[\\x20\\x09-\\x0D]+"


def _least(columns: list[Column]) -> Column:
    return columns[0] if len(columns) == 1 else F.least(*columns)


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """array<struct<at int, hash long>>: the closed syncmers of a text, by word position."""
    inner = k - s + 1

    def of_hashes(h: Column) -> Column:
        n = F.size(h)

        def of_inner(m: Column) -> Column:
            def closed(p: Column) -> Column:
                at = [F.get(m, p + i) for i in range(inner)]
                return F.least(at[0], at[-1]) <= _least(at[1:-1]) if inner > 2 else F.lit(True)

            return F.transform(
                F.filter(F.sequence(F.lit(0), n - k), closed),
                lambda p: F.struct(p.alias("at"), F.xxhash64(*[F.get(h, p + i) for i in range(k)]).alias("hash")),
            )

        # Inner substrings: runs of s words, combined from the words' hashes.
        runs = h
        for i in range(1, s):
            runs = F.zip_with(F.slice(runs, 1, F.size(h) - i), F.slice(h, 1 + i, F.size(h) - i), lambda a, b: F.xxhash64(a, b))
        whole = F.array(F.struct(F.lit(0).alias("at"), F.xxhash64(h).alias("hash")))
        none = F.slice(whole, 1, 0)
        return F.when(n >= k, let(runs, of_inner)).when(n > 0, whole).otherwise(none)

    words = F.filter(F.split(text, BREAKS), lambda w: w != "")
    return let(F.transform(words, lambda w: F.xxhash64(w)), of_hashes)


def _hash(entry: Column) -> Column:
    return F.shiftright(entry, PLACE_BITS)


def sketch(found: Column, size: int = SKETCH) -> Column:
    """struct<entries array<long>, whole boolean>: the sampled anchors by rising hash, hash and first position in one number, and whether they are all."""
    codes = F.transform(found, lambda a: F.shiftleft(a["hash"].bitwiseAND(F.lit(0xFFFFFFFF)), PLACE_BITS).bitwiseOR(a["at"].cast("long")))

    def once(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, i: (i == 0) | (_hash(F.get(ordered, i - 1)) != _hash(x)))

    def cut(each: Column) -> Column:
        count = F.greatest(F.lit(size), F.size(F.filter(each, lambda x: _hash(x) < (1 << 32) // PARTS)))
        return let(count, lambda k: F.struct(F.slice(each, F.lit(1), k).alias("entries"), (F.size(each) <= k).alias("whole")))

    return let(let(F.array_sort(codes), once), cut)


def as_text(sketched: Column) -> Column:
    one = lambda x: F.concat(F.lpad(F.hex(_hash(x)), 8, "0"), F.lit("@"), F.hex(x.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))))
    return F.lower(F.array_join(F.transform(sketched["entries"], one), " "))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two anchor sets as their sketches tell it, from 0 to 1."""
    last = lambda s: F.when(s["whole"], F.lit(1 << 32)).otherwise(_hash(F.element_at(s["entries"], -1)))
    upto = lambda s, bound: F.filter(F.transform(s["entries"], _hash), lambda h: h <= bound)

    def of_sets(x: Column) -> Column:
        both = F.size(F.array_intersect(x["a"], x["b"]))
        return both.cast("double") / (F.size(x["a"]) + F.size(x["b"]) - both)

    neither = (F.size(a["entries"]) == 0) & (F.size(b["entries"]) == 0)
    sets = let(F.least(last(a), last(b)), lambda bound: F.struct(upto(a, bound).alias("a"), upto(b, bound).alias("b")))
    return F.when(neither, F.lit(1.0)).otherwise(let(sets, of_sets))


def offsets(a: Column, b: Column) -> Column:
    """array<struct<shift int, shared long>>: shifts (position in b less position in a) at which anchors match."""
    in_b = F.map_from_entries(F.transform(F.array_distinct(F.transform(b, lambda x: x["hash"])), lambda h: F.struct(h, F.filter(b, lambda x: x["hash"] == h)[0]["at"])))
    shifts = F.filter(F.transform(a, lambda x: F.element_at(in_b, x["hash"]) - x["at"]), lambda d: d.isNotNull())
    return F.transform(F.array_sort(F.array_distinct(shifts)), lambda d: F.struct(d.alias("shift"), F.size(F.filter(shifts, lambda e: e == d)).cast("long").alias("shared")))


def _stretch(ident: Column, bounds: list, step: int) -> Column:
    """Number of bounds that are not above ``ident``, found in two steps."""
    if not bounds:
        return F.lit(0)
    rows = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    first = F.array(*[F.lit(r[0]) for r in rows])
    table = F.array(*[F.array(*[F.lit(x) for x in r]) for r in rows])
    coarse = F.size(F.filter(first, lambda x: x <= ident))
    fine = F.size(F.filter(F.element_at(table, F.greatest(coarse, F.lit(1))), lambda x: x <= ident))
    return F.when(ident.isNull() | (coarse == 0), F.lit(0)).otherwise((coarse - 1) * step + fine)


def with_successor(df: DataFrame, ident: str, carry: list[str], order: list[str], stretches: int, derive: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Add ``next_<c>`` for each column of ``carry``: its value in the row after, by ``ident``; after the last, the first.

    ``derive`` adds columns to carry that are dear to compute: it is applied once to each row.

    Rows are dealt into stretches of consecutive ids by quantiles of the ids; each
    stretch also gets the first row of the stretch after it, as a guest, so that one
    window within each stretch sees every successor.  Only the stretches' bounds and
    first ids, as many as there are stretches, come to the driver.
    """
    marks = [i / stretches for i in range(1, stretches)]
    found = df.select(F.percentile_approx(ident, F.array(*map(F.lit, marks)), 10_000).alias("q")).first()["q"] if marks else None
    bounds = sorted(set(found or []))
    step = max(1, int(len(bounds) ** 0.5))
    dealt = df.withColumn("stretch", _stretch(F.col(ident), bounds, step))
    heads = dealt.groupBy("stretch").agg(F.min(F.struct(ident, *order)).alias("h")).select("stretch", f"h.{ident}", *[f"h.{c}" for c in order])
    heads = sorted(heads.collect(), key=lambda r: r["stretch"])
    if not heads:
        return derive(dealt).drop("stretch").select("*", *[F.col(c).alias(f"next_{c}") for c in carry])
    spark = df.sparkSession
    hosts = spark.createDataFrame([(r["stretch"], heads[i - 1]["stretch"]) for i, r in enumerate(heads)], "stretch int, host int")
    head_ids = spark.createDataFrame([tuple(r) for r in heads], dealt.select("stretch", ident, *order).schema)
    condition = reduce(and_, (dealt[c].eqNullSafe(head_ids[c]) for c in ("stretch", ident, *order)))
    guests = dealt.join(F.broadcast(head_ids), condition, "left_semi").dropDuplicates(["stretch"])
    guests = guests.join(F.broadcast(hosts), "stretch").withColumn("stretch", F.col("host")).drop("host").withColumn("guest", F.lit(1))
    all_rows = derive(dealt.withColumn("guest", F.lit(0)).unionByName(guests))
    after = Window.partitionBy("stretch").orderBy("guest", ident, *order)
    led = all_rows.select("*", *[F.lead(c).over(after).alias(f"next_{c}") for c in carry])
    return led.where("guest = 0").drop("stretch", "guest")


def fingerprint_table(df: DataFrame, text: str = "text", ident: str = "doc_id", stretches: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row.

    The edited text has its last ``n_chars // 2`` code points replaced by as many first
    code points of the next row's text, by rising id (or by all of it, if it is shorter).
    """
    count = stretches or 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = df.select(F.col(ident).alias("doc_id"), text_of(text).alias("text"))
    own = own.select("doc_id", "text", F.xxhash64("text").alias("tie"))
    sketched = lambda df: df.withColumn("own_sketch", sketch(anchors(F.col("text"))))
    led = with_successor(own, "doc_id", ["text", "own_sketch"], ["tie"], count, sketched)
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.char_length("text") - half), F.substring("next_text", F.lit(1), half))
    cut = led.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), edited.alias("edited"), "own_sketch", "next_own_sketch")
    told = cut.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "own_sketch", "next_own_sketch", sketch(anchors(F.col("edited"))).alias("edited_sketch"))
    return told.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own_sketch")).alias("fingerprint"),
        as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness(F.col("own_sketch"), F.col("edited_sketch")).alias("near_edited"),
        likeness(F.col("own_sketch"), F.col("next_own_sketch")).alias("near_next"),
    )
