"""Exact deduplication by a tree-merge of sorted digest runs.

Every input partition is a *run*: its rows reduced to one entry for each digest.
Runs meet in binomial rounds.  In a round, ``2 ** fan_in_bits`` neighbouring runs
merge into one: rows are keyed by the run they merge into and by the digest, so that
each key meets at most that many entries, and each merged entry keeps the count and
the best identifier that survives.  When one run is left, it holds one entry for each
distinct text.  The answer then walks down the same tree: an entry of a run asks its
parent, never the root, so that no key of any join or aggregate gathers more rows than
the fan-in or than one partition holds, however many copies a text has.

Entries are matched on a SHA-256 digest, a 64-bit hash of another family and the
length of the normalised text; a merge happens only when all three agree.

Runs are exchanged by (run, digest) and not run by run, so that a late round's merge, which
holds every distinct text, is still dealt over all tasks; within a task entries come sorted.
Each level is written once, sorted, and read on the way down.  Only narrow rows (about 70
bytes for a document) move between executors.  Everything is DataFrame functions.

Defined cases: a null text is empty and so equals other empty texts; very long texts are
digested whole; of equal lengths the smallest id, then the first place stays; null ids order
before all others; rows that repeat wholly are copies, of which exactly one stays; an
empty table gives an empty result; other columns, whatever their names, are carried by
:func:`deduplicate` and ignored by :func:`copy_classes`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrel.llm.shared import text_of, without_ascii_space, written

KEY = ["digest", "length", "check"]


def digest_runs(df: DataFrame, text: str = "text", ident: str = "doc_id", carry: bool = False) -> DataFrame:
    """One row for each input row: its run, its place, its digest and its rank.

    With ``carry``, the input row comes along as one struct, ``whole``, so that no name
    of its columns can clash with ours.
    """
    whole = [F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("whole")] if carry else []
    return df.select(
        F.col(ident).alias("ident"),
        F.char_length(text_of(text)).cast("long").alias("n_chars"),
        without_ascii_space(text_of(text)).alias("normal"),
        *whole,
    ).select(
        "ident",
        "n_chars",
        F.unhex(F.sha2(F.encode("normal", "UTF-8"), 256)).alias("digest"),
        F.octet_length("normal").cast("long").alias("length"),
        F.xxhash64("normal").alias("check"),
        F.monotonically_increasing_id().alias("place"),
        F.spark_partition_id().alias("run"),
        *(["whole"] if carry else []),
    )


def merge_tree(runs: DataFrame, fan_in_bits: int = 3) -> DataFrame:
    """Add ``keep_ident``, ``keep_place`` and ``group_size`` to each row of ``runs``.

    ``runs`` is read several times and has to be stable: a written table.
    """
    best = F.min(F.struct((-F.col("n_chars")).alias("shorter"), F.col("ident"), F.col("place"))).alias("best")
    last = runs.agg(F.max("run")).first()[0] or 0
    # Every level is written, in order within its files, so that the way down reads it instead of merging again.
    kept = lambda level: written(level.sortWithinPartitions("run", *KEY), "digest-level")
    levels = [kept(runs.groupBy("run", *KEY).agg(F.count("*").alias("copies"), best))]
    while last >> (fan_in_bits * (len(levels) - 1)):
        merged = levels[-1].withColumn("run", F.shiftright("run", fan_in_bits)).groupBy("run", *KEY)
        levels.append(kept(merged.agg(F.sum("copies").alias("copies"), F.min("best").alias("best"))))
    told = levels.pop()
    while levels:
        child = levels.pop().select("run", *KEY, F.shiftright("run", fan_in_bits).alias("parent"))
        told = child.join(told.withColumnRenamed("run", "parent"), ["parent", *KEY]).drop("parent")
    return runs.join(told, ["run", *KEY]).select(
        *[runs[c] for c in runs.columns],
        F.col("best.ident").alias("keep_ident"),
        F.col("best.place").alias("keep_place"),
        F.col("copies").alias("group_size"),
    )


def copy_classes(df: DataFrame, text: str = "text", ident: str = "doc_id", fan_in_bits: int = 3) -> DataFrame:
    """A row for each input row: ident, keep_ident, group_size, kept, text_sha256 (lower-case hex)."""
    merged = merge_tree(written(digest_runs(df, text, ident), "digest-runs"), fan_in_bits)
    return merged.select(
        "ident",
        "keep_ident",
        "group_size",
        (F.col("place") == F.col("keep_place")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def deduplicate(df: DataFrame, text: str = "text", ident: str = "doc_id", fan_in_bits: int = 3) -> DataFrame:
    """The rows of ``df`` that stay, with all their columns.

    The rows are written once together with their digests, so that the digest pass and
    the final selection see the same places.
    """
    stored = written(digest_runs(df, text, ident, carry=True), "digest-rows")
    merged = merge_tree(stored.drop("whole"), fan_in_bits)
    stay = merged.where(F.col("place") == F.col("keep_place")).select("place")
    return stored.select("place", "whole").join(stay, "place", "left_semi").select("whole.*")
