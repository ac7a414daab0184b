"""Names resolved to entities: exact, by suffix, by alias, by shared words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quadrel.functions.slug import slug, slug_plain


def by_slug(names: DataFrame, entities: DataFrame, prefix: str = "") -> DataFrame:
    """``names(name)`` with the IRI of the entity of that slug, or a new one of the prefix and slug: (name, iri, known)."""
    known = entities.select(slug(F.col("name")).alias("_slug"), F.col("iri").alias("_iri")).groupBy("_slug").agg(F.min("_iri").alias("_iri"))
    out = names.withColumn("_slug", slug(F.col("name"))).join(known, "_slug", "left")
    return out.select(*names.columns, F.coalesce("_iri", F.concat(F.lit(prefix), F.col("_slug"))).alias("iri"), F.col("_iri").isNotNull().alias("known"))


def suffixes(key: Column) -> Column:
    """array<string> of what follows each underscore of a key."""
    parts = F.split(key, "_")
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(2), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts) - i + 1), "_"))).otherwise(F.array().cast("array<string>"))


def by_unique_suffix(names: DataFrame, entities: DataFrame) -> DataFrame:
    """(name, key): the entity key that equals a name's slug, else the only one that ends in ``_`` and it, else null.

    Keys are exploded into their suffixes, so that the search is an equi-join.
    """
    wanted = names.select("name", slug(F.col("name")).alias("slug")).distinct()
    exact = entities.select(F.col("key").alias("slug"), F.col("key").alias("exact"))
    ends = entities.select("key", F.explode(F.array_distinct(suffixes(F.col("key")))).alias("slug"))
    only = ends.groupBy("slug").agg(F.count_distinct("key").alias("n"), F.min("key").alias("only"))
    out = wanted.join(exact, "slug", "left").join(only, "slug", "left")
    return out.select("name", F.coalesce("exact", F.when(F.col("n") == 1, F.col("only"))).alias("key"))


def prefixes(key: Column) -> Column:
    """array<string> of what stands before each underscore of a key."""
    parts = F.split(key, "_")
    return F.when(F.size(parts) > 1, F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "_"))).otherwise(F.array().cast("array<string>"))


def folds(names: DataFrame, keys: DataFrame) -> DataFrame:
    """(name, key): the fold of a name with an optional hint (classification or regression): exact, else the candidate that
    extends the name at either end, if one is left after the hint."""
    wanted = names.select("name", "hint", slug(F.col("name")).alias("slug"))
    around = keys.select("key", F.explode(F.array_distinct(F.concat(suffixes(F.col("key")), prefixes(F.col("key"))))).alias("slug"))
    met = wanted.join(around, "slug").withColumn("fits", F.coalesce(F.contains("key", "hint"), F.lit(False)))
    chosen = met.groupBy("name", "hint").agg(
        F.count("*").alias("n"), F.min("key").alias("only"), F.count_if("fits").alias("m"), F.min(F.when(F.col("fits"), F.col("key"))).alias("hinted")
    )
    exact = keys.select(F.col("key").alias("slug"), F.col("key").alias("exact"))
    out = wanted.join(exact, "slug", "left").join(chosen.withColumnRenamed("name", "_name").withColumnRenamed("hint", "_hint"), F.col("name").eqNullSafe(F.col("_name")) & F.col("hint").eqNullSafe(F.col("_hint")), "left")
    return out.select("name", "hint", F.coalesce("exact", F.when(F.col("m") == 1, F.col("hinted")), F.when(F.col("n") == 1, F.col("only"))).alias("key"))


def is_target(candidate: Column, aliases: Column) -> Column:
    """Whether a candidate's slug is one of the aliases, or either begins with the other and an underscore."""
    c = slug(candidate)
    return F.exists(aliases, lambda a: (c == a) | F.startswith(c, F.concat(a, F.lit("_"))) | F.startswith(a, F.concat(c, F.lit("_"))))


def pick_url(urls: DataFrame, key: str = "key", url: str = "url", ordinal: str = "ordinal") -> DataFrame:
    """(key, url): for each key (a slug), the URL whose file's slug fits best: 100 if equal, 50 if one holds the other, and one for each shared word; the first on a tie."""
    stem = F.regexp_replace(F.substring_index(F.regexp_replace(F.col(url), "/+$", ""), "/", -1), r"\.[^.]*$", "")
    s, k = slug_plain(stem), F.col(key)
    score = F.when(s == k, 100).when(F.contains(s, k) | F.contains(k, s), 50).otherwise(0) + F.size(F.array_intersect(F.split(k, "_"), F.split(s, "_")))
    return urls.groupBy(key).agg(F.max_by(url, F.struct(score.alias("score"), (-F.col(ordinal)).alias("place"))).alias(url))


def first_seen(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Of rows with equal keys, the first by order."""
    struct = F.struct(*order, *[c for c in rows.columns if c not in order])
    best = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.min(struct).alias("b"))
    return best.select(*[F.col(f"b.{c}").alias(c) for c in rows.columns])
