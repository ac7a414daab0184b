"""Precedence between two sources of the same entities."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quadrel.functions.slug import slug


def first_wins(preferred: DataFrame, other: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Rows of both, by keys; of a key in both, each column is the preferred one, or the other where that is null."""
    a = preferred.select(*keys, *[F.col(c).alias(f"_a_{c}") for c in columns])
    b = other.select(*keys, *[F.col(c).alias(f"_b_{c}") for c in columns])
    return a.join(b, keys, "full").select(*keys, *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in columns])


def shallow_merge(preferred: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of both; of a key in both, the preferred row as a whole."""
    return preferred.unionByName(other.join(preferred.select(*keys).distinct(), keys, "left_anti"))


def guarded_merge(preferred: DataFrame, other: DataFrame, scope: list[str], keys: list[str]) -> DataFrame:
    """As :func:`shallow_merge` with ``other`` existing before: a scope that it has rows of takes none from the preferred source."""
    blocked = other.select(*scope).distinct()
    return shallow_merge(preferred.join(blocked, scope, "left_anti"), other, keys)


def without_stale(runs: DataFrame, metrics: DataFrame, prefix: str) -> tuple[DataFrame, DataFrame]:
    """Runs (doc, run) whose slug doesn't begin with ``prefix``, and the metrics (doc, run, ...) of these."""
    kept = runs.where(~F.col("run").startswith(prefix))
    return kept, metrics.join(runs.where(F.col("run").startswith(prefix)).select("doc", "run").distinct(), ["doc", "run"], "left_anti")


def filled(target: DataFrame, filler: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``target`` with blank values taken from ``filler``, and the keys that only ``filler`` has."""
    blank = F.nullif(F.trim(F.col(value).cast("string")), F.lit(""))
    return first_wins(target.withColumn(value, blank), filler, keys, [value])


def with_stated_hyperparameters(architectures: DataFrame, stated: DataFrame, evidence: str = "hyperparams") -> DataFrame:
    """Hyperparameters (doc, architecture, name, value, evidence) of extracted architectures, completed by stated ones (doc, name, value).

    Each architecture of a document takes the stated hyperparameters whose slug it doesn't
    have, and their values where its own are blank.  Documents without stated ones, and
    documents without architectures, stay as they are.
    """
    keyed = lambda df: df.withColumn("_slug", slug(F.col("name")))
    each = architectures.select("doc", "architecture").distinct().join(keyed(stated), "doc")
    filler = each.select("doc", "architecture", "_slug", F.col("name").alias("_name"), F.col("value").alias("_value"))
    own = keyed(architectures.where("name IS NOT NULL"))
    both = own.join(filler, ["doc", "architecture", "_slug"], "full")
    blank = F.coalesce(F.trim(F.col("value").cast("string")), F.lit("")) == ""
    taken = blank & F.col("_value").isNotNull()
    cited = F.concat(F.lit(evidence + "."), F.coalesce("_name", "name"))
    return both.select("doc", "architecture", F.coalesce("name", "_name").alias("name"), F.when(taken, F.col("_value")).otherwise(F.col("value")).alias("value"), F.when(taken, cited).otherwise(F.col("evidence")).alias("evidence"))


def with_training_run(documents: DataFrame, runs: DataFrame, stated: DataFrame) -> DataFrame:
    """Training runs (doc, run, optimizer, loss): those extracted, one made up for a document (doc, model) with stated hyperparameters (doc, name, value) that has none, both completed by the stated optimizer and loss."""
    some = stated.select("doc").distinct()
    made = documents.join(some, "doc", "left_semi").join(runs.select("doc").distinct(), "doc", "left_anti")
    null = F.lit(None).cast("string")
    every = runs.select("doc", "run", "optimizer", "loss").unionByName(made.select("doc", F.concat(slug(F.col("model")), F.lit("_training_run")).alias("run"), null.alias("optimizer"), null.alias("loss")))
    of = lambda name: F.max(F.when(F.col("name") == name, F.col("value")))
    fill = stated.groupBy("doc").agg(of("optimizer").alias("_optimizer"), of("loss").alias("_loss"))
    whole = lambda c: F.coalesce(F.nullif(F.trim(F.col(c)), F.lit("")), F.col(f"_{c}")).alias(c)
    return every.join(fill, "doc", "left").select("doc", "run", whole("optimizer"), whole("loss"))


def hoisted(nested, top):
    """A nested section, or the top-level one of that name where it is missing."""
    return F.coalesce(nested, top)
