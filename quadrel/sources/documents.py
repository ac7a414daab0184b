"""JSON, YAML and page texts as DataFrames, and the contexts built from them."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from quadrel.functions.slug import canonical_key
from quadrel.functions.values import top_level_field, whole_json
from quadrel.sources.turtle import plain_name


#: Rows that one task takes of a table whose rows become many, and the fewest for which a task of its own pays.
TASK_ROWS, LEAST_ROWS = 20_000, 1_000
#: Characters that one task takes of a table of long texts.
TASK_CHARS = 1 << 23


def tasks_of(rows: DataFrame) -> int:
    """Tasks of some ``TASK_ROWS`` rows each, more where cores would be idle and few rows are enough for one."""
    n, most = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    return max(1, -(-n // TASK_ROWS), min(most, n // LEAST_ROWS))


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """``rows`` dealt by keys to tasks of some ``TASK_ROWS`` rows each.

    A table of short rows has few parts on disk, however many statements, places or pages'
    words are made of each row; so the work of a task would grow with the table.
    """
    return rows.repartition(tasks_of(rows), *keys)


def dealt_by_length(rows: DataFrame, text: str, *keys: str) -> DataFrame:
    """``rows`` dealt by keys to tasks of some ``TASK_CHARS`` characters of ``text`` each.

    Spark hands up to 10,000 rows of a task to Python at once, however long they are.
    """
    chars, n = rows.agg(F.coalesce(F.sum(F.length(text)), F.lit(0)), F.count("*")).first()
    most = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, -(-chars // TASK_CHARS), min(most, n // LEAST_ROWS)), *keys)


def read_whole(spark: SparkSession, path: str, glob: str, recursive: bool = False) -> DataFrame:
    """(path, file, text) of the files that match."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter=glob, recursiveFileLookup=recursive)
    return files.select(F.col("_metadata.file_path").alias("path"), plain_name(F.col("_metadata.file_name")).alias("file"), F.col("value").alias("text"))


def read_json(spark: SparkSession, path: str) -> DataFrame:
    """(path, file, document VARIANT); a file that is no JSON has a null document."""
    return read_whole(spark, path, "*.json").select("path", "file", whole_json(F.col("text")).alias("document"))


@F.pandas_udf(StringType())
def yaml_to_json(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """JSON text of YAML text; null where it can't be read.  Dates become ISO text."""
    import json

    import yaml

    def one(text):
        try:
            return None if text is None else json.dumps(yaml.safe_load(text), ensure_ascii=False, default=str)
        except (yaml.YAMLError, ValueError):
            return None

    for part in parts:
        yield part.map(one)


def read_yaml(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """(path, file, text, json) of YAML files."""
    return read_whole(spark, path, "*.{yml,yaml}", recursive).withColumn("json", yaml_to_json("text"))


def joined_pages(pages: DataFrame, key: str, page: str, text: str, limit: int = 60_000) -> DataFrame:
    """(key, text): ``[page n]`` and its text for each page that isn't blank, in order, an empty line between, until ``limit`` characters of text are used; the page that meets the limit is cut.

    A budget is a running sum over the pages of one document before the current one.
    """
    order = Window.partitionBy(key).orderBy(page)
    kept = pages.where(F.trim(F.col(text)) != "").withColumn("_block", F.concat(F.lit("[page "), F.col(page).cast("string"), F.lit("]\n"), F.col(text)))
    used = F.coalesce(F.sum(F.length("_block")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cut = kept.withColumn("_left", limit - used).where("_left > 0")
    part = F.substring(F.col("_block"), F.lit(1), F.col("_left").cast("int"))
    blocks = cut.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(F.col(page).alias("n"), part.alias("t")))).alias("_b"))
    return blocks.select(key, F.array_join(F.transform("_b", lambda x: x["t"]), "\n\n").alias("text"))


def first_pages(pages: Column, count: int = 30) -> Column:
    """The first non-empty of an array of page texts, an empty line between."""
    return F.array_join(F.slice(F.filter(pages, lambda p: F.trim(p) != ""), 1, count), "\n\n")


def official_metadata(files: DataFrame, key: str = "model_key", date: str = "date_added") -> DataFrame:
    """(key, date, path) of files (path, text) that state both; of equal keys the last path counts.  A date that is none fails the query."""
    lines = F.split("text", "\r?\n")
    stated = files.select("path", top_level_field(lines, key).alias("key"), top_level_field(lines, date).alias("date")).where("key IS NOT NULL AND date IS NOT NULL")
    found = stated.groupBy(canonical_key(F.col("key")).alias("key")).agg(F.max_by("date", "path").alias("date"), F.max("path").alias("path"))
    return found.withColumn("date", F.col("date").cast("date"))


def evaluated_variant(text: Column, property_: str = "evaluatesModelVariant", strict: bool = True) -> Column:
    """The one variant, a prefixed name, that a Turtle text evaluates; unless there is just one it fails, or is null if not ``strict``."""
    found = F.array_distinct(F.regexp_extract_all(text, F.lit(property_ + r"\s+[\w-]*:([\w.-]+)"), F.lit(1)))
    other = F.raise_error(F.concat(F.lit("expected one variant, found "), F.size(found).cast("string"))) if strict else F.lit(None)
    return F.when(F.size(found) == 1, F.element_at(found, 1)).otherwise(other.cast("string"))


def date_sync(local: DataFrame, official: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Local models (key, variant) with their official date, and those without one."""
    return local.join(official, "key").select("key", "variant", "date"), local.join(official, "key", "left_anti")


def release_document(records: DataFrame) -> DataFrame:
    """(variant, block): a Turtle block for each (variant, date), in order of variants."""
    block = F.format_string('archind:%s arch:hasReleaseDate "%s"^^xsd:date .', F.col("variant"), F.date_format("date", "yyyy-MM-dd"))
    return records.select("variant", block.alias("block")).orderBy("variant")


def contexts(keys: DataFrame, sources: list[tuple[str, DataFrame]]) -> DataFrame:
    """(key, context): the texts of each source (heading, DataFrame(key, text)) that a key has, in order, under their headings."""
    out, parts = keys, []
    for i, (heading, df) in enumerate(sources):
        out = out.join(df.select("key", F.col("text").alias(f"_s{i}")), "key", "left")
        parts.append(F.when(F.col(f"_s{i}").isNotNull(), F.concat(F.lit(f"## {heading}\n"), F.col(f"_s{i}"))))
    return out.select("key", F.concat_ws("\n\n", *parts).alias("context"))
