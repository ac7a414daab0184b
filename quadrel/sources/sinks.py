"""Results written as files: Turtle and reports a folder for each graph, or reports of many graphs together, documents as JSON lines."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quadrel.plans.shacl import rendered
from quadrel.sources.turtle import to_documents


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the folder that the cluster names in ``spark.checkpoint.dir``; in local mode without one, below a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="quadrel-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        root = "file://" + _own[0]
    return f"{root.rstrip('/')}/quadrel/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


_own: list[str] = []


def write_turtle(quads: DataFrame, path: str, annotations: DataFrame | None = None) -> None:
    """Each graph's Turtle text, its annotations after an empty line, below ``path/g=<graph>``."""
    to_documents(quads, annotations).write.mode("overwrite").partitionBy("g").text(path)


def write_report(report: DataFrame, path: str, parts: int | None = None) -> None:
    """Each graph's validation report as text, and all results as Parquet beside it.

    A graph has a folder of its own, which takes files and renames for each; where there are many,
    name the ``parts``: each then holds the reports of its graphs whole, a JSON line for a graph
    (g, text), and results with their graph, by graph.  :func:`read_reports` reads such texts.
    """
    if parts is not None:
        report = report.repartition(parts, "g").persist()
        rendered(report).write.mode("overwrite").json(f"{path}/text")
        report.sortWithinPartitions("g").write.mode("overwrite").parquet(f"{path}/results")
    else:
        report = report.persist()
        rendered(report).write.mode("overwrite").partitionBy("g").text(f"{path}/text")
        report.write.mode("overwrite").partitionBy("g").parquet(f"{path}/results")
    report.unpersist()


def read_reports(spark: SparkSession, path: str) -> DataFrame:
    """(g, text): the reports that :func:`write_report` wrote in parts."""
    return spark.read.schema("g string, text string").json(f"{path}/text")


def write_json(df: DataFrame, path: str, by: str | None = None) -> None:
    """Rows as JSON lines, or the rows of each value of a column, which goes into the folder's name, in files of their own; characters outside ASCII stay as they are."""
    rows = df.write.mode("overwrite") if by is None else df.repartition(by).write.mode("overwrite").partitionBy(by)
    rows.json(path)


def with_fallback(df: DataFrame, fallback: DataFrame, key: str, value: str) -> DataFrame:
    """``df`` with missing values taken from a fallback table."""
    other = fallback.select(key, F.col(value).alias("_fallback"))
    return df.join(other, key, "left").withColumn(value, F.coalesce(value, "_fallback")).drop("_fallback")
