"""Scratch tables and small helpers shared by the corpus operators.

Lineage is cut with tables written to the folder that the cluster names in
``spark.checkpoint.dir``.  Such a table survives the loss of any executor, can be
read again by any other, and gives later passes the very rows that earlier passes
saw.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_own_folder: list[str] = []

#: Spark drops the shuffle files of a statement when it ends while this is true.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Seconds between two collections of the driver's garbage.
TIDY_SECONDS = 10
_tidied = [time.monotonic()]


def scratch_root(spark: SparkSession) -> str:
    """The cluster's shared folder; a folder of this process only in local mode, where none is named."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir names no shared folder")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="quadrel-"))
        atexit.register(shutil.rmtree, _own_folder[0], ignore_errors=True)
    return "file://" + _own_folder[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder, grouped by application."""
    return f"{scratch_root(spark)}/quadrel/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex[:12]}"


def tidy(spark: SparkSession) -> None:
    """Collect the driver's garbage, at most once in ``TIDY_SECONDS``.

    Spark drops the broadcasts of finished steps, and the shuffle files of those that
    :func:`written` doesn't end, only when the driver's objects for them are collected; a
    driver with a roomy heap seldom does so by itself.
    """
    if time.monotonic() - _tidied[0] >= TIDY_SECONDS:
        spark.sparkContext._jvm.System.gc()
        _tidied[0] = time.monotonic()


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; what led to it can go.

    The write's shuffle files go with its end; else they would stay until the driver's
    garbage is collected, so that the disk needed would depend on when that happens.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    tidy(spark)
    return spark.read.schema(df.schema).parquet(path)


def sweep(spark: SparkSession) -> None:
    """Delete this application's scratch tables; results read from them end with them."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{scratch_root(spark)}/quadrel/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str) -> Column:
    """The text column, null read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without_ascii_space(text: Column) -> Column:
    """``text`` less every character of ``[\\x20\\x09-\\x0D]``."""
    for code in (0x20, 0x0A, 0x09, 0x0D, 0x0B, 0x0C):
        text = F.replace(text, F.lit(chr(code)), F.lit(""))
    return text


def size_batches(sizes, most_rows: int, most_units: int):
    """Cut consecutive rows into (start, end) slices of bounded count and bounded total size."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        if i > start and (i - start >= most_rows or total + size > most_units):
            yield start, i
            start, total = i, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` evaluated once for the row however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def sliced(batches, rows: int = 256):
    """The record batches in slices of ``rows`` rows, so that what becomes of them as Python objects stays small."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
