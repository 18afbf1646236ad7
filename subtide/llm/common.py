"""What the training-data operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator
from functools import wraps
from pathlib import Path

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from subtide.session import configure

# The white space of the word rule: space, tab, line feed, vertical tab, form feed, return.
SPACES = " \t\n\x0b\x0c\r"

# Bytes per batch handed to Python: bounds a worker's memory where texts are long.
BATCH_BYTES = "8m"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_shipped: set[str] = set()


def ready(spark: SparkSession) -> SparkSession:
    """The library's settings, batches of a bounded size for Python, and this package on the workers."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        folder = tempfile.mkdtemp(prefix="subtide-")  # the driver's own; Spark sends the file on
        package = Path(__file__).parent.parent
        archive = shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return configure(spark)


def words(text: str | Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text; no words for NULL."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES[1:], " " * (len(SPACES) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def lower_ascii(text: str | Column) -> Column:
    """A-Z in lower case, everything else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def trimming(batches: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """A function of batches that gives its worker's free memory back at the end of a task.

    Workers live on from stage to stage, and what one stage has freed would count for the next.
    """

    @wraps(batches)
    def run(*args, **options):
        try:
            yield from batches(*args, **options)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # glibc only
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder or file and the path in it; a bare path is local."""
    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def record_batches(rows: Iterable[dict], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of up to ``most`` rows."""
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) >= most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)
