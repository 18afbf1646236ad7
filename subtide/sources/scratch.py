"""Written intermediate tables: the way lineage is cut in this library.

A table written to the cluster's shared folder survives the loss of any
executor, unlike cached blocks, and later passes read only the columns they need.
"""

from __future__ import annotations

import hashlib
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session, or a temporary one if all runs in this process."""
    root = spark.conf.get(SETTING, None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError(f"set {SETTING} to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="subtide-")
        spark.conf.set(SETTING, root)
    return f"{root.rstrip('/')}/subtide-{spark.sparkContext.applicationId}"


def written(df: DataFrame) -> DataFrame:
    """Write ``df`` as parquet below the scratch root and read it back."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# Written tables by application, name and state of their sources.
_kept: dict[tuple, DataFrame] = {}


def written_once(
    spark: SparkSession, name: str, sources: list[str], build: Callable[[], DataFrame]
) -> DataFrame:
    """The table ``name`` derived from the Parquet files at ``sources``, written on first use.

    Later uses in the application read it again, unless a file of a source was added, removed or replaced in
    between (by path, size or time) or the scratch tables were dropped.
    """
    return kept_once(spark, name, sources, lambda: written(build()))


def kept_once(
    spark: SparkSession, name: str, sources: list[str], build: Callable[[], DataFrame]
) -> DataFrame:
    """Like ``written_once`` for a ``build`` that has written its rows itself: they are not written again."""
    key = (spark.sparkContext.applicationId, name, *[(s, file_state(spark, s)) for s in sources])
    if key not in _kept:
        _kept[key] = build()
    return _kept[key]


# Path, size and time in the text of a file's status; the time of the last access is left out.
_STATUS = re.compile(r"path=([^;]*);.*?length=(\d+);.*?modification_time=(\d+);")


def file_state(spark: SparkSession, source: str) -> str:
    """A digest of the paths, sizes and times of a table's files, as Spark lists them."""
    plan = spark.read.schema("_none string").parquet(source)._jdf.queryExecution().analyzed()
    files = _STATUS.findall(plan.relation().location().allFiles().mkString("\n"))
    return hashlib.md5(repr(sorted(files)).encode()).hexdigest()


def _file(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def drop_written(spark: SparkSession) -> None:
    """Delete this application's scratch tables, once nothing reads them any more."""
    for key in [k for k in _kept if k[0] == spark.sparkContext.applicationId]:
        del _kept[key]
    system, path = _file(spark, scratch_root(spark))
    system.delete(path, True)
