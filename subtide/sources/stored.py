"""Stored tables: checks in the pass that writes, buckets, figures from Parquet footers."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from subtide.functions import passes
from subtide.sources.scratch import scratch_root

V1_SOURCES = "spark.sql.sources.useV1SourceList"


def save_checked(
    df: DataFrame, path: str, checks: Mapping[str, Column], mode: str = "errorifexists"
) -> dict[str, int]:
    """Write a table and return the failed rows per check, and ``row_count``, from the same pass.

    The rows that fail are written too; a check fails only when it is FALSE. The figures come from the
    tasks that write, so the table is read once. A stage that Spark runs again after a lost executor may
    be counted twice where a shuffle lies below the write; compare ``row_count`` with the table's footers
    (``open_for_figures``) where that matters.
    """
    # Names of checks need not be fit for columns.
    named = {f"c{i}": check for i, check in enumerate(checks.values())}
    counts = [F.count_if(~passes(check)).alias(name) for name, check in named.items()]
    seen = Observation(f"checks-{uuid.uuid4().hex}")
    df.observe(seen, F.count(F.lit(1)).alias("row_count"), *counts).write.mode(mode).parquet(path)
    found = seen.get
    return {"row_count": found["row_count"], **{c: found[n] for c, n in zip(checks, named)}}


def written_checked(
    df: DataFrame, table: str, checks: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """The table written below the scratch root, and its figures as (table_name, check_name, failed_rows)."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    found = save_checked(df, path, checks)
    rows = [(table, name, found[name]) for name in checks]
    figures = spark.createDataFrame(rows, "table_name string, check_name string, failed_rows long")
    return spark.read.schema(df.schema).parquet(path), figures


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str | None = None) -> DataFrame:
    """Store a table in buckets of a key, sorted by it, and open it from the catalog.

    Tables with the same number of buckets join and aggregate by the key without an exchange. Each
    bucket is one file, as the rows are dealt by the same hash first. Buckets are as uneven as the key:
    see ``open_bucketed`` for tables with a hot key.
    """
    spark = df.sparkSession
    path = path or f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, key)
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(name)
    return spark.table(name)


def largest_share(spark: SparkSession, name: str) -> float:
    """How many times the mean the largest bucket of a stored table is, by the bytes of its files."""
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    files = spark.read.parquet(details["Location"]).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("size")
    )
    sizes = files.groupBy("file").agg(F.max("size").alias("size"))
    found = sizes.agg(F.max("size").alias("most"), F.sum("size").alias("all")).first()
    return found["most"] * int(details["Num Buckets"]) / found["all"] if found["all"] else 0.0


def open_bucketed(spark: SparkSession, name: str, most: float = 4.0) -> DataFrame:
    """A bucketed table, or its files without the buckets if one of them is over ``most`` times the mean.

    A join that reads buckets has no exchange, so adaptive execution cannot split a hot key there. Without them the
    join has its exchanges again, and the hot key is split.
    """
    if largest_share(spark, name) <= most:
        return spark.table(name)
    details = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {name}").collect()}
    return spark.read.schema(spark.table(name).schema).parquet(details["Location"])


def open_for_figures(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Open Parquet so that COUNT, MIN and MAX over the whole table come from the footers.

    It holds for numbers, dates and booleans without filters or expressions; other aggregates read
    the columns as always.
    """
    before = spark.conf.get(V1_SOURCES)
    spark.conf.set(V1_SOURCES, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        reader = spark.read if schema is None else spark.read.schema(schema)
        return reader.parquet(path)
    finally:
        spark.conf.set(V1_SOURCES, before)
