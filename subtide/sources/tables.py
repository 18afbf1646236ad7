"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from subtide.sources.scratch import written

POSITION = ("_file", "_block", "_line")
BAD_LINE = "_bad_line"


def read_table(
    spark: SparkSession, folder: str, name: str, schema: str | None = None
) -> DataFrame:
    """Open ``<folder>/<name>.parquet``; a declared schema saves the job that infers one."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{folder}/{name}.parquet")


def read_positioned_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """CSV with a header and declared types, plus columns that give each row's position.

    The header must name the declared columns, and a malformed value stops the read.
    Ordering by ``POSITION`` is file order: the file, the start of the split inside it, and
    the running number within the split's task. Splits are never reordered inside a task,
    so no single task has to read a whole large file.
    """
    return (
        spark.read.schema(schema)
        .options(header=True, mode="FAILFAST", enforceSchema=False)
        .csv(path)
        .select(
            "*",
            F.col("_metadata.file_path").alias(POSITION[0]),
            F.col("_metadata.file_block_start").alias(POSITION[1]),
            F.monotonically_increasing_id().alias(POSITION[2]),
        )
    )


def read_csv_and_violations(
    spark: SparkSession, path: str, schema: str
) -> tuple[DataFrame, DataFrame]:
    """The good rows of a CSV file, and (``POSITION``, text) of the lines that do not fit.

    A line does not fit if it has too few or too many fields or a value its declared type cannot hold; an empty
    field is NULL. Good rows have the columns of ``read_positioned_csv`` and keep the positions they have among all
    lines. The header must name the declared columns. The parsed file is written once and read by both.
    """
    fields = StructType.fromDDL(schema)
    parsed = (
        spark.read.schema(fields.add(BAD_LINE, "string"))
        .options(header=True, mode="PERMISSIVE", enforceSchema=False, columnNameOfCorruptRecord=BAD_LINE)
        .csv(path)
        .select(
            "*",
            F.col("_metadata.file_path").alias(POSITION[0]),
            F.col("_metadata.file_block_start").alias(POSITION[1]),
            F.monotonically_increasing_id().alias(POSITION[2]),
        )
    )
    kept = written(parsed)
    bad = kept.filter(F.col(BAD_LINE).isNotNull()).select(*POSITION, F.col(BAD_LINE).alias("text"))
    return kept.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE), bad


def save_table(df: DataFrame, path: str) -> None:
    """Write a new table version. The target must not be a path that ``df`` reads."""
    df.write.mode("errorifexists").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
