"""Exact distinct counts, repeats and orphans of integer keys by bitmaps.

A key belongs to a bucket of 32,768 neighbouring values and is one bit of the bucket's bitmap. Bitmaps of
a bucket merge by OR, so tasks send one bitmap of 4 KB per bucket instead of their values, and a key that
is a third of all rows is one bit. That pays where a task's values lie close together, as ids do that were
given in order. ``close_together`` measures it: one pass that counts the buckets per task, for any
number of columns, and sends one number per task and bucket. Results do not depend on the answer.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from subtide.operators.core import BROADCAST_BYTES

BITMAP_BYTES = 4096
VALUE_BYTES = 8

# Neighbouring values that are counted in one row.
SLOT_BITS = 3
SLOTS = 1 << SLOT_BITS


def is_integer(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, (ByteType, ShortType, IntegerType, LongType))


def _bucket(column: str):
    return F.bitmap_bucket_number(F.col(column).cast("long"))


def _bit(column: str):
    return F.bitmap_bit_position(F.col(column).cast("long"))


def close_together(columns: Sequence[tuple[DataFrame, str]]) -> list[int | None]:
    """Per integer column the number of (task, bucket) pairs, or None where bitmaps would be larger
    than the values they stand for. One job, whatever the number of columns."""
    looked = [
        df.select(
            F.lit(i).alias("column"),
            F.spark_partition_id().alias("task"),
            _bucket(name).alias("bucket"),
        )
        for i, (df, name) in enumerate(columns)
        if is_integer(df, name)
    ]
    found: list[int | None] = [None] * len(columns)
    if looked:
        pairs = reduce(DataFrame.unionAll, looked).groupBy("column", "task", "bucket").count()
        sizes = pairs.groupBy("column").agg(F.count("*").alias("pairs"), F.sum("count").alias("rows"))
        for r in sizes.collect():
            # A few bitmaps are always fine.
            if r["pairs"] * BITMAP_BYTES <= max(r["rows"] * VALUE_BYTES, 64 * BITMAP_BYTES):
                found[r["column"]] = r["pairs"]
    return found


def bitmaps(df: DataFrame, column: str) -> DataFrame:
    """Rows of (bucket, bitmap, row_count) over the values of a column that are not NULL."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(_bucket(column).alias("bucket"))
        .agg(
            F.bitmap_construct_agg(_bit(column)).alias("bitmap"),
            F.count(F.lit(1)).alias("row_count"),
        )
    )


def distinct_count(df: DataFrame, column: str, name: str) -> DataFrame:
    """One row with the number of different values that are not NULL."""
    counted = F.coalesce(F.sum(F.bitmap_count("bitmap")), F.lit(0))
    return bitmaps(df, column).agg(counted.alias(name))


def _in_buckets(df: DataFrame, column: str, buckets: DataFrame, pairs: int) -> DataFrame:
    """The rows whose value is in one of some buckets, of which there are ``pairs`` at most."""
    side = F.broadcast(buckets) if pairs * 2 * VALUE_BYTES <= BROADCAST_BYTES else buckets
    return df.withColumn("bucket", _bucket(column)).join(side, "bucket", "left_semi").drop("bucket")


def repeats(df: DataFrame, column: str, pairs: int) -> DataFrame:
    """Rows of (value, row_count) for the values that occur more than once.

    Only buckets with more rows than bits hold one; rows of others are not shuffled. NULL counts as a value.
    """
    full = bitmaps(df, column).filter(F.col("row_count") > F.bitmap_count("bitmap")).select("bucket")
    rows = df.select(F.col(column).cast("long").alias("value"))
    some = _in_buckets(rows.filter("value IS NOT NULL"), "value", full, pairs)
    counted = some.groupBy("value").agg(F.count(F.lit(1)).alias("row_count"))
    empty = rows.filter("value IS NULL").groupBy("value").agg(F.count(F.lit(1)).alias("row_count"))
    return counted.unionAll(empty).filter(F.col("row_count") > 1)


def missing(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, pairs: int) -> DataFrame:
    """Rows of (missing_key, row_count) for the child's values that the parent has not; NULL is none.

    A bucket holds one if the bitmap of both sides together has more bits than the parent's. Only
    values of such buckets are shuffled, several to a row.
    """
    both = bitmaps(child, child_key).select("bucket", "bitmap", F.lit(False).alias("known"))
    both = both.unionAll(bitmaps(parent, parent_key).select("bucket", "bitmap", F.lit(True).alias("known")))
    merged = both.groupBy("bucket").agg(
        F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("all_bits"),
        F.max(F.when(F.col("known"), F.bitmap_count("bitmap"))).alias("known_bits"),
    )
    gaps = merged.filter("all_bits > coalesce(known_bits, 0)").select("bucket")
    used, known = (
        _in_buckets(df.select(F.col(key).cast("long").alias("value")).filter("value IS NOT NULL"), "value", gaps, pairs)
        for df, key in ((child, child_key), (parent, parent_key))
    )
    return _unmatched(used, known)


def _unmatched(used: DataFrame, known: DataFrame) -> DataFrame:
    """Rows of (missing_key, row_count) for the values of ``used`` that ``known`` has not; both hold no NULL.

    ``SLOTS`` neighbouring values share one row: a count for each and a bit for each known one. Where values lie close
    together, that is a small part of what a row per value takes, and one aggregate holds both sides.
    """
    slot = (F.col("value").bitwiseAND(F.lit(SLOTS - 1))).cast("int")
    rows = used.withColumn("used", F.lit(True)).unionAll(known.withColumn("used", F.lit(False)))
    placed = rows.select(F.shiftright("value", SLOT_BITS).alias("word"), slot.alias("slot"), "used")
    bit = F.call_function("shiftleft", F.lit(1), F.col("slot"))
    counts = [F.count_if(F.col("used") & (F.col("slot") == i)).alias(f"n{i}") for i in range(SLOTS)]
    words = placed.groupBy("word").agg(*counts, F.bit_or(F.when(F.col("used"), 0).otherwise(bit)).alias("known"))
    each = words.select("word", "known", F.posexplode(F.array(*[f"n{i}" for i in range(SLOTS)])).alias("slot", "row_count"))
    unmatched = each.filter((F.col("row_count") > 0) & (F.getbit("known", "slot") == 0))
    return unmatched.select((F.col("word") * SLOTS + F.col("slot")).alias("missing_key"), "row_count")
