"""Joins of rows with the time spans they fall into."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from subtide.functions import elapsed_seconds, ntz


def time_bin(at: Column | str, width_seconds: int) -> Column:
    """The number of the bin a zone-free time falls into; bins are as wide as ``width_seconds``."""
    since = elapsed_seconds(ntz("1970-01-01 00:00:00"), at)
    return F.floor(since / F.lit(width_seconds)).cast("long")


def binned_join(
    rows: DataFrame,
    spans: DataFrame,
    key: str,
    at: str,
    low: Column,
    high: Column,
    width_seconds: int,
) -> DataFrame:
    """``rows`` with the ``spans`` of the same key that hold their time: low <= at <= high.

    A row goes to the bin of its time, a span to every bin it touches, so both meet under
    (key, bin) and the rows of one key spread over as many partitions as they have bins. A span
    no longer than a bin touches two at most; wider bins copy less, narrower ones spread more. A row
    has one bin, so it meets a span once, and the exact bounds are checked in the join. Rows without a key or
    time and spans without a key or bound meet nothing; a span that ends before it starts is empty.
    The columns are those of the key join: ``key`` once, then both sides'.
    """
    spans = spans.withColumn("_low", low).withColumn("_high", high).filter("_low <= _high")
    bins = F.sequence(time_bin("_low", width_seconds), time_bin("_high", width_seconds))
    spans = spans.withColumn("_bin", F.explode(bins))
    placed = rows.withColumn("_bin", time_bin(at, width_seconds))
    inside = F.col(at).between(F.col("_low"), F.col("_high"))
    return placed.join(spans, [key, "_bin"]).filter(inside).drop("_bin", "_low", "_high")
