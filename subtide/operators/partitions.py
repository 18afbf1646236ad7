"""Stored tables in partitions of which only those that change are written again."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from subtide.functions import ntz
from subtide.operators.core import sized_broadcast
from subtide.operators.reports import extreme_changes
from subtide.operators.transforms import update_from
from subtide.sources import written


def _overwrite(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Replace the partitions that ``df`` has rows of, and no others."""
    dealt = df.repartition(*by)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def update_partitions(
    target: DataFrame,
    path: str,
    by: Sequence[str],
    source: DataFrame,
    on: Sequence[str],
    sets: Mapping[str, Column],
    when: Column | None = None,
) -> DataFrame:
    """``update_from`` on a table stored in partitions; returns the partitions written again.

    ``target`` is the table opened from ``path`` and partitioned by ``by``. Only partitions with a row that
    is updated (it has a source row and meets ``when``) are read in whole and written; the files of the
    others stay. The new rows are written to the scratch root first, as a partition cannot be read while
    it is replaced. The columns of ``by`` cannot be set. The source must hold one row per key.
    """
    if moved := set(by) & sets.keys():
        raise ValueError(f"partition columns cannot be set: {sorted(moved)}")
    t, s = target.alias("t"), source.alias("s")
    same = reduce(and_, [F.col(f"t.{c}") == F.col(f"s.{c}") for c in on])
    hit = same if when is None else same & when
    touched = written(t.join(s, hit, "left_semi").select(*by).distinct())
    side = sized_broadcast(touched).alias("p")
    of = reduce(and_, [F.col(f"t.{c}").eqNullSafe(F.col(f"p.{c}")) for c in by])
    # A semi join on partition columns: Spark reads the directories that the small side names.
    some = target.alias("t").join(side, of, "left_semi").select("t.*")
    _overwrite(written(update_from(some, source, on, sets, when)), path, by)
    return touched


class MonthlyPartials:
    """Counts and sums per month and group, stored in one partition per month.

    Reports merge them without reading the rows. ``refresh`` counts anew the months that changed, and reads no rows of
    others: the bounds of the months reach the scan. Rows without a time have a month of their own, None.
    """

    def __init__(self, spark: SparkSession, path: str, ts: str, by: Sequence[str], value: str):
        self.spark, self.path, self.ts, self.by, self.value = spark, path, ts, list(by), value

    def counted(self, rows: DataFrame) -> DataFrame:
        month = F.trunc(F.col(self.ts).cast("date"), "month").alias("month")
        counts = [F.count(F.lit(1)).alias("row_count"), F.sum(self.value).alias("amount")]
        return rows.groupBy(month, *self.by).agg(*counts)

    def refresh(self, rows: DataFrame, months: Sequence[date | None] | None = None) -> None:
        """Count all months, or only some, which may be new and may have lost all their rows."""
        if months is None:
            found = self.counted(rows).repartition("month")
            found.write.mode("overwrite").partitionBy("month").parquet(self.path)
            return
        if not months:
            return
        found = self.counted(rows.filter(reduce(or_, [self._in_month(m) for m in months])))
        # One row without a count for each month, so that a month that is empty now is replaced too.
        marks = self.spark.createDataFrame([(m,) for m in months], "month date").distinct()
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema if f.name in (*self.by, "amount")]
        marks = marks.select("month", F.lit(0).cast("long").alias("row_count"), *empty)
        _overwrite(found.unionByName(marks), self.path, ["month"])

    def _in_month(self, month: date | None) -> Column:
        if month is None:
            return F.col(self.ts).isNull()
        later = date(month.year + month.month // 12, month.month % 12 + 1, 1)
        return (F.col(self.ts) >= ntz(str(month.replace(day=1)))) & (F.col(self.ts) < ntz(str(later)))

    def read(self, rows: DataFrame) -> DataFrame:
        """The stored partials; ``rows`` gives their types only."""
        stored = self.spark.read.schema(self.counted(rows).schema).parquet(self.path)
        return stored.filter("row_count > 0")


def comparison(partials: DataFrame, start: date, end: date, by: Sequence[str]) -> DataFrame:
    """Row count and amount per month and group from ``start`` to before ``end``, both first days of months."""
    if start.day != 1 or end.day != 1:
        raise ValueError("partials know whole months only")
    some = partials.filter((F.col("month") >= F.lit(start)) & (F.col("month") < F.lit(end)))
    return some.groupBy(F.col("month").cast("timestamp_ntz").alias("period"), *by).agg(
        F.sum("row_count").alias("row_count"), F.sum("amount").alias("total_amount")
    )


def extremes(partials: DataFrame) -> DataFrame:
    """The months with the smallest and the largest change, see ``reports.extreme_period_changes``."""
    period = F.col("month").cast("timestamp_ntz").alias("period")
    return extreme_changes(partials.groupBy(period).agg(F.sum("amount").alias("amount")))
