"""Gap-free numbering without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from subtide.operators.core import sized_broadcast
from subtide.sources import written

# Bytes of input for each range; a range is one task's sort and cannot be split later. Stored rows grow about
# eightfold in memory, and a sort that does not fit is spilled whole.
RANGE_BYTES = 16 << 20
MOST_RANGES = 1_000_000

# Up to 200 ranges map tasks write without sorting (spark.shuffle.sort.bypassMergeThreshold), so ranges of
# larger tables grow to this size first.
FEW_RANGES = 200
LARGE_RANGE_BYTES = 64 << 20

# monotonically_increasing_id keeps the task number above bit 33 and the row number below it.
_TASK_BITS = 33


def dense_number(
    df: DataFrame,
    order_by: Sequence[str | Column],
    partition_by: Sequence[str] = (),
    name: str = "row_no",
    start: int = 1,
    no_ties: bool = False,
    drop: Sequence[str] = (),
    spread_copies: bool = False,
    ranges: int | None = None,
) -> DataFrame:
    """Number rows ``start, start + 1, ...`` over the whole table or inside each group.

    Rows are range-partitioned by group and order, so one group holding most rows is spread
    over as many tasks as its size needs. The sorted rows are written once; one narrow pass
    then counts rows per (task, group), and a prefix sum over those counts gives each slice its
    offset. Writing is what makes the two passes agree: range bounds are sampled and may differ
    on a second run.

    Rows equal in ``order_by`` are ordered by a hash of their content, so the numbers are
    repeatable and one frequent value is spread as well; ``no_ties`` skips the hash where the
    order is known to be unique. Exact copies of a row have one hash. ``spread_copies`` writes
    the rows first and tells copies apart by their place in the written table, which a retried
    task reads back unchanged; use it where one row may be copied very often and no position,
    such as ``read_positioned_csv`` gives, is part of the order. Columns that only serve the
    order can be named in ``drop``: they take part in the shuffle but are not written.

    ``ranges`` is the number of range partitions. Without it the input's estimated size decides,
    ``RANGE_BYTES`` each, but at least the session's shuffle partitions. Beyond ``FEW_RANGES`` a range has
    ``LARGE_RANGE_BYTES``. The result reads the sorted table and the offsets, both written, so using it again
    counts and sorts nothing.
    """
    if spread_copies:
        df = written(df).withColumn("_place", F.monotonically_increasing_id())
        order_by, drop = [*order_by, "_place"], [*drop, "_place"]
    group = list(partition_by)
    order = [F.col(c) if isinstance(c, str) else c for c in order_by]
    keys = [*[F.col(c) for c in group], *order, *([] if no_ties else _content_hash(df))]
    ranged = df.repartitionByRange(min(ranges or _ranges(df), MOST_RANGES), *keys).sortWithinPartitions(*keys)
    kept = [c for c in df.columns if c not in drop]
    table = written(ranged.select(*kept, F.monotonically_increasing_id().alias("_pos")))
    table = table.withColumn("_task", F.shiftright("_pos", _TASK_BITS))

    slices = table.groupBy("_task", *group).agg(
        F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = Window.partitionBy(*group).orderBy("_task").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = slices.select(
        "_task",
        *group,
        (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + start).alias(
            "_shift"
        ),
    )
    # Sent to all tasks, so that the numbered table is not shuffled again. They are written, so whoever uses the
    # result again does not count again, and measured: without groups there is one row per range, with
    # very many groups they stay a normal join side; a hot group is then still cut by task.
    offsets = sized_broadcast(offsets)
    same_slice = F.col("t._task") == F.col("o._task")
    for g in group:
        same_slice &= F.col(f"t.{g}").eqNullSafe(F.col(f"o.{g}"))
    return (
        table.alias("t")
        .join(offsets.alias("o"), same_slice)
        .select(
            *[F.col(f"t.{c}") for c in kept],
            (F.col("t._pos") + F.col("o._shift")).alias(name),
        )
    )


def _ranges(df: DataFrame) -> int:
    estimate = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    size = int(str(estimate))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = min(max(least, size // RANGE_BYTES), FEW_RANGES)
    return min(max(few, size // LARGE_RANGE_BYTES), MOST_RANGES)


def dealt_by(df: DataFrame, *keys: str) -> DataFrame:
    """Rows dealt by a key, ahead of an aggregate by a key that hardly repeats.

    Such an aggregate reduces nothing before the shuffle, but holds nearly all rows of a map task in its hash
    table and spills them. Dealt first, rows are only aggregated where they arrive, in partitions sized like the
    ranges of ``dense_number``: map tasks need no memory up to ``FEW_RANGES`` of them. A key that repeats very
    often passes through one task, as one group. Rows of unknown size go to the session's shuffle partitions.
    """
    parts = _ranges(df)
    return df.repartition(parts, *keys) if parts < MOST_RANGES else df.repartition(*keys)


def _content_hash(df: DataFrame) -> list[Column]:
    hashable = [
        f.name
        for f in df.schema
        if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))
    ]
    return [F.xxhash64(*[F.col(f"`{c}`") for c in hashable])] if hashable else []


def every_nth(
    df: DataFrame,
    order_by: Sequence[str | Column],
    n: int,
    keep: Sequence[int] = (0,),
    partition_by: Sequence[str] = (),
    first: int = 1,
    name: str = "row_no",
) -> DataFrame:
    """Keep rows whose number, counted from ``first``, leaves one of the remainders ``keep``.

    A repeatable sample by position: ``n=5, keep=(0,)`` takes rows 5, 10, 15, ... of each group.
    """
    numbered = dense_number(df, order_by, partition_by, name, start=first)
    return numbered.filter((F.col(name) % n).isin(*keep))
