"""Building blocks shared by reports, checks and transforms.

Every block aggregates by the fact's own key before any join. A key that
holds a third of all rows is then reduced map-side to one row per task, and
joins only ever see one row per key.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from subtide.functions import column, elapsed_seconds, pct, sort_keys
from subtide.sources import written

# Largest table that is ever marked for broadcast, in estimated bytes of its rows.
BROADCAST_BYTES = 256 << 20

UNIT_SECONDS = {"hour": 3600, "day": 86400}

COMBINE = {"sum": F.sum, "min": F.min, "max": F.max}


def sized_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a side for broadcast if its measured size allows; leave a larger one to the planner.

    The side is written, so it is computed once, and one aggregate measures it: 8 bytes per plain
    value and the length of each string. No row comes to the driver.
    """
    df = written(df)
    texts = [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    plain = 16 + 8 * len(df.columns)
    length = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(plain))
    size = df.agg(F.sum(length.cast("long"))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df


def roll_up(
    facts: DataFrame,
    bridge: DataFrame,
    on: Sequence[str],
    keys: Sequence[str],
    measures: Mapping[str, tuple[str, Column]],
) -> DataFrame:
    """Aggregate facts per ``on``, join the bridge that carries ``keys``, aggregate again.

    ``measures`` maps an output name to ("sum" | "min" | "max", expression), which all
    combine in two steps. A sum without any value stays NULL.
    """
    on = list(on)
    first = [COMBINE[how](expr).alias(name) for name, (how, expr) in measures.items()]
    second = [COMBINE[how](name).alias(name) for name, (how, _) in measures.items()]
    per_key = facts.groupBy(*on).agg(*first)
    return per_key.join(bridge.select(*on, *keys), on).groupBy(*keys).agg(*second)


def rows_of(condition: Column | None = None) -> tuple[str, Column]:
    """A countable measure for ``roll_up``: 1 per row, or per row meeting the condition."""
    return "sum", F.lit(1) if condition is None else F.when(condition, 1).otherwise(0)


def share_of_total(
    df: DataFrame,
    by: Sequence[str],
    within: Sequence[str] = (),
    entity: str | None = None,
    count: str = "row_count",
    total: str = "total_count",
    share: str = "share_pct",
) -> DataFrame:
    """Count rows (or distinct entities) per group, with the group's total and percentage.

    The total sums the counts of one ``within`` group.
    """
    keys = [*within, *by]
    size = F.count(F.lit(1)) if entity is None else F.count_distinct(entity)
    counted = df.groupBy(*keys).agg(size.alias(count))
    return with_share(counted, count, within, total, share)


def with_share(
    counted: DataFrame, count: str, within: Sequence[str], total: str, share: str
) -> DataFrame:
    """Add the group's total and the percentage to already counted rows.

    The totals are joined back, so no task ever holds all rows of one group, however many values
    are counted. Both branches read the same exchange.
    """
    if within:
        totals = counted.groupBy(*within).agg(F.sum(count).alias(total))
        same = [F.col(f"c.{k}").eqNullSafe(F.col(f"t.{k}")) for k in within]
        matched = counted.alias("c").join(totals.alias("t"), reduce(and_, same))
        counted = matched.select("c.*", f"t.{total}")
    else:
        counted = counted.withColumn(total, counted.agg(F.sum(count)).scalar())
    return counted.withColumn(share, pct(count, total))


def duration_stats(
    df: DataFrame,
    start: str,
    end: str,
    keys: Sequence[str],
    unit: str = "day",
    names: Sequence[str] = ("row_count", "avg_duration", "min_duration", "max_duration"),
    entity: str | None = None,
) -> DataFrame:
    """Count, average, shortest and longest time between two columns, both present.

    With ``entity`` the count is of distinct entities, the times still of all rows: rows are
    aggregated per entity first. Sums are decimals, so the order of the rows does not matter.
    """
    unit_seconds = UNIT_SECONDS[unit]
    once = [*keys, *([entity] if entity else [])]
    stats = (
        df.filter(F.col(start).isNotNull() & F.col(end).isNotNull())
        .select(*once, elapsed_seconds(start, end).alias("_s"))
        .groupBy(*once)
        .agg(
            F.count(F.lit(1)).alias("_rows"),
            F.sum("_s").alias("_sum"),
            F.min("_s").alias("_min"),
            F.max("_s").alias("_max"),
        )
    )
    if entity:
        stats = stats.groupBy(*keys).agg(
            F.count(entity).alias(names[0]),
            F.sum("_rows").alias("_rows"),
            F.sum("_sum").alias("_sum"),
            F.min("_min").alias("_min"),
            F.max("_max").alias("_max"),
        )
    else:
        stats = stats.withColumn(names[0], F.col("_rows"))
    average = F.col("_sum") / (F.col("_rows") * unit_seconds).cast("decimal(20,0)")
    return stats.select(
        *keys,
        names[0],
        F.round(average, 2).cast("double").alias(names[1]),
        F.round(F.col("_min") / unit_seconds, 2).cast("double").alias(names[2]),
        F.round(F.col("_max") / unit_seconds, 2).cast("double").alias(names[3]),
    )


def value_counts(
    df: DataFrame,
    by: Sequence[str],
    count: str = "row_count",
    sums: Mapping[str, str | Column] | None = None,
) -> DataFrame:
    """Rows and optional sums per group; NULL is a group of its own."""
    totals = [F.sum(column(expr)).alias(name) for name, expr in (sums or {}).items()]
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias(count), *totals)


def stage_flags(
    events: DataFrame, entity: Sequence[str], stage_col: str, stages: Mapping[str, str]
) -> DataFrame:
    """One row per entity, with 1 in each stage it has reached and NULL elsewhere."""
    reached = [
        F.max(F.when(F.col(stage_col) == value, 1)).alias(name) for name, value in stages.items()
    ]
    wanted = events.filter(F.col(stage_col).isin(*stages.values()))
    return wanted.groupBy(*entity).agg(*reached)


def with_place(report: DataFrame, *keys: str, name: str = "place") -> DataFrame:
    """A report with the place of each row in its order, from 1; ``keys`` as in ``sort_keys``.

    For reports: the rows are already aggregated, and one task numbers them. Rows of a table are
    numbered by ``dense_number``. The keys should leave no ties.
    """
    return report.withColumn(name, F.row_number().over(Window.orderBy(*sort_keys(*keys))).cast("long"))
