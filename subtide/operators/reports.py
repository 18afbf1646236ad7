"""Business reports: funnels, conversion, shares, durations, net amounts, transitions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from subtide.functions import month_start, ntz, pct
from subtide.operators.core import (
    duration_stats,
    roll_up,
    rows_of,
    share_of_total,
    stage_flags,
    with_share,
)


def stage_funnel(
    events: DataFrame,
    entities: DataFrame,
    dims: DataFrame,
    entity: Sequence[str],
    link: Sequence[str],
    dim_key: str,
    stage_col: str,
    stages: Mapping[str, str],
    rates: Mapping[str, tuple[str, str]],
) -> DataFrame:
    """Distinct entities reaching each stage per dimension row, with step rates.

    Events shrink to one flag row per entity before the join, which gives the exact distinct
    counts without expanding the rows once per stage. Dimension rows without any entity keep
    zero counts and NULL rates. ``link`` are the entity columns that ``entities`` is keyed by.
    """
    flags = stage_flags(events, entity, stage_col, stages)
    once = entities.select(*link, dim_key).distinct()
    reached = roll_up(flags, once, link, [dim_key], {s: ("sum", F.col(s)) for s in stages})
    counts = dims.join(reached, dim_key, "left").select(
        *dims.columns, *[F.coalesce(F.col(s), F.lit(0)).alias(s) for s in stages]
    )
    return counts.select("*", *[pct(a, b).alias(name) for name, (a, b) in rates.items()])


def reason_share(
    events: DataFrame, types: Sequence[str], type_col: str, reason_col: str, entity: str
) -> DataFrame:
    """Distinct entities per (type, reason) and their share within the type."""
    return share_of_total(
        events.filter(F.col(type_col).isin(*types)),
        by=[reason_col],
        within=[type_col],
        entity=entity,
        count="entity_count",
        total="type_total",
        share="reason_pct",
    )


def conversion_by_dimension(
    facts: DataFrame, members: DataFrame, entity: str, member: str, dim: str, converted: Column
) -> DataFrame:
    """Distinct entities and converted entities per dimension value of their member.

    An entity stored several times counts once: its rows become one per member, then one per
    dimension value, which also holds if it is stored under several members.
    """
    once = facts.groupBy(entity, member).agg(F.max(converted.cast("int")).alias("_converted"))
    placed = once.join(members.select(member, dim), member)
    per_entity = placed.groupBy(dim, entity).agg(F.max("_converted").alias("_converted"))
    counts = per_entity.groupBy(dim).agg(
        F.count(entity).alias("selected_count"),
        F.sum(F.when(F.col(entity).isNotNull(), F.col("_converted"))).alias("converted_count"),
    )
    return counts.withColumn("conversion_pct", pct("converted_count", "selected_count"))


def conditional_sums(
    facts: DataFrame,
    bridge: DataFrame,
    on: Sequence[str],
    keys: Sequence[str],
    value: str,
    cond_col: str,
    values: Mapping[str, str],
) -> DataFrame:
    """Row count, one sum per condition value (NULL without a match) and the total."""
    measures = {"row_count": rows_of()}
    for name, wanted in values.items():
        measures[name] = ("sum", F.when(F.col(cond_col) == wanted, F.col(value)))
    measures["total_amount"] = ("sum", F.col(value))
    return roll_up(facts, bridge, on, keys, measures)


def net_of_adjustments(
    base: DataFrame,
    adjustments: DataFrame,
    key: str,
    amount: str,
    adjusted: str,
    bridge: DataFrame,
    on: Sequence[str],
    keys: Sequence[str],
) -> DataFrame:
    """Gross, adjustments (0 if none), net and adjustment percentage per dimension.

    Adjustments are summed per base row first, so several on one row never count it twice.
    """
    per_row = adjustments.groupBy(key).agg(F.sum(adjusted).alias("_adjusted"))
    sums = roll_up(
        base.select(key, *on, amount).join(per_row, key, "left"),
        bridge,
        on,
        keys,
        {
            "gross_amount": ("sum", F.col(amount)),
            "_adjusted": ("sum", F.col("_adjusted")),
        },
    )
    none = F.lit(0).cast("decimal(10,2)")
    sums = sums.withColumn("adjusted_amount", F.coalesce(F.col("_adjusted"), none))
    return sums.select(
        *keys,
        "gross_amount",
        "adjusted_amount",
        (F.col("gross_amount") - F.col("adjusted_amount")).alias("net_amount"),
        pct("adjusted_amount", "gross_amount").alias("adjusted_pct"),
    )


def extreme_period_changes(df: DataFrame, ts: str, value: str) -> DataFrame:
    """Months whose change against the previous observed month is the smallest or largest.

    Ties are kept, and comparing happens before rounding. The windows run over one row per
    month. The first month has no change and never matches.
    """
    monthly = df.groupBy(month_start(ts).alias("period")).agg(F.sum(value).alias("amount"))
    return extreme_changes(monthly)


def extreme_changes(monthly: DataFrame) -> DataFrame:
    """The same from rows of (period, amount), one per month."""
    in_order = Window.orderBy("period")
    overall = Window.partitionBy()
    previous = F.nullif(F.col("previous_amount"), F.lit(0).cast("decimal(20,2)"))
    gain = (F.col("amount") - F.col("previous_amount")).cast("decimal(20,2)")
    changes = (
        monthly.withColumn("amount", F.col("amount").cast("decimal(20,2)"))
        .withColumn("previous_amount", F.lag("amount").over(in_order))
        .withColumn("_change", F.lit(100).cast("decimal(3,0)") * gain / previous)
        .withColumn("_least", F.min("_change").over(overall))
        .withColumn("_most", F.max("_change").over(overall))
    )
    extreme = (F.col("_change") == F.col("_least")) | (F.col("_change") == F.col("_most"))
    return changes.filter(extreme).select(
        "period",
        "amount",
        "previous_amount",
        F.round("_change", 2).cast("double").alias("change_pct"),
    )


def in_period(df: DataFrame, ts: str, start: str, end: str) -> DataFrame:
    """Rows with ``start <= ts < end``; the bounds reach the parquet scan."""
    return df.filter((F.col(ts) >= ntz(start)) & (F.col(ts) < ntz(end)))


def period_comparison(
    df: DataFrame, ts: str, start: str, end: str, by: str, value: str
) -> DataFrame:
    """Row count and amount per month and group inside a half-open range."""
    return (
        in_period(df, ts, start, end)
        .groupBy(month_start(ts).alias("period"), by)
        .agg(F.count(F.lit(1)).alias("row_count"), F.sum(value).alias("total_amount"))
    )


def period_status_share(
    df: DataFrame, ts: str, start: str, end: str, by: str, value: str
) -> DataFrame:
    """Row count, share within the month and amount per status inside a half-open range.

    The window sees one row per month and status, and lets the range be read only once.
    """
    counted = period_comparison(df, ts, start, end, by, value)
    whole = F.sum("row_count").over(Window.partitionBy("period"))
    return counted.withColumn("status_pct", pct("row_count", whole))


def outcome_split_by_dimension(
    df: DataFrame,
    bridge: DataFrame,
    on: Sequence[str],
    keys: Sequence[str],
    outcome: str,
    values: Sequence[str],
) -> DataFrame:
    """Rows per dimension, rows per outcome value and the percentages.

    A NULL outcome counts in the total only.
    """
    measures = {"row_count": rows_of()}
    for value in values:
        measures[value] = rows_of(F.col(outcome) == value)
    counts = roll_up(df, bridge, on, keys, measures)
    return counts.select("*", *[pct(v, "row_count").alias(f"{v}_pct") for v in values])


def event_pairs(
    events: DataFrame,
    entity: str,
    type_col: str,
    ts: str,
    start_type: str,
    end_type: str,
) -> DataFrame:
    """First start event and last end event of each entity that has both."""
    pairs = (
        events.filter(F.col(type_col).isin(start_type, end_type))
        .groupBy(entity)
        .agg(
            F.min(F.when(F.col(type_col) == start_type, F.col(ts))).alias("started_at"),
            F.max(F.when(F.col(type_col) == end_type, F.col(ts))).alias("finished_at"),
        )
    )
    return pairs.filter(F.col("started_at").isNotNull() & F.col("finished_at").isNotNull())


def event_pair_duration(
    events: DataFrame,
    entities: DataFrame,
    entity: str,
    type_col: str,
    ts: str,
    start_type: str,
    end_type: str,
    keys: Sequence[str],
    unit: str = "day",
) -> DataFrame:
    """Duration statistics between two event types, per dimension of the entity."""
    pairs = event_pairs(events, entity, type_col, ts, start_type, end_type)
    return duration_stats(
        pairs.join(entities.select(entity, *keys), entity), "started_at", "finished_at", keys, unit
    )


def entity_frequency(df: DataFrame, entity: str) -> DataFrame:
    """How many entities have 1, 2, 3, ... rows, the rows they stand for and the share."""
    per_entity = df.groupBy(entity).agg(F.count(F.lit(1)).alias("rows_per_entity"))
    histogram = per_entity.groupBy("rows_per_entity").agg(
        F.count(entity).alias("entity_count"),
    )
    shares = with_share(histogram, "entity_count", [], "total_entities", "entity_pct")
    return shares.withColumn("rows_represented", F.col("rows_per_entity") * F.col("entity_count"))


def nth_transition(
    df: DataFrame, entity: str, order_by: Sequence[str], state: str, n: int = 2
) -> DataFrame:
    """Count (first state, n-th state) pairs over entities that have at least n rows.

    The row-number filter is applied before the shuffle as well, so every task
    sends at most n rows per entity, however long one entity's history is.
    """
    position = F.row_number().over(Window.partitionBy(entity).orderBy(*order_by))
    early = df.withColumn("_n", position).filter(F.col("_n") <= n)
    pairs = early.groupBy(entity).agg(
        F.max("_n").alias("_n"),
        F.max(F.when(F.col("_n") == 1, F.col(state))).alias("first_state"),
        F.max(F.when(F.col("_n") == n, F.col(state))).alias("nth_state"),
    )
    return (
        pairs.filter(F.col("_n") == n)
        .groupBy("first_state", "nth_state")
        .agg(F.count(F.lit(1)).alias("entity_count"))
    )


def status_crosstab(
    children: DataFrame, parents: DataFrame, on: Sequence[str], child_col: str, parent_col: str
) -> DataFrame:
    """Counts of (child status, parent status), long form."""
    counted = children.groupBy(*on, child_col).agg(F.count(F.lit(1)).alias("_rows"))
    return (
        counted.join(parents.select(*on, parent_col), list(on))
        .groupBy(child_col, parent_col)
        .agg(F.sum("_rows").alias("row_count"))
    )


def exit_rate_by_dimension(
    df: DataFrame, keys: Sequence[str], status_col: str, exit_status: str
) -> DataFrame:
    """Rows, rows with the exit status (NULL if none) and the percentage, in one pass."""
    counts = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("entity_count"),
        F.sum(F.when(F.col(status_col) == exit_status, 1)).alias("exit_count"),
    )
    return counts.withColumn("exit_pct", pct("exit_count", "entity_count"))


def exit_reason_share_by_dimension(
    events: DataFrame,
    entities: DataFrame,
    entity: str,
    type_col: str,
    exit_type: str,
    reason_col: str,
    keys: Sequence[str],
) -> DataFrame:
    """Distinct entities per dimension and exit reason, with the share inside the dimension."""
    once = events.filter(F.col(type_col) == exit_type).select(entity, reason_col).distinct()
    counted = (
        once.join(entities.select(entity, *keys).distinct(), entity)
        .groupBy(*keys, reason_col)
        .agg(F.count(F.lit(1)).alias("entity_count"))
    )
    return with_share(counted, "entity_count", keys, "dimension_total", "reason_pct")


