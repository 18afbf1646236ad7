"""Data-quality checks. Summaries return figures; integrity checks return the violating rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from subtide.functions import days, ntz, outside, passes
from subtide.operators import bitmaps
from subtide.operators.core import sized_broadcast, stage_flags
from subtide.sources import written


def any_of(rules: Sequence[Column]) -> Column:
    return reduce(or_, rules)


def violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows for which at least one rule is TRUE."""
    return df.filter(any_of(list(rules.values())))


def violation_counts(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows meeting each rule, in a single pass."""
    return df.agg(*[F.count_if(rule).alias(name) for name, rule in rules.items()])


def check_constraints(df: DataFrame, table: str, checks: Mapping[str, Column]) -> DataFrame:
    """Rows failing each declared check, one output row per check; NULL passes."""
    failed = {name: ~passes(check) for name, check in checks.items()}
    counts = violation_counts(df, failed)
    return counts.unpivot([], list(failed), "check_name", "failed_rows").select(
        F.lit(table).alias("table_name"), "check_name", "failed_rows"
    )


def table_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count"
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def column_profile(df: DataFrame, date_col: str, distinct: Sequence[str]) -> DataFrame:
    """Row count, date range and exact distinct counts of several columns.

    Each column is counted by its own branch, and the branches' single rows are merged into one.
    Integer columns are counted by bitmaps where their values lie close together, without an exchange of
    values; other columns shuffle their values, already distinct per task.
    """
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min(date_col).alias(f"min_{date_col}"),
            F.max(date_col).alias(f"max_{date_col}"),
        )
    ]
    close = bitmaps.close_together([(df, c) for c in distinct])
    for c, pairs in zip(distinct, close):
        if pairs is None:
            parts.append(df.select(c).distinct().agg(F.count(c).alias(f"distinct_{c}")))
        else:
            parts.append(bitmaps.distinct_count(df, c, f"distinct_{c}"))
    names = [name for part in parts for name in part.columns]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return merged.agg(*[F.max(name).alias(name) for name in names])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.filter(F.col("row_count") > 1)


def uniqueness(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Per declared key: how many key values repeat and how many rows are surplus.

    Single integer keys that lie close together are compared by bitmaps first, see ``bitmaps.repeats``:
    where no value repeats, no key is shuffled.
    """
    single = [name for name, (_, keys) in tables.items() if len(keys) == 1]
    close = dict(zip(single, bitmaps.close_together([(tables[n][0], tables[n][1][0]) for n in single])))

    def repeated(name: str, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        pairs = close.get(name)
        return duplicate_keys(df, keys) if pairs is None else bitmaps.repeats(df, keys[0], pairs)

    checks = [
        repeated(name, df, keys)
        .agg(
            F.count(F.lit(1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.col("row_count") - 1), F.lit(0)).alias("surplus_rows"),
        )
        .select(F.lit(name).alias("key_name"), "duplicate_keys", "surplus_rows")
        for name, (df, keys) in tables.items()
    ]
    return reduce(DataFrame.unionByName, checks)


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child key values without a parent and how many rows carry each; a NULL key is no orphan.

    Both sides are reduced to one row per key value by one aggregate, so a key that is popular on
    either side costs nothing and no side is sorted.
    """
    used = child.select(F.col(child_key).cast("long").alias("missing_key"), F.lit(1).alias("used"))
    known = parent.select(F.col(parent_key).cast("long").alias("missing_key"), F.lit(0).alias("used"))
    counted = (
        used.unionAll(known)
        .filter(F.col("missing_key").isNotNull())
        .groupBy("missing_key")
        .agg(F.sum("used").alias("row_count"), F.min("used").alias("used"))
    )
    return counted.filter("used = 1").drop("used")


def referential_integrity(
    relations: Mapping[str, tuple[DataFrame, str, DataFrame, str]],
) -> DataFrame:
    """Orphans per relation; by bitmaps where both keys lie close together, see ``bitmaps.missing``."""
    sides = [side for c, ck, p, pk in relations.values() for side in ((c, ck), (p, pk))]
    close = bitmaps.close_together(sides)

    def missing(at: int, relation: tuple[DataFrame, str, DataFrame, str]) -> DataFrame:
        both = close[2 * at : 2 * at + 2]
        return orphans(*relation) if None in both else bitmaps.missing(*relation, sum(both))

    found = [
        missing(at, relation).select(F.lit(name).alias("relation"), "missing_key", "row_count")
        for at, (name, relation) in enumerate(relations.items())
    ]
    return reduce(DataFrame.unionByName, found)


def state_timestamp_rule(
    status: str, required: Mapping[str, Sequence[str]], empty: Mapping[str, Sequence[str]]
) -> Column:
    """TRUE where a status lacks a timestamp it needs or carries one it must not have."""
    broken = []
    for value, columns in required.items():
        broken += [(F.col(status) == value) & F.col(c).isNull() for c in columns]
    for value, columns in empty.items():
        broken += [(F.col(status) == value) & F.col(c).isNotNull() for c in columns]
    return any_of(broken)


def conditional_domain_rule(
    type_col: str, value_col: str, allowed: Mapping[str, Sequence[str] | None]
) -> Column:
    """TRUE where the value is not one its type allows; None means it must be NULL.

    A type that is not listed is not checked.
    """
    return any_of(
        [
            (F.col(type_col) == kind)
            & (F.col(value_col).isNotNull() if values is None else outside(value_col, values))
            for kind, values in allowed.items()
        ]
    )


def prerequisite_violations(subscriptions: DataFrame, intakes: DataFrame) -> DataFrame:
    """Activated subscriptions without an intake completed strictly before the activation."""
    activated = subscriptions.filter(F.col("activated_at").isNotNull()).select(
        "subscription_id", "subscription_status", "activated_at"
    )
    intake = intakes.select("subscription_id", "intake_id", "intake_status", "completed_at")
    return violations(
        activated.join(intake, "subscription_id", "left"),
        {
            "no_intake": F.col("intake_id").isNull(),
            "not_completed": ~F.col("intake_status").eqNullSafe("completed"),
            "no_completion_time": F.col("completed_at").isNull(),
            "completed_too_late": F.col("completed_at") >= F.col("activated_at"),
        },
    )


def child_status_consistency(intakes: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """Intakes whose status and timestamps disagree, or that start before the selection."""
    joined = intakes.select("subscription_id", "intake_status", "started_at", "completed_at").join(
        subscriptions.select("subscription_id", "selected_at"), "subscription_id"
    )
    return violations(
        joined,
        {
            "status": state_timestamp_rule(
                "intake_status",
                required={"completed": ["started_at", "completed_at"]},
                empty={"pending": ["completed_at"], "expired": ["completed_at"]},
            ),
            "order": F.col("started_at") < F.col("selected_at"),
        },
    )


def rejection_timing_counts(subscriptions: DataFrame, intakes: DataFrame) -> DataFrame:
    """Intakes completed, or started and expired, at or after the rejection."""
    rejected = subscriptions.filter(F.col("subscription_status") == "rejected")
    joined = rejected.select("subscription_id", "ended_at").join(
        intakes.select("subscription_id", "intake_status", "started_at", "completed_at"),
        "subscription_id",
    )
    status = F.col("intake_status")
    return violation_counts(
        joined,
        {
            "completed_after_rejection": (status == "completed")
            & (F.col("completed_at") >= F.col("ended_at")),
            "started_after_rejection": (status == "expired")
            & (F.col("started_at") >= F.col("ended_at")),
        },
    )


def appointment_rules(appointments: DataFrame) -> DataFrame:
    """Appointments whose status, completion time, type and eligibility do not fit together."""
    done = F.col("appointment_status") == "completed"
    initial = F.col("appointment_type") == "initial_appt"
    follow_up = F.col("appointment_type") == "follow_up"
    finished = F.col("completed_at").isNotNull()
    judged = F.col("eligibility_result").isNotNull()
    return violations(
        appointments,
        {
            "completed_without_time": done & ~finished,
            "time_without_completion": ~done & finished,
            "completed_initial_without_result": done & initial & ~judged,
            "open_initial_with_result": ~done & initial & judged,
            "follow_up_with_result": follow_up & judged,
        },
    )


def eligible_population(subscriptions: DataFrame, cutoff: str, min_days: int = 30) -> DataFrame:
    """Subscriptions per status that were still running ``min_days`` after activation."""
    until = F.coalesce(F.col("ended_at"), ntz(cutoff))
    running = subscriptions.filter(until >= F.col("activated_at") + days(min_days))
    return running.groupBy("subscription_status").agg(F.count(F.lit(1)).alias("eligible_count"))


def timeline_violations(
    subscriptions: DataFrame,
    appointments: DataFrame,
    intakes: DataFrame,
    cutoff: str,
    follow_up_days: int = 30,
) -> DataFrame:
    """Appointments that do not fit the intake, the activation or the end of the subscription.

    Subscription and intake join one to one first; the appointments then meet a single row.
    """
    intake = intakes.select(
        "subscription_id",
        "intake_id",
        "intake_status",
        F.col("completed_at").alias("intake_completed_at"),
    )
    context = subscriptions.select("subscription_id", "activated_at", "ended_at").join(
        intake, "subscription_id", "left"
    )
    appointment = appointments.select(
        "subscription_id",
        "appointment_id",
        "appointment_type",
        "appointment_status",
        "scheduled_at",
        F.col("completed_at").alias("appointment_completed_at"),
    )
    initial = F.col("appointment_type") == "initial_appt"
    follow_up = F.col("appointment_type") == "follow_up"
    earliest = F.col("activated_at") + days(follow_up_days)
    return violations(
        appointment.join(context, "subscription_id"),
        {
            "no_completed_intake": initial & ~F.col("intake_status").eqNullSafe("completed"),
            "before_intake": initial
            & (F.col("appointment_status") == "completed")
            & (F.col("appointment_completed_at") <= F.col("intake_completed_at")),
            "not_activated": follow_up & F.col("activated_at").isNull(),
            "too_early": follow_up & (F.col("scheduled_at") < earliest),
            "after_end": F.col("scheduled_at") > F.coalesce(F.col("ended_at"), ntz(cutoff)),
        },
    )


def amount_vs_reference(
    payments: DataFrame, subscriptions: DataFrame, plans: DataFrame, cutoff: str
) -> DataFrame:
    """Payments that differ from the plan's price, its time span or the expected status."""
    prices = sized_broadcast(plans.select("plan_id", "monthly_price"))
    # A hot subscription is split if both sides of the join are plain rows, so ``subscriptions``
    # should be a stored table, not an aggregate.
    span = subscriptions.select("subscription_id", "plan_id", "selected_at", "ended_at")
    joined = payments.join(span.join(prices, "plan_id").drop("plan_id"), "subscription_id")
    paid = F.col("payment_date")
    return violations(
        joined,
        {
            "no_date": paid.isNull(),
            "other_amount": ~F.col("amount").eqNullSafe(F.col("monthly_price")),
            "before_selection": paid < F.col("selected_at"),
            "after_end": paid > F.coalesce(F.col("ended_at"), ntz(cutoff)),
            "failed_initial": (F.col("payment_type") == "initial")
            & (F.col("payment_status") != "successful"),
        },
    )


def child_cardinality(
    parents: DataFrame, children: DataFrame, on: str, child_id: str, expected: int = 1
) -> DataFrame:
    """Parents whose number of distinct children is not the expected one, 0 included."""
    counted = children.groupBy(on).agg(F.count_distinct(child_id).alias("child_count"))
    joined = parents.select(on).distinct().join(counted, on, "left")
    return joined.withColumn("child_count", F.coalesce("child_count", F.lit(0))).filter(
        F.col("child_count") != expected
    )


def after_first_event(
    rows: DataFrame, on: str, type_col: str, ts: str, first_type: str, later_type: str
) -> DataFrame:
    """Later rows whose entity has no first row, or that are not dated after the earliest one.

    The earliest ones are written, so that the join with the later rows can split a hot entity.
    """
    firsts = written(
        rows.filter(F.col(type_col) == first_type).groupBy(on).agg(F.min(ts).alias("first_date"))
    )
    later = rows.filter(F.col(type_col) == later_type)
    return violations(
        later.join(firsts, on, "left"),
        {
            "no_first": F.col("first_date").isNull(),
            "not_after": F.col(ts) <= F.col("first_date"),
        },
    )


def refund_rules(refunds: DataFrame, payments: DataFrame) -> DataFrame:
    """Refunds without a payment, above it, before it, or completed against an unpaid one."""
    payment = payments.select(
        "payment_id", "payment_status", "amount", "payment_date", F.lit(True).alias("_found")
    )
    joined = refunds.join(payment, "payment_id", "left")
    return violations(
        joined,
        {
            "orphan": F.col("_found").isNull(),
            "too_large": F.col("refund_amount") > F.col("amount"),
            "too_early": F.col("processed_at") < F.col("payment_date"),
            "not_paid": (F.col("refund_status") == "completed")
            & ~F.col("payment_status").eqNullSafe("successful"),
        },
    ).drop("_found")


def lifecycle_coverage(
    events: DataFrame,
    entities: DataFrame,
    entity: str,
    status_col: str,
    stage_col: str,
    stages: Mapping[str, str],
) -> DataFrame:
    """Per status: distinct entities in total, and of them those having each event type."""
    flags = stage_flags(events, [entity], stage_col, stages)
    once = entities.select(entity, status_col).distinct()
    joined = once.join(flags, entity, "left")
    return joined.groupBy(status_col).agg(
        F.count(F.lit(1)).alias("total_count"),
        *[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in stages],
    )


def chronology_violations(
    events: DataFrame,
    entities: DataFrame,
    entity: str,
    type_col: str,
    ts: str,
    stages: Mapping[str, str],
    order: Sequence[tuple[str, str]],
) -> DataFrame:
    """Entities whose latest event times break one of the (earlier, later) pairs.

    Equal times break a pair; a missing side never does.
    """
    times = (
        events.filter(F.col(type_col).isin(*stages.values()))
        .groupBy(entity)
        .agg(
            *[
                F.max(F.when(F.col(type_col) == value, F.col(ts))).alias(name)
                for name, value in stages.items()
            ]
        )
    )
    broken = {f"{b}_after_{a}": F.col(b) <= F.col(a) for a, b in order}
    return violations(times, broken).join(entities.select(entity), entity, "left_semi")


def source_consistency(
    events: DataFrame,
    source: DataFrame,
    on: str,
    type_col: str,
    ts: str,
    source_column: Mapping[str, str],
) -> DataFrame:
    """Events whose time differs from the source column their type is derived from."""
    columns = list(dict.fromkeys(source_column.values()))
    joined = events.filter(F.col(type_col).isin(*source_column)).join(
        source.select(on, *columns), on, "left"
    )
    return violations(
        joined,
        {
            kind: (F.col(type_col) == kind) & ~F.col(ts).eqNullSafe(F.col(c))
            for kind, c in source_column.items()
        },
    )
