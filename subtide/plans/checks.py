"""The data-quality checks over a ``Lifecycle``."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from subtide.functions import outside, sort_keys
from subtide.operators import quality
from subtide.operators.core import value_counts
from subtide.plans.lifecycle import Lifecycle
from subtide.schemas import (
    CHANNEL,
    EVENT_SOURCE,
    GENDER,
    REASONS_BY_TYPE,
    STAGE_ORDER,
    STAGES,
    TABLES,
)


def table_row_counts(lc: Lifecycle) -> DataFrame:
    return quality.table_row_counts(lc.tables())


def customer_profile(lc: Lifecycle) -> DataFrame:
    return quality.column_profile(
        lc.customers, "signup_date", ["state_code", "acquisition_channel", "gender"]
    )


def customer_domains(lc: Lifecycle, channels: list[str] = CHANNEL) -> DataFrame:
    signup = F.col("signup_date")
    last_day = date.fromisoformat(lc.cutoff[:10])
    return quality.violations(
        lc.customers,
        {
            "gender": outside("gender", GENDER),
            "signup_date": signup.isNull() | (signup > F.lit(last_day)),
            "state_code": F.col("state_code").isNull() | (F.length(F.rtrim("state_code")) != 2),
            "channel": outside("acquisition_channel", channels),
        },
    )


def plan_listing(lc: Lifecycle) -> DataFrame:
    return lc.plans.select("plan_name", "monthly_price", "is_available").orderBy(
        *sort_keys("monthly_price")
    )


def duplicate_plan_names(lc: Lifecycle) -> DataFrame:
    return quality.duplicate_keys(lc.plans, ["plan_name"])


def subscription_status_counts(lc: Lifecycle) -> DataFrame:
    return value_counts(lc.subscriptions, ["subscription_status"]).orderBy(
        *sort_keys("subscription_status")
    )


def state_timestamps(lc: Lifecycle) -> DataFrame:
    both = ["activated_at", "ended_at"]
    rule = quality.state_timestamp_rule(
        "subscription_status",
        required={
            "active": ["activated_at"],
            "cancelled": both,
            "completed": both,
            "rejected": ["ended_at"],
        },
        empty={"pending": both, "active": ["ended_at"], "rejected": ["activated_at"]},
    )
    return quality.violations(
        lc.subscriptions.select(
            "subscription_id", "subscription_status", "selected_at", "activated_at", "ended_at"
        ),
        {"state": rule},
    )


def activation_prerequisites(lc: Lifecycle) -> DataFrame:
    return quality.prerequisite_violations(lc.subscriptions, lc.intakes)


def intake_consistency(lc: Lifecycle) -> DataFrame:
    return quality.child_status_consistency(lc.intakes, lc.subscriptions)


def rejection_timing(lc: Lifecycle) -> DataFrame:
    return quality.rejection_timing_counts(lc.subscriptions, lc.intakes)


def appointment_rules(lc: Lifecycle) -> DataFrame:
    return quality.appointment_rules(lc.appointments)


def appointment_result_counts(lc: Lifecycle) -> DataFrame:
    return value_counts(lc.appointments, ["appointment_status", "eligibility_result"]).orderBy(
        *sort_keys("appointment_status", "eligibility_result")
    )


def follow_up_population(lc: Lifecycle) -> DataFrame:
    return quality.eligible_population(lc.subscriptions, lc.cutoff).orderBy(
        *sort_keys("subscription_status")
    )


def appointment_timeline(lc: Lifecycle) -> DataFrame:
    return quality.timeline_violations(lc.subscriptions, lc.appointments, lc.intakes, lc.cutoff)


def payment_rules(lc: Lifecycle) -> DataFrame:
    payments = lc.payments.select(
        "payment_id", "subscription_id", "payment_status", "payment_type", "payment_date", "amount"
    )
    return quality.amount_vs_reference(payments, lc.subscriptions, lc.plans, lc.cutoff)


def initial_payment_cardinality(lc: Lifecycle) -> DataFrame:
    return quality.child_cardinality(
        lc.appointments.filter(F.col("appointment_type") == "initial_appt"),
        lc.payments.filter(F.col("payment_type") == "initial"),
        "subscription_id",
        "payment_id",
    )


def renewals_after_initial(lc: Lifecycle) -> DataFrame:
    payments = lc.payments.select(
        "subscription_id", "payment_id", "payment_type", "payment_date"
    )
    return quality.after_first_event(
        payments, "subscription_id", "payment_type", "payment_date", "initial", "renewal"
    ).drop("payment_type")


def payment_status_summary(lc: Lifecycle) -> DataFrame:
    return value_counts(
        lc.payments, ["payment_type", "payment_status"], sums={"total_amount": "amount"}
    )


def refund_rules(lc: Lifecycle) -> DataFrame:
    refunds = lc.refunds.select(
        "refund_id",
        "payment_id",
        "refund_status",
        "refund_reason",
        "refund_amount",
        "processed_at",
    )
    return quality.refund_rules(refunds, lc.payments)


def refund_summary(lc: Lifecycle) -> DataFrame:
    return value_counts(
        lc.refunds, ["refund_reason", "refund_status"], sums={"total_amount": "refund_amount"}
    ).orderBy(*sort_keys("refund_reason", "refund_status"))


def event_reasons(lc: Lifecycle) -> DataFrame:
    rule = quality.conditional_domain_rule("event_type", "event_reason", REASONS_BY_TYPE)
    return quality.violations(lc.subscription_events, {"reason": rule})


def lifecycle_coverage(lc: Lifecycle) -> DataFrame:
    return quality.lifecycle_coverage(
        lc.subscription_events,
        lc.subscriptions,
        "subscription_id",
        "subscription_status",
        "event_type",
        STAGES,
    )


def duplicate_events(lc: Lifecycle) -> DataFrame:
    return quality.duplicate_keys(lc.subscription_events, ["subscription_id", "event_type"])


def event_chronology(lc: Lifecycle) -> DataFrame:
    return quality.chronology_violations(
        lc.subscription_events,
        lc.subscriptions,
        "subscription_id",
        "event_type",
        "event_timestamp",
        STAGES,
        STAGE_ORDER,
    )


def event_source_times(lc: Lifecycle) -> DataFrame:
    events = lc.subscription_events.select("subscription_id", "event_type", "event_timestamp")
    return quality.source_consistency(
        events, lc.subscriptions, "subscription_id", "event_type", "event_timestamp", EVENT_SOURCE
    )


def check_constraints(lc: Lifecycle) -> DataFrame:
    """Failed rows per declared check of all eight tables, one pass over each table.

    A table without a column that one of its checks reads is an error.
    """
    found = [
        quality.check_constraints(df, name, TABLES[name].all_checks())
        for name, df in lc.tables().items()
    ]
    return reduce(DataFrame.unionByName, found)


def referential_integrity(lc: Lifecycle, parents: dict[str, DataFrame] | None = None) -> DataFrame:
    """Orphans of every declared reference; ``parents`` replaces tables in the parent role."""
    tables = lc.tables()
    known = tables | (parents or {})
    return quality.referential_integrity(
        {
            f"{name}.{key}": (tables[name], key, known[parent], TABLES[parent].key)
            for name, table in TABLES.items()
            for key, parent in table.references.items()
        }
    )


def uniqueness(lc: Lifecycle) -> DataFrame:
    tables = lc.tables()
    return quality.uniqueness(
        {
            f"{name}.{key}": (tables[name], [key])
            for name, table in TABLES.items()
            for key in (table.key, *table.unique)
        }
    )
