"""The 22 business reports over a ``Lifecycle``.

Facts are aggregated before they meet the plans, so the plan join only ever
touches one row per plan and needs no broadcast of anything.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from subtide.functions import sort_keys
from subtide.operators import reports
from subtide.operators.core import duration_stats, share_of_total, value_counts
from subtide.plans.lifecycle import Lifecycle
from subtide.schemas import PAYMENT_TYPE, STAGES

SUBSCRIPTION = ["subscription_id"]
PLAN = ["plan_id"]


def _with_plan_name(per_plan: DataFrame, lc: Lifecycle) -> DataFrame:
    named = lc.plans.select("plan_id", "plan_name").join(per_plan, "plan_id")
    return named.select("plan_id", "plan_name", *[c for c in per_plan.columns if c != "plan_id"])


def _plan_of(lc: Lifecycle) -> DataFrame:
    return lc.subscriptions.select("subscription_id", "plan_id")


def stage_funnel(lc: Lifecycle) -> DataFrame:
    return reports.stage_funnel(
        lc.subscription_events,
        lc.subscriptions,
        lc.plans.select("plan_id", "plan_name"),
        entity=SUBSCRIPTION,
        link=SUBSCRIPTION,
        dim_key="plan_id",
        stage_col="event_type",
        stages=STAGES,
        rates={
            "activation_rate": ("activated", "selected"),
            "treatment_start_rate": ("treatment_started", "activated"),
            "treatment_completion_rate": ("treatment_completed", "treatment_started"),
        },
    ).orderBy(*sort_keys("plan_id"))


def reason_share(lc: Lifecycle) -> DataFrame:
    return reports.reason_share(
        lc.subscription_events,
        ["rejected", "cancelled"],
        "event_type",
        "event_reason",
        "subscription_id",
    ).orderBy(*sort_keys("event_type", "-entity_count"))


def conversion_by_channel(lc: Lifecycle) -> DataFrame:
    return reports.conversion_by_dimension(
        lc.subscriptions,
        lc.customers,
        "subscription_id",
        "customer_id",
        "acquisition_channel",
        F.col("activated_at").isNotNull(),
    ).orderBy(*sort_keys("-conversion_pct", "acquisition_channel"))


def days_to_activation(lc: Lifecycle) -> DataFrame:
    stats = duration_stats(
        lc.subscriptions,
        "selected_at",
        "activated_at",
        PLAN,
        names=("activated_count", "avg_days", "min_days", "max_days"),
        entity="subscription_id",
    )
    return _with_plan_name(stats, lc).orderBy(*sort_keys("avg_days"))


def payment_outcome_share(lc: Lifecycle) -> DataFrame:
    return share_of_total(
        lc.payments,
        by=["payment_status"],
        within=["payment_type"],
        count="payment_count",
        total="type_total",
        share="status_pct",
    ).orderBy(*sort_keys("payment_type", "-payment_count"))


def _successful(lc: Lifecycle) -> DataFrame:
    return lc.payments.filter(F.col("payment_status") == "successful")


def payments_by_plan(lc: Lifecycle) -> DataFrame:
    sums = reports.conditional_sums(
        _successful(lc),
        lc.subscriptions,
        SUBSCRIPTION,
        PLAN,
        "amount",
        "payment_type",
        {f"{kind}_amount": kind for kind in PAYMENT_TYPE},
    )
    return _with_plan_name(sums, lc).orderBy(*sort_keys("-total_amount"))


def refund_status_summary(lc: Lifecycle) -> DataFrame:
    return value_counts(
        lc.refunds, ["refund_status"], "refund_count", {"total_amount": "refund_amount"}
    ).orderBy(*sort_keys("-refund_count"))


def net_payments_by_plan(lc: Lifecycle) -> DataFrame:
    net = reports.net_of_adjustments(
        _successful(lc),
        lc.refunds.filter(F.col("refund_status") == "completed"),
        "payment_id",
        "amount",
        "refund_amount",
        lc.subscriptions,
        SUBSCRIPTION,
        PLAN,
    )
    return _with_plan_name(net, lc).orderBy(*sort_keys("-net_amount"))


def extreme_month_changes(lc: Lifecycle) -> DataFrame:
    return reports.extreme_period_changes(_successful(lc), "payment_date", "amount").orderBy(
        *sort_keys("period")
    )


def period_comparison(lc: Lifecycle, start: str, end: str) -> DataFrame:
    return reports.period_comparison(
        _successful(lc), "payment_date", start, end, "payment_type", "amount"
    ).orderBy(*sort_keys("period", "payment_type"))


def renewal_status_share(lc: Lifecycle, start: str, end: str) -> DataFrame:
    renewals = lc.payments.filter(F.col("payment_type") == "renewal")
    return reports.period_status_share(
        renewals, "payment_date", start, end, "payment_status", "amount"
    ).orderBy(*sort_keys("period", "payment_status"))


def appointment_outcome_share(lc: Lifecycle) -> DataFrame:
    return share_of_total(
        lc.appointments,
        by=["appointment_status"],
        within=["appointment_type"],
        count="appointment_count",
        total="type_total",
        share="status_pct",
    ).orderBy(*sort_keys("appointment_type", "-appointment_count"))


def eligibility_by_plan(lc: Lifecycle) -> DataFrame:
    completed = lc.appointments.filter(
        (F.col("appointment_type") == "initial_appt")
        & (F.col("appointment_status") == "completed")
    )
    split = reports.outcome_split_by_dimension(
        completed,
        lc.subscriptions,
        SUBSCRIPTION,
        PLAN,
        "eligibility_result",
        ["eligible", "not_eligible"],
    )
    return _with_plan_name(split, lc).orderBy(*sort_keys("-eligible_pct"))


def treatment_duration(lc: Lifecycle) -> DataFrame:
    stats = reports.event_pair_duration(
        lc.subscription_events,
        lc.subscriptions,
        "subscription_id",
        "event_type",
        "event_timestamp",
        "treatment_started",
        "treatment_completed",
        PLAN,
    )
    return _with_plan_name(stats, lc).orderBy(*sort_keys("avg_duration"))


def time_to_exit(lc: Lifecycle) -> DataFrame:
    cancelled = lc.subscriptions.filter(F.col("subscription_status") == "cancelled")
    stats = duration_stats(cancelled, "activated_at", "ended_at", PLAN)
    return _with_plan_name(stats, lc).orderBy(*sort_keys("-avg_duration"))


def customer_frequency(lc: Lifecycle) -> DataFrame:
    return reports.entity_frequency(lc.subscriptions, "customer_id").orderBy(
        *sort_keys("rows_per_entity")
    )


def plan_transitions(lc: Lifecycle) -> DataFrame:
    """First and second plan of returning customers; the names join the few counted pairs."""
    pairs = reports.nth_transition(
        lc.subscriptions, "customer_id", ["selected_at", "subscription_id"], "plan_id"
    )
    first = lc.plans.select(
        F.col("plan_id").alias("first_state"), F.col("plan_name").alias("first_plan_name")
    )
    second = lc.plans.select(
        F.col("plan_id").alias("nth_state"), F.col("plan_name").alias("second_plan_name")
    )
    named = pairs.join(first, "first_state").join(second, "nth_state")
    return named.select(
        F.col("first_state").alias("first_plan_id"),
        "first_plan_name",
        F.col("nth_state").alias("second_plan_id"),
        "second_plan_name",
        F.col("entity_count").alias("customer_count"),
    ).orderBy(*sort_keys("-customer_count"))


def intake_status_share(lc: Lifecycle) -> DataFrame:
    return share_of_total(
        lc.intakes,
        by=["intake_status"],
        count="intake_count",
        total="total_intakes",
        share="status_pct",
    ).orderBy(*sort_keys("-intake_count"))


def intake_completion_hours(lc: Lifecycle) -> DataFrame:
    completed = lc.intakes.filter(F.col("intake_status") == "completed")
    stats = duration_stats(
        completed.join(_plan_of(lc), "subscription_id"),
        "started_at",
        "completed_at",
        PLAN,
        unit="hour",
        names=("completed_count", "avg_hours", "min_hours", "max_hours"),
    )
    return _with_plan_name(stats, lc).orderBy(*sort_keys("avg_hours"))


def intake_subscription_crosstab(lc: Lifecycle) -> DataFrame:
    return reports.status_crosstab(
        lc.intakes, lc.subscriptions, SUBSCRIPTION, "intake_status", "subscription_status"
    ).orderBy(*sort_keys("intake_status", "-row_count"))


def cancellation_rate_by_plan(lc: Lifecycle) -> DataFrame:
    activated = lc.subscriptions.filter(F.col("activated_at").isNotNull())
    rates = reports.exit_rate_by_dimension(activated, PLAN, "subscription_status", "cancelled")
    return _with_plan_name(rates, lc).orderBy(*sort_keys("-exit_pct"))


def cancellation_reasons_by_plan(lc: Lifecycle) -> DataFrame:
    # Naming the plans drops a missing plan anyway; dropping it here lets the counts and their
    # totals share one exchange.
    shares = reports.exit_reason_share_by_dimension(
        lc.subscription_events,
        lc.subscriptions.filter(F.col("plan_id").isNotNull()),
        "subscription_id",
        "event_type",
        "cancelled",
        "event_reason",
        PLAN,
    )
    return _with_plan_name(shares, lc).orderBy(*sort_keys("plan_id", "-entity_count"))

