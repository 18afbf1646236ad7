"""The transforms, applied to the lifecycle tables the checks are run on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from subtide.functions import days, ntz
from subtide.operators import transforms
from subtide.operators.numbering import dense_number, every_nth
from subtide.plans import bindings
from subtide.plans.bindings import open_table
from subtide.plans.lifecycle import Lifecycle

CENSOR_AT = "2000-01-01 00:00:00"

# Slots of a 170-step cycle and the cancellation reason each range stands for.
# The steps of intake_updates below are such values too.
REASON_SLOTS = [
    (0, 50, "patient_request"),
    (51, 84, "side_effects"),
    (85, 118, "not_satisfied"),
    (119, 152, "no_longer_needed"),
]


def numbered_lines(spark: SparkSession, folder: str) -> DataFrame:
    lines = bindings.numbered_lines(spark, folder)
    return lines.select("line_no", "l_orderkey", "l_partkey", "l_linenumber", "l_shipdate")


def numbered_by_status(spark: SparkSession, folder: str) -> DataFrame:
    orders = open_table(spark, folder, "orders")
    dated = orders.select("o_orderkey", "o_orderstatus", "o_orderdate")
    return dense_number(dated, ["o_orderdate", "o_orderkey"], ["o_orderstatus"])


def cyclic_bucket(spark: SparkSession, folder: str) -> DataFrame:
    orders = open_table(spark, folder, "orders")
    reason = cancellation_reason(F.col("o_orderkey") + 1)
    return orders.select("o_orderkey", reason.alias("reason"))


def cancellation_reason(number: Column) -> Column:
    return transforms.cyclic_bucket(number, 170, REASON_SLOTS, "other", multiplier=37)


def every_fifth(spark: SparkSession, folder: str) -> DataFrame:
    orders = open_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return every_nth(orders, ["o_orderkey"], 5, partition_by=["o_orderstatus"])


def three_of_five(spark: SparkSession, folder: str) -> DataFrame:
    orders = open_table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return every_nth(
        orders, ["o_orderkey"], 5, keep=(0, 1, 2), partition_by=["o_orderstatus"], first=0
    )


def derived_timestamps(lc: Lifecycle) -> DataFrame:
    key, status = F.col("subscription_id"), F.col("subscription_status")
    base = lc.subscriptions.select("subscription_id", "subscription_status", "selected_at")
    return transforms.derive_timestamps(
        base,
        {
            "review_at": [
                (
                    status.isin("active", "completed"),
                    transforms.offset_days("selected_at", key, 3, 7, 1),
                ),
                (status == "rejected", transforms.offset_hours("selected_at", key, 5, 48, 12)),
            ],
            "closed_at": [
                (status == "completed", transforms.offset_days("review_at", key, 5, 276, 90)),
                (status == "cancelled", transforms.offset_days("selected_at", key, 5, 151, 30)),
            ],
        },
    )


def renewal_schedule(lc: Lifecycle) -> DataFrame:
    activated = lc.subscriptions.filter(F.col("activated_at").isNotNull())
    one_month = F.make_ym_interval(F.lit(0), F.lit(1))
    return transforms.expand_recurring(
        activated.select("subscription_id", "subscription_status", "selected_at", "ended_at"),
        F.col("selected_at") + one_month,
        F.coalesce(F.col("ended_at"), ntz(lc.cutoff)),
        "payment_date",
    ).select("subscription_id", "subscription_status", "payment_date")


def censored(lc: Lifecycle) -> DataFrame:
    subs = lc.subscriptions.select("subscription_id", "subscription_status", "ended_at")
    return transforms.censor_at(subs, CENSOR_AT, "ended_at", "subscription_status", "active")


def due_status(lc: Lifecycle) -> DataFrame:
    # One due time per subscription and month, so the order has no ties. Numbering expands the stored
    # subscriptions twice, which is cheaper than writing what they expand to.
    return transforms.due_status(
        renewal_schedule(lc),
        lc.cutoff,
        "subscription_status",
        "payment_date",
        ["payment_date", "subscription_id"],
        no_ties=True,
    )


def first_charge(lc: Lifecycle) -> DataFrame:
    return transforms.first_charge(lc.subscriptions, lc.plans, lc.intakes, lc.appointments)


def full_reversal(lc: Lifecycle) -> DataFrame:
    return transforms.full_reversal(lc.payments, lc.appointments)


def cancellation_refunds(lc: Lifecycle) -> DataFrame:
    return transforms.cancellation_refunds(
        lc.subscriptions, lc.payments, lc.cutoff, lookback_days=365
    )


def state_to_events(lc: Lifecycle) -> DataFrame:
    status = F.col("subscription_status")
    return transforms.state_to_events(
        lc.subscriptions,
        "subscription_id",
        {
            "selected": ("selected_at", None, None),
            "activated": ("activated_at", None, None),
            "cancelled": (
                "ended_at",
                cancellation_reason(F.col("subscription_id") + 1),
                status == "cancelled",
            ),
            "treatment_completed": (
                "ended_at",
                None,
                (status == "completed") & (F.col("ended_at") > F.col("activated_at")),
            ),
        },
    )


def reason_from_context(lc: Lifecycle) -> DataFrame:
    return transforms.reason_from_context(lc.subscriptions, lc.intakes, lc.appointments)


def intake_updates(lc: Lifecycle) -> DataFrame:
    """Align intakes with activation, then with rejection."""
    key = F.col("t.subscription_id")
    started = transforms.offset_hours("s.selected_at", key, 3, 4, 2)
    aligned = transforms.update_from(
        lc.intakes,
        lc.subscriptions,
        ["subscription_id"],
        {
            "started_at": started,
            "completed_at": F.col("s.activated_at") - transforms.hours(key * 5 % 7 + 12),
        },
        when=F.col("s.activated_at").isNotNull(),
    )
    return transforms.update_from(
        aligned,
        lc.subscriptions,
        ["subscription_id"],
        {
            "started_at": F.when(F.col("t.started_at").isNotNull(), started),
            "completed_at": F.when(
                F.col("t.intake_status") == "completed",
                F.col("s.ended_at") - transforms.hours(key * 3 % 5 + 10),
            ),
        },
        when=F.col("s.subscription_status") == "rejected",
    )


def bounded_events(lc: Lifecycle) -> DataFrame:
    started = lc.subscriptions.select(
        "subscription_id",
        "activated_at",
        "ended_at",
        (F.col("activated_at") + days(F.col("subscription_id") * 5 % 8 + 7)).alias(
            "event_timestamp"
        ),
    )
    return transforms.bounded_event(
        started,
        "event_timestamp",
        "activated_at",
        F.coalesce(F.col("ended_at"), ntz(lc.cutoff)),
    ).select("subscription_id", "event_timestamp")


def appended_suppliers(spark: SparkSession, folder: str) -> DataFrame:
    """Customers appended to the suppliers, with new keys and a default balance."""
    supplier = open_table(spark, folder, "supplier")
    rows = open_table(spark, folder, "customer").select(
        "c_custkey",
        F.col("c_name").alias("s_name"),
        F.col("c_nationkey").alias("s_nationkey"),
    )
    added = transforms.append_with_defaults(
        supplier, rows, "s_suppkey", ["c_custkey"], {"s_acctbal": F.lit(0.0)}
    )
    return supplier.unionByName(added)
