"""Every query by name. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, DecimalType, IntegerType, ShortType

from subtide.operators import quality
from subtide.operators.core import with_place
from subtide.plans import activity, analysis, bindings, checks, steps, stored
from subtide.plans.bindings import TABLES, open_table
from subtide.plans.lifecycle import Lifecycle
from subtide.session import configure

Query = Callable[[SparkSession, str], DataFrame]

# Two months inside the range of the line items' dates.
PERIOD = ("1998-03-01 00:00:00", "1998-05-01 00:00:00")


def portable(df: DataFrame) -> DataFrame:
    """Plain output types: decimals as double, small integers as bigint."""

    def plain(field):
        if isinstance(field.dataType, DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, (ByteType, ShortType, IntegerType)):
            return F.col(field.name).cast("long").alias(field.name)
        return F.col(field.name)

    return df.select(*[plain(field) for field in df.schema])


def _on_lifecycle(report: Callable[[Lifecycle], DataFrame], ids: bool = False) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return portable(report(bindings.lifecycle(configure(spark), folder, ids)))

    return query


def _on_tables(build: Query) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return portable(build(configure(spark), folder))

    return query


def _driver_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.table_row_counts({t: open_table(spark, folder, t) for t in TABLES})


def _order_profile(spark: SparkSession, folder: str) -> DataFrame:
    return quality.column_profile(
        open_table(spark, folder, "orders"),
        "o_orderdate",
        ["o_orderstatus", "o_orderpriority", "o_custkey"],
    )


def _duplicate_line_keys(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(
        open_table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"]
    )


def _duplicate_part_names(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(open_table(spark, folder, "part"), ["p_name"])


# Keys that hold, and some that do not.
DRIVER_KEYS = [
    ("lineitem", ["l_orderkey", "l_linenumber"]),
    ("lineitem", ["l_orderkey", "l_partkey", "l_suppkey"]),
    ("orders", ["o_orderkey"]),
    ("orders", ["o_custkey", "o_orderdate"]),
    ("customer", ["c_custkey"]),
    ("part", ["p_name"]),
    ("events", ["event_id"]),
    ("events", ["user_id", "event_type"]),
    ("documents", ["doc_id"]),
    ("conversations", ["conv_id", "turn"]),
]


def _driver_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return quality.uniqueness(
        {
            f"{table}.{'+'.join(keys)}": (open_table(spark, folder, table), keys)
            for table, keys in DRIVER_KEYS
        }
    )


def _references_with_gaps(lc: Lifecycle) -> DataFrame:
    """The declared references, checked against parents of which some rows are gone."""
    parents = {
        "customers": lc.customers.filter("customer_id % 10 <> 3"),
        "plans": lc.plans.filter("plan_id <> 4"),
        "subscriptions": lc.subscriptions.filter("subscription_status <> 'pending'"),
        "payments": lc.payments.filter("payment_status = 'successful'"),
    }
    return checks.referential_integrity(lc, parents)


# (child table, child key, parent table, parent key)
DRIVER_RELATIONS = [
    ("nation", "n_regionkey", "region", "r_regionkey"),
    ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("supplier", "s_nationkey", "nation", "n_nationkey"),
    ("orders", "o_custkey", "customer", "c_custkey"),
    ("lineitem", "l_orderkey", "orders", "o_orderkey"),
    ("lineitem", "l_partkey", "part", "p_partkey"),
    ("lineitem", "l_suppkey", "supplier", "s_suppkey"),
    ("events", "user_id", "customer", "c_custkey"),
    ("labels", "doc_id", "documents", "doc_id"),
    # Not a reference, but one with gaps: orders nothing was shipped for.
    ("orders", "o_orderkey", "lineitem", "l_orderkey"),
]


def _driver_references(spark: SparkSession, folder: str) -> DataFrame:
    return quality.referential_integrity(
        {
            f"{child}.{key}->{parent}": (
                open_table(spark, folder, child),
                key,
                open_table(spark, folder, parent),
                parent_key,
            )
            for child, key, parent, parent_key in DRIVER_RELATIONS
        }
    )


BINDING_CHANNELS = ["automobile", "building", "furniture", "household"]

QUERIES: dict[str, Query] = {
    # Reports.
    "stage_funnel": _on_lifecycle(analysis.stage_funnel),
    "reason_share": _on_lifecycle(analysis.reason_share),
    "conversion_by_dimension": _on_lifecycle(analysis.conversion_by_channel),
    "duration_stats": _on_lifecycle(analysis.days_to_activation),
    "payment_outcome_share": _on_lifecycle(analysis.payment_outcome_share),
    "conditional_sums": _on_lifecycle(analysis.payments_by_plan),
    "status_summary": _on_lifecycle(analysis.refund_status_summary),
    "net_of_adjustments": _on_lifecycle(analysis.net_payments_by_plan, ids=True),
    "extreme_period_changes": _on_lifecycle(analysis.extreme_month_changes),
    "period_comparison": _on_lifecycle(lambda lc: analysis.period_comparison(lc, *PERIOD)),
    "period_status_share": _on_lifecycle(lambda lc: analysis.renewal_status_share(lc, *PERIOD)),
    "appointment_outcome_share": _on_lifecycle(analysis.appointment_outcome_share),
    "outcome_split_by_dimension": _on_lifecycle(analysis.eligibility_by_plan),
    "event_pair_duration": _on_lifecycle(analysis.treatment_duration),
    "time_to_exit": _on_lifecycle(analysis.time_to_exit),
    "entity_frequency": _on_lifecycle(analysis.customer_frequency),
    "nth_transition": _on_lifecycle(analysis.plan_transitions),
    "status_share": _on_lifecycle(analysis.intake_status_share),
    "completion_hours": _on_lifecycle(analysis.intake_completion_hours),
    "status_crosstab": _on_lifecycle(analysis.intake_subscription_crosstab),
    "exit_rate_by_dimension": _on_lifecycle(analysis.cancellation_rate_by_plan),
    "exit_reason_share_by_dimension": _on_lifecycle(analysis.cancellation_reasons_by_plan),
    # Checks.
    "table_row_counts": _on_tables(_driver_row_counts),
    "lifecycle_row_counts": _on_lifecycle(checks.table_row_counts),
    "column_profile": _on_lifecycle(checks.customer_profile),
    "order_profile": _on_tables(_order_profile),
    "row_domain_violations": _on_lifecycle(
        lambda lc: checks.customer_domains(lc, BINDING_CHANNELS)
    ),
    "dimension_listing": _on_lifecycle(checks.plan_listing),
    "duplicate_dimension_names": _on_tables(_duplicate_part_names),
    "duplicate_keys": _on_tables(_duplicate_line_keys),
    "status_counts": _on_lifecycle(checks.subscription_status_counts),
    "state_timestamp_consistency": _on_lifecycle(checks.state_timestamps),
    "prerequisite_violations": _on_lifecycle(checks.activation_prerequisites),
    "child_status_consistency": _on_lifecycle(checks.intake_consistency),
    "violation_counts": _on_lifecycle(checks.rejection_timing),
    "appointment_rules": _on_lifecycle(checks.appointment_rules),
    "status_pair_counts": _on_lifecycle(checks.appointment_result_counts),
    "eligible_population": _on_lifecycle(checks.follow_up_population),
    "timeline_violations": _on_lifecycle(checks.appointment_timeline),
    "amount_vs_reference": _on_lifecycle(checks.payment_rules, ids=True),
    "child_cardinality": _on_lifecycle(checks.initial_payment_cardinality, ids=True),
    "after_first_event": _on_lifecycle(checks.renewals_after_initial, ids=True),
    "payment_status_summary": _on_lifecycle(checks.payment_status_summary),
    "refund_rules": _on_lifecycle(checks.refund_rules, ids=True),
    "refund_summary": _on_lifecycle(checks.refund_summary),
    "conditional_domain": _on_lifecycle(checks.event_reasons, ids=True),
    "lifecycle_coverage": _on_lifecycle(checks.lifecycle_coverage),
    "duplicate_events": _on_lifecycle(checks.duplicate_events),
    "chronology_violations": _on_lifecycle(checks.event_chronology),
    "source_consistency": _on_lifecycle(checks.event_source_times),
    "check_constraints": _on_lifecycle(checks.check_constraints, ids=True),
    "referential_integrity": _on_tables(_driver_references),
    "lifecycle_references": _on_lifecycle(_references_with_gaps, ids=True),
    "uniqueness": _on_tables(_driver_uniqueness),
    # Transforms.
    "dense_number": _on_tables(steps.numbered_lines),
    "dense_number_by_group": _on_tables(steps.numbered_by_status),
    "cyclic_bucket": _on_tables(steps.cyclic_bucket),
    "every_nth": _on_tables(steps.every_fifth),
    "every_nth_remainders": _on_tables(steps.three_of_five),
    "derive_timestamps": _on_lifecycle(steps.derived_timestamps),
    "expand_recurring": _on_lifecycle(steps.renewal_schedule),
    "censor_at": _on_lifecycle(steps.censored),
    "due_status": _on_lifecycle(steps.due_status),
    "first_charge": _on_lifecycle(steps.first_charge),
    "full_reversal": _on_lifecycle(steps.full_reversal, ids=True),
    "latest_in_window": _on_lifecycle(steps.cancellation_refunds, ids=True),
    "state_to_events": _on_lifecycle(steps.state_to_events),
    "reason_from_context": _on_lifecycle(steps.reason_from_context),
    "update_from": _on_lifecycle(steps.intake_updates),
    "bounded_event": _on_lifecycle(steps.bounded_events),
    "append_with_defaults": _on_tables(steps.appended_suppliers),
    # Reports with the place of each row in their order: ascending, descending, mixed.
    "placed_status_pairs": _on_lifecycle(
        lambda lc: with_place(
            checks.appointment_result_counts(lc), "appointment_status", "eligibility_result"
        )
    ),
    "placed_status_share": _on_lifecycle(
        lambda lc: with_place(analysis.intake_status_share(lc), "-intake_count", "-intake_status")
    ),
    "placed_outcome_share": _on_lifecycle(
        lambda lc: with_place(
            analysis.appointment_outcome_share(lc),
            "appointment_type",
            "-appointment_count",
            "appointment_status",
        )
    ),
    # Tables stored for reports and checks.
    "checks_on_write": _on_lifecycle(stored.checks_on_write, ids=True),
    "key_ranges": _on_tables(stored.key_ranges),
    "partials_comparison": _on_lifecycle(stored.partials_comparison),
    "partials_extremes": _on_lifecycle(stored.partials_extremes),
    "partition_update": _on_tables(stored.partition_update),
    "bucketed_prerequisites": _on_lifecycle(stored.bucketed_prerequisites),
    # The same operators on the raw activity log.
    "daily_funnel": _on_tables(activity.daily_funnel),
    "event_type_share": _on_tables(activity.event_type_share),
    "event_reason_share": _on_tables(activity.event_reason_share),
    "view_to_purchase": _on_tables(activity.view_to_purchase),
    "error_reasons_by_segment": _on_tables(activity.error_reasons_by_segment),
    "segment_coverage": _on_tables(activity.segment_coverage),
    "user_chronology": _on_tables(activity.user_chronology),
    "repeated_event_types": _on_tables(activity.repeated_event_types),
}
