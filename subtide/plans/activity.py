"""Reports and checks over the raw activity log (events by user)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from subtide.operators import quality, reports
from subtide.operators.core import share_of_total
from subtide.plans.bindings import open_table

STAGES = {
    "viewed": "view",
    "clicked": "click",
    "signed_up": "signup",
    "purchased": "purchase",
    "failed": "error",
}


def _users(spark: SparkSession, folder: str) -> DataFrame:
    customer = open_table(spark, folder, "customer")
    return customer.select(
        F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment")
    )


def daily_funnel(spark: SparkSession, folder: str) -> DataFrame:
    """Funnel over (user, day) visits per customer segment."""
    users = _users(spark, folder)
    events = open_table(spark, folder, "events").withColumn("day", F.col("ts").cast("date"))
    return reports.stage_funnel(
        events,
        users,
        users.select("segment").distinct(),
        entity=["user_id", "day"],
        link=["user_id"],
        dim_key="segment",
        stage_col="event_type",
        stages=STAGES,
        rates={
            "click_rate": ("clicked", "viewed"),
            "signup_rate": ("signed_up", "clicked"),
            "purchase_rate": ("purchased", "signed_up"),
        },
    )


def event_type_share(spark: SparkSession, folder: str) -> DataFrame:
    return share_of_total(open_table(spark, folder, "events"), by=["event_type"])


def event_reason_share(spark: SparkSession, folder: str) -> DataFrame:
    return reports.reason_share(
        open_table(spark, folder, "events"),
        ["error", "purchase"],
        "event_type",
        "props",
        "user_id",
    )


def view_to_purchase(spark: SparkSession, folder: str) -> DataFrame:
    return reports.event_pair_duration(
        open_table(spark, folder, "events"),
        _users(spark, folder),
        "user_id",
        "event_type",
        "ts",
        "view",
        "purchase",
        ["segment"],
    )


def error_reasons_by_segment(spark: SparkSession, folder: str) -> DataFrame:
    return reports.exit_reason_share_by_dimension(
        open_table(spark, folder, "events"),
        _users(spark, folder),
        "user_id",
        "event_type",
        "error",
        "props",
        ["segment"],
    )


def segment_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return quality.lifecycle_coverage(
        open_table(spark, folder, "events"),
        _users(spark, folder),
        "user_id",
        "segment",
        "event_type",
        STAGES,
    )


def user_chronology(spark: SparkSession, folder: str) -> DataFrame:
    return quality.chronology_violations(
        open_table(spark, folder, "events"),
        _users(spark, folder),
        "user_id",
        "event_type",
        "ts",
        STAGES,
        [("viewed", "clicked"), ("clicked", "signed_up"), ("signed_up", "purchased")],
    )


def repeated_event_types(spark: SparkSession, folder: str) -> DataFrame:
    return quality.duplicate_keys(
        open_table(spark, folder, "events"), ["user_id", "event_type"]
    )
