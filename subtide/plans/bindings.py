"""Lifecycle tables derived by Spark from the order tables the checks are run on.

orders become subscriptions, order priorities become plans, line items become payments, refunds,
appointments and events, and the span of an order's line items becomes its intake. Everything an
order needs from its line items is aggregated per order first.
"""

from __future__ import annotations

from functools import cache, partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from subtide.functions import days, first_match, hours, money
from subtide.operators.numbering import dealt_by, dense_number
from subtide.plans.lifecycle import Lifecycle
from subtide.schemas import EVENT_REASON
from subtide.sources import kept_once, read_table, written_once

CUTOFF = "2001-09-01 23:59:59"

TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": """c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE,
        c_mktsegment STRING""",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": """p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT,
        p_retailprice DOUBLE""",
    "orders": """o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE,
        o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING""",
    "lineitem": """l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ""",
    "events": """event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING,
        value DOUBLE, props STRING""",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}

EVENT_BY_LINE = [
    "selected",
    "activated",
    "treatment_started",
    "rejected",
    "cancelled",
    "treatment_completed",
    "plan_changed",
]


def open_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return read_table(spark, folder, name, TABLES[name])


def _plan_id() -> Column:
    return F.substring("o_orderpriority", 1, 1).cast("long")


def _stored(created: Column, number: Column) -> list[Column]:
    """Times of creation and update: the latter before, at or after the former, or NULL."""
    later = created + days((number % 5 - 1).cast("int"))
    return [
        created.alias("created_at"),
        F.when(number % 7 != 0, later).alias("updated_at"),
    ]


def customers(customer: DataFrame) -> DataFrame:
    signup_days = F.floor(F.abs("c_acctbal") / 2).cast("int")
    signup_date = F.date_add(F.lit("1992-01-01").cast("date"), signup_days)
    return customer.select(
        F.col("c_custkey").alias("customer_id"),
        F.upper(F.substring("c_mktsegment", 1, 1)).alias("gender"),
        signup_date.alias("signup_date"),
        F.col("c_nationkey").cast("string").alias("state_code"),
        F.lower("c_mktsegment").alias("acquisition_channel"),
        *_stored(signup_date.cast("timestamp_ntz"), F.col("c_custkey")),
    )


def plans(orders: DataFrame) -> DataFrame:
    late = F.lit("2001-07-30").cast("timestamp_ntz")
    found = orders.groupBy(
        _plan_id().alias("plan_id"), F.substring("o_orderpriority", 3, 99).alias("plan_name")
    ).agg(
        F.min(money("o_totalprice")).alias("monthly_price"),
        (F.max("o_orderdate") >= late).alias("is_available"),
        F.min("o_orderdate").alias("_first"),
    )
    stored = _stored(F.col("_first"), F.col("plan_id") * 3 + 4)
    return found.select("plan_id", "plan_name", "monthly_price", "is_available", *stored)


def line_span(lineitem: DataFrame) -> DataFrame:
    return lineitem.groupBy(F.col("l_orderkey").alias("subscription_id")).agg(
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        F.count(F.lit(1)).alias("lines"),
    )


def subscriptions(orders: DataFrame, spans: DataFrame) -> DataFrame:
    key = F.col("o_orderkey")
    status = first_match(
        [
            ((F.col("o_orderstatus") == "F") & (key % 2 == 0), F.lit("cancelled")),
            (F.col("o_orderstatus") == "F", F.lit("completed")),
            (F.col("o_orderstatus") == "O", F.lit("active")),
            (key % 3 == 0, F.lit("rejected")),
        ],
        F.lit("pending"),
    )
    base = orders.select(
        key.alias("subscription_id"),
        F.col("o_custkey").alias("customer_id"),
        _plan_id().alias("plan_id"),
        status.alias("subscription_status"),
        F.col("o_orderdate").alias("selected_at"),
    )
    began = F.col("subscription_status").isin("active", "cancelled", "completed") & (
        F.col("last_ship") > F.col("selected_at")
    )
    over = F.col("subscription_status").isin("cancelled", "completed") & (
        F.col("last_ship") > F.col("activated_at")
    )
    rejected_at = F.col("selected_at") + days(F.col("subscription_id") % 7 + 1)
    return (
        base.join(spans, "subscription_id", "left")
        .withColumn(
            "activated_at",
            F.when(began, F.greatest("first_ship", F.col("selected_at") + days(1))),
        )
        .withColumn(
            "ended_at",
            F.when(over, F.col("last_ship")).when(
                F.col("subscription_status") == "rejected", rejected_at
            ),
        )
        .select(
            *base.columns,
            "activated_at",
            "ended_at",
            *_stored(F.col("selected_at"), F.col("subscription_id")),
        )
    )


def intakes(spans: DataFrame) -> DataFrame:
    lines, key = F.col("lines"), F.col("subscription_id")
    done = (lines >= 3) | ((lines == 2) & (key % 2 == 1))
    return spans.select(
        key.alias("intake_id"),
        "subscription_id",
        first_match(
            [(lines == 1, F.lit("expired")), (lines == 2, F.lit("pending"))], F.lit("completed")
        ).alias("intake_status"),
        F.when((lines > 1) | (key % 2 == 1), F.col("first_ship") - days(2)).alias("started_at"),
        F.when(done, F.col("first_ship") - days(1) + hours(lines * 6)).alias("completed_at"),
        *_stored(F.col("first_ship"), key),
    )


def appointments(lineitem: DataFrame) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]
    dealt = dealt_by(lineitem.select(*keys, "l_shipdate", "l_quantity"), *keys)
    per_line = dealt.groupBy(
        F.col("l_orderkey").alias("subscription_id"), F.col("l_linenumber").alias("line")
    ).agg(
        F.min("l_shipdate").alias("scheduled_at"),
        F.max("l_quantity").cast("long").alias("quantity"),
    )
    quantity = F.col("quantity")
    status = first_match(
        [
            (quantity % 6 == 0, F.lit("no_show")),
            (quantity % 6 == 1, F.lit("cancelled")),
            (quantity % 6 == 2, F.lit("scheduled")),
            (quantity % 12 == 3, F.lit("rescheduled")),
        ],
        F.lit("completed"),
    )
    result = first_match(
        [
            (quantity % 7 < 4, F.lit("eligible")),
            (quantity % 7 == 4, F.lit("not_eligible")),
        ]
    )
    done = (F.col("appointment_status") == "completed") | (quantity % 11 == 0)
    return (
        per_line.withColumn("appointment_status", status)
        .select(
            (F.col("subscription_id") * 10 + F.col("line")).alias("appointment_id"),
            "subscription_id",
            "scheduled_at",
            F.when(F.col("line") == 1, "initial_appt")
            .otherwise("follow_up")
            .alias("appointment_type"),
            "appointment_status",
            result.alias("eligibility_result"),
            F.when(done, F.col("scheduled_at") + hours(1)).alias("completed_at"),
            *_stored(F.col("scheduled_at"), F.col("subscription_id") + F.col("line")),
        )
    )


def numbered_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items numbered 1..n by all their columns; the place in the scan settles ties."""
    lineitem = open_table(spark, folder, "lineitem")
    placed = lineitem.withColumn("_place", F.monotonically_increasing_id())
    order = [*lineitem.columns, "_place"]
    return dense_number(placed, order, name="line_no", no_ties=True, drop=["_place"])


def payments(lines: DataFrame) -> DataFrame:
    return lines.select(
        F.col("line_no").alias("payment_id"),
        F.col("l_orderkey").alias("subscription_id"),
        F.col("l_shipdate").alias("payment_date"),
        first_match(
            [
                (F.col("l_linestatus") == "F", F.lit("successful")),
                (F.col("l_returnflag") == "N", F.lit("pending")),
            ],
            F.lit("failed"),
        ).alias("payment_status"),
        F.when(F.col("l_linenumber") == 1, "initial").otherwise("renewal").alias("payment_type"),
        money("l_extendedprice").alias("amount"),
        *_stored(F.col("l_shipdate"), F.col("l_partkey")),
    )


def refunds(lines: DataFrame) -> DataFrame:
    amount = money("l_extendedprice") * F.col("l_discount").cast("decimal(4,2)")
    reason = first_match(
        [
            (F.col("l_linenumber") == 1, F.lit("treatment_rejection")),
            (F.col("l_linenumber") == 2, F.lit("duplicate_charge")),
            (F.col("l_linenumber") == 3, F.lit("plan_change")),
        ],
        F.lit("subscription_cancelled"),
    )
    return lines.filter(F.col("l_returnflag") == "R").select(
        F.col("line_no").alias("refund_id"),
        F.col("line_no").alias("payment_id"),
        (F.col("l_shipdate") + days(F.col("l_quantity").cast("int") % 5 - 1)).alias(
            "processed_at"
        ),
        money(amount).alias("refund_amount"),
        reason.alias("refund_reason"),
        F.when(F.col("l_tax") > 0.04, "completed").otherwise("declined").alias("refund_status"),
        *_stored(F.col("l_shipdate"), F.col("l_partkey")),
    )


def subscription_events(lines: DataFrame) -> DataFrame:
    kinds = F.array(*[F.lit(kind) for kind in EVENT_BY_LINE])
    reasons = F.array(*[F.lit(r) for r in [*EVENT_REASON, None]])
    has_reason = F.col("l_linenumber").isin(4, 5) | (F.col("l_returnflag") == "R")
    return lines.select(
        F.col("line_no").alias("event_id"),
        F.col("l_orderkey").alias("subscription_id"),
        F.get(kinds, F.col("l_linenumber") - 1).alias("event_type"),
        F.when(has_reason, F.get(reasons, (F.col("l_suppkey") % 10).cast("int"))).alias(
            "event_reason"
        ),
        F.col("l_shipdate").alias("event_timestamp"),
    )


def lifecycle(spark: SparkSession, folder: str, ids: bool = False) -> Lifecycle:
    """All eight tables.

    ``ids`` gives payments, refunds and events their numbers; what never reads them does without
    numbering the line items. The lifecycle tables stand for stored ones: the numbered line items,
    the span of each order and the subscriptions are written on first use and read from then on, by
    all queries of the application. Detail joins then meet stored rows on both sides, which lets
    Spark split a hot key.
    """
    table = cache(partial(open_table, spark, folder))
    source = {name: f"{folder}/{name}.parquet" for name in ("lineitem", "orders")}

    def stored(name: str, names: list[str], build) -> DataFrame:
        return written_once(spark, name, [source[n] for n in names], build)

    @cache
    def lines() -> DataFrame:
        if not ids:
            return table("lineitem").withColumn("line_no", F.lit(None).cast("long"))
        # Numbering writes the lines, sorted; writing them with their numbers would store them twice.
        return kept_once(spark, "numbered lines", [source["lineitem"]], lambda: numbered_lines(spark, folder))

    @cache
    def spans() -> DataFrame:
        return stored("spans", ["lineitem"], lambda: line_span(table("lineitem")))

    def stored_subscriptions() -> DataFrame:
        build = lambda: subscriptions(table("orders"), spans())
        return stored("subscriptions", ["orders", "lineitem"], build)

    return Lifecycle(
        CUTOFF,
        customers=lambda: customers(table("customer")),
        plans=lambda: plans(table("orders")),
        subscriptions=stored_subscriptions,
        intakes=lambda: intakes(spans()),
        appointments=lambda: appointments(table("lineitem")),
        payments=lambda: payments(lines()),
        refunds=lambda: refunds(lines()),
        subscription_events=lambda: subscription_events(lines()),
    )
