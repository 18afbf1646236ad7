"""The whole lifecycle derived from a sign-up file with the library's transforms.

The steps and their constants are fixed values: they must be as published to give the published
figures. This is a test only, not part of the library.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from subtide.functions import days, first_match, hours, ntz
from subtide.operators import transforms as tr
from subtide.operators.numbering import dense_number, every_nth
from subtide.plans.lifecycle import Lifecycle
from subtide.plans.steps import cancellation_reason
from subtide.schemas import INTAKES, PAYMENTS, PLANS, REFUNDS, SIGNUP_FILE, SUBSCRIPTIONS
from subtide.schemas import APPOINTMENTS, EVENTS
from subtide.sources import read_positioned_csv, written
from subtide.sources.tables import POSITION

# Reporting cutoff, last end of a subscription whose owner may return, plans.
CUTOFF = "2026-09-01 23:59:59"
RETURN_UNTIL = "2026-05-31 23:59:59"
PLAN_ROWS = [("Basic", "29.00"), ("Plus", "59.00"), ("Premium", "99.00")]
STARTED = ("active", "cancelled", "completed")


def empty(spark: SparkSession, table) -> DataFrame:
    return spark.createDataFrame([], table.struct)


def appended(target: DataFrame, rows: DataFrame, key: str, order: list[str], table) -> DataFrame:
    added = tr.append_with_defaults(target, rows, key, order, table.defaults())
    return written(target.unionByName(added))


def customers(spark: SparkSession, path: str) -> DataFrame:
    rows = read_positioned_csv(spark, path, SIGNUP_FILE)
    return dense_number(rows, POSITION, name="customer_id", no_ties=True, drop=POSITION)


def plans(spark: SparkSession) -> DataFrame:
    rows = [(i, name, Decimal(price)) for i, (name, price) in enumerate(PLAN_ROWS)]
    given = spark.createDataFrame(rows, "place INT, plan_name STRING, monthly_price DECIMAL(10,2)")
    return appended(empty(spark, PLANS), given, "plan_id", ["place"], PLANS)


def first_subscriptions(spark: SparkSession, people: DataFrame) -> DataFrame:
    number = F.col("customer_number")
    chosen = dense_number(
        people.filter(F.col("customer_id") % 10 != 0).select("customer_id", "signup_date"),
        ["customer_id"],
        name="customer_number",
    )
    status = tr.cyclic_bucket(
        number,
        100,
        [(0, 44, "active"), (45, 64, "cancelled"), (65, 79, "completed"), (80, 89, "rejected")],
        "pending",
        multiplier=37,
    )
    base = chosen.select(
        "customer_id",
        "customer_number",
        tr.cyclic_bucket(number, 20, [(0, 9, 1), (10, 16, 2)], 3).alias("plan_id"),
        status.alias("subscription_status"),
        (F.col("signup_date").cast("timestamp_ntz") + hours(12)).alias("selected_at"),
    )
    state = F.col("subscription_status")
    timed = tr.derive_timestamps(
        base,
        {
            "activated_at": [
                (state.isin(*STARTED), tr.offset_days("selected_at", number, 3, 7, 1))
            ],
            "ended_at": [
                (state == "rejected", tr.offset_days("selected_at", number, 5, 7, 1)),
                (state == "cancelled", tr.offset_days("activated_at", number, 5, 151, 30)),
                (state == "completed", tr.offset_days("activated_at", number, 5, 276, 90)),
            ],
        },
    )
    final = tr.censor_at(timed, CUTOFF, "ended_at", "subscription_status", "active")
    return appended(
        empty(spark, SUBSCRIPTIONS), final, "subscription_id", ["customer_number"], SUBSCRIPTIONS
    )


def with_returners(subs: DataFrame) -> DataFrame:
    ended = subs.filter(
        F.col("subscription_status").isin("cancelled", "rejected")
        & (F.col("ended_at") <= ntz(RETURN_UNTIL))
    ).select("subscription_id", "subscription_status", "customer_id", "plan_id", "ended_at")
    every_fifth = every_nth(ended, ["subscription_id"], 5, partition_by=["subscription_status"])
    back = dense_number(every_fifth.drop("row_no"), ["subscription_id"], name="number")
    number = F.col("number")
    status = tr.cyclic_bucket(number, 10, [(0, 6, "active")], "pending")
    rows = tr.derive_timestamps(
        back.select(
            "customer_id",
            "plan_id",
            "number",
            status.alias("subscription_status"),
            tr.offset_days("ended_at", number, 7, 51, 30).alias("selected_at"),
        ),
        {
            "activated_at": [
                (
                    F.col("subscription_status") == "active",
                    tr.offset_days("selected_at", number, 3, 5, 1),
                )
            ]
        },
    )
    return appended(subs, rows, "subscription_id", ["number"], SUBSCRIPTIONS)


def intakes(spark: SparkSession, subs: DataFrame) -> DataFrame:
    key, number, state = F.col("subscription_id"), F.col("number"), F.col("subscription_status")
    numbered = dense_number(
        subs.select("subscription_id", "subscription_status", "selected_at"),
        ["subscription_id"],
        ["subscription_status"],
        name="number",
    )
    status = first_match(
        [
            ((state == "rejected") & (number % 4 == 0), F.lit("expired")),
            ((state == "pending") & (number % 2 == 1), F.lit("pending")),
        ],
        F.lit("completed"),
    )
    done = F.col("intake_status") == "completed"
    timed = tr.derive_timestamps(
        numbered.withColumn("intake_status", status),
        {
            "started_at": [(done | (key % 2 == 0), tr.offset_days("selected_at", key, 5, 3, 1))],
            "completed_at": [(done, tr.offset_days("started_at", key, 7, 5, 1))],
        },
    )
    final = tr.censor_at(timed, CUTOFF, "completed_at", "intake_status", "pending")
    rows = final.select("subscription_id", "intake_status", "started_at", "completed_at")
    table = appended(empty(spark, INTAKES), rows, "intake_id", ["subscription_id"], INTAKES)

    t_key = F.col("t.subscription_id")
    started = tr.offset_hours("s.selected_at", t_key, 3, 4, 2)
    activated = tr.update_from(
        table,
        subs,
        ["subscription_id"],
        {
            "started_at": started,
            "completed_at": F.col("s.activated_at") - hours(t_key * 5 % 7 + 12),
        },
        when=F.col("s.activated_at").isNotNull(),
    )
    rejected = tr.update_from(
        activated,
        subs,
        ["subscription_id"],
        {
            "started_at": F.when(F.col("t.started_at").isNotNull(), started),
            "completed_at": F.when(
                F.col("t.intake_status") == "completed",
                F.col("s.ended_at") - hours(t_key * 3 % 5 + 10),
            ),
        },
        when=F.col("s.subscription_status") == "rejected",
    )
    return written(rejected)


def appointments(spark: SparkSession, subs: DataFrame, intake: DataFrame) -> DataFrame:
    state, number = F.col("subscription_status"), F.col("number")
    done = intake.filter(F.col("intake_status") == "completed").select(
        "subscription_id", F.col("completed_at").alias("intake_completed_at")
    )
    base = dense_number(
        subs.select("subscription_id", "subscription_status", "activated_at", "ended_at").join(
            done, "subscription_id"
        ),
        ["subscription_id"],
        ["subscription_status"],
        name="number",
    )
    missed = (state == "rejected") & (number % 4 == 0)
    initial = base.select(
        "*",
        F.lit("initial_appt").alias("appointment_type"),
        first_match(
            [(missed, F.lit("no_show")), (state == "pending", F.lit("scheduled"))],
            F.lit("completed"),
        ).alias("appointment_status"),
        first_match(
            [
                (state.isin(*STARTED), F.lit("eligible")),
                ((state == "rejected") & ~missed, F.lit("not_eligible")),
            ]
        ).alias("eligibility_result"),
    )
    decided = F.coalesce("activated_at", F.when(state == "rejected", F.col("ended_at")))
    initial = tr.derive_timestamps(
        initial.withColumn("decided_at", decided),
        {
            "scheduled_at": [
                (F.col("decided_at").isNotNull(), F.col("decided_at") - hours(6)),
                (
                    F.lit(True),
                    tr.offset_days("intake_completed_at", F.col("subscription_id"), 3, 5, 1),
                ),
            ],
            "completed_at": [
                (F.col("appointment_status") == "completed", F.col("decided_at") - hours(1))
            ],
        },
    )
    table = appended(
        empty(spark, APPOINTMENTS), initial, "appointment_id", ["subscription_id"], APPOINTMENTS
    )

    month_on = F.col("activated_at") + days(30)
    running = subs.filter(F.coalesce("ended_at", ntz(CUTOFF)) >= month_on)
    sampled = every_nth(
        running.select("subscription_id", "subscription_status", "activated_at"),
        ["subscription_id"],
        5,
        keep=(0, 1, 2),
        partition_by=["subscription_status"],
        first=0,
    )
    placed = dense_number(
        sampled.select("subscription_id", "activated_at"), ["subscription_id"], name="place"
    )
    status = tr.cyclic_bucket(
        F.col("place"), 20, [(0, 16, "completed"), (17, 18, "no_show")], "cancelled"
    )
    follow_up = tr.derive_timestamps(
        placed.select(
            "subscription_id",
            "place",
            F.lit("follow_up").alias("appointment_type"),
            status.alias("appointment_status"),
            month_on.alias("scheduled_at"),
        ),
        {
            "completed_at": [
                (F.col("appointment_status") == "completed", F.col("scheduled_at") + hours(1))
            ]
        },
    )
    return appended(table, follow_up, "appointment_id", ["place"], APPOINTMENTS)


def payments(
    spark: SparkSession, subs: DataFrame, plan: DataFrame, intake: DataFrame, appts: DataFrame
) -> DataFrame:
    first = tr.first_charge(subs, plan, intake, appts)
    table = appended(empty(spark, PAYMENTS), first, "payment_id", ["subscription_id"], PAYMENTS)
    base = (
        table.select("subscription_id", "amount", F.col("payment_date").alias("first_date"))
        .join(
            subs.filter(F.col("activated_at").isNotNull()).select(
                "subscription_id", "subscription_status", "ended_at"
            ),
            "subscription_id",
        )
    )
    due = tr.expand_recurring(
        base,
        F.col("first_date") + F.make_ym_interval(F.lit(0), F.lit(1)),
        F.coalesce("ended_at", ntz(CUTOFF)),
        "payment_date",
    )
    renewals = tr.due_status(
        due, CUTOFF, "subscription_status", "payment_date", ["payment_date", "subscription_id"]
    ).select(
        "subscription_id",
        "payment_date",
        "payment_status",
        F.lit("renewal").alias("payment_type"),
        "amount",
    )
    return appended(table, renewals, "payment_id", ["payment_date", "subscription_id"], PAYMENTS)


def refunds(
    spark: SparkSession, subs: DataFrame, payment: DataFrame, appts: DataFrame
) -> DataFrame:
    rejected = tr.full_reversal(payment, appts)
    table = appended(empty(spark, REFUNDS), rejected, "refund_id", ["payment_id"], REFUNDS)
    cancelled = tr.cancellation_refunds(subs, payment, CUTOFF)
    return appended(table, cancelled, "refund_id", ["payment_id"], REFUNDS)


def events(
    spark: SparkSession, subs: DataFrame, intake: DataFrame, appts: DataFrame
) -> DataFrame:
    by_sub = ["subscription_id"]
    table = empty(spark, EVENTS)

    def add(rows: DataFrame) -> None:
        nonlocal table
        order = ["subscription_id", "event_timestamp"]
        table = appended(table, rows, "event_id", order, EVENTS)

    add(
        tr.state_to_events(
            subs,
            "subscription_id",
            {"selected": ("selected_at", None, None), "activated": ("activated_at", None, None)},
        )
    )
    add(tr.reason_from_context(subs, intake, appts))
    cancelled = dense_number(
        subs.filter(F.col("subscription_status") == "cancelled").select(
            "subscription_id", "ended_at"
        ),
        by_sub,
        name="number",
    )
    add(
        tr.state_to_events(
            cancelled,
            "subscription_id",
            {"cancelled": ("ended_at", cancellation_reason(F.col("number")), None)},
        )
    )
    begun = dense_number(
        subs.filter(F.col("activated_at").isNotNull()).select(
            "subscription_id", "subscription_status", "activated_at", "ended_at"
        ),
        by_sub,
        ["subscription_status"],
        name="number",
    ).withColumn("started_at", tr.offset_days("activated_at", F.col("number"), 5, 8, 7))
    begun = tr.bounded_event(
        begun, "started_at", "activated_at", F.coalesce("ended_at", ntz(CUTOFF))
    )
    finished = (F.col("subscription_status") == "completed") & (
        F.col("ended_at") > F.col("started_at")
    )
    add(
        tr.state_to_events(
            begun,
            "subscription_id",
            {
                "treatment_started": ("started_at", None, None),
                "treatment_completed": ("ended_at", None, finished),
            },
        )
    )
    return table


def build(spark: SparkSession, path: str) -> Lifecycle:
    people = written(customers(spark, path))
    plan = plans(spark)
    subs = with_returners(first_subscriptions(spark, people))
    intake = intakes(spark, subs)
    appts = appointments(spark, subs, intake)
    payment = payments(spark, subs, plan, intake, appts)
    return Lifecycle(
        CUTOFF,
        customers=people,
        plans=plan,
        subscriptions=subs,
        intakes=intake,
        appointments=appts,
        payments=payment,
        refunds=refunds(spark, subs, payment, appts),
        subscription_events=events(spark, subs, intake, appts),
    )


