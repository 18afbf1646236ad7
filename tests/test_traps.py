"""Small hand-made tables for the cases that are easy to get wrong."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subtide import schemas
from subtide.functions import elapsed_seconds, month_start, ntz, outside, passes, pct
from subtide.operators import quality, reports, transforms
from subtide.operators.core import duration_stats, share_of_total, sized_broadcast

TS = "TIMESTAMP_NTZ"


def ts(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


def rows(df) -> set[tuple]:
    return {tuple(r) for r in df.collect()}


# Percentages and durations.


@pytest.mark.parametrize(
    ("part", "whole", "expected"),
    [(201, 20000, 1.01), (1, 800, 0.13), (-1, 800, -0.13), (5, 0, None), (5, None, None)],
)
def test_percentage_rounds_half_away_from_zero(spark, part, whole, expected):
    df = spark.createDataFrame([(part, whole)], "a BIGINT, b BIGINT")
    assert df.select(pct("a", "b")).first()[0] == expected


def test_percentage_is_exact_for_huge_counts(spark):
    df = spark.createDataFrame([(123_456_789_012, 999_999_999_999)], "a BIGINT, b BIGINT")
    assert df.select(pct("a", "b")).first()[0] == 12.35


def test_elapsed_and_month_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame(
            [(ts("2024-03-09 12:00:00"), ts("2024-03-11 12:00:00.5"))], f"a {TS}, b {TS}"
        )
        got = df.select(elapsed_seconds("a", "b"), month_start("b")).first()
        assert got[0] == Decimal("172800.500000")
        assert got[1] == ts("2024-03-01 00:00:00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_duration_stats_skips_open_rows(spark):
    df = spark.createDataFrame(
        [
            (1, ts("2024-01-01"), ts("2024-01-02")),
            (1, ts("2024-01-01"), ts("2024-01-04 12:00:00")),
            (1, ts("2024-01-01"), None),
            (1, None, ts("2024-01-04")),
        ],
        f"plan_id BIGINT, a {TS}, b {TS}",
    )
    assert rows(duration_stats(df, "a", "b", ["plan_id"])) == {(1, 2, 2.25, 1.0, 3.5)}
    assert rows(duration_stats(df, "a", "b", ["plan_id"], unit="hour")) == {
        (1, 2, 54.0, 24.0, 84.0)
    }


def test_share_counts_distinct_entities(spark):
    df = spark.createDataFrame(
        [("a", "x", 1), ("a", "x", 1), ("a", None, 2), ("b", "x", 3)],
        "kind STRING, reason STRING, id BIGINT",
    )
    got = rows(share_of_total(df, ["reason"], ["kind"], entity="id"))
    assert got == {("a", "x", 1, 2, 50.0), ("a", None, 1, 2, 50.0), ("b", "x", 1, 1, 100.0)}


# Reports.


@pytest.fixture
def bridge(spark):
    return spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "sub BIGINT, plan BIGINT")


def test_conditional_sum_without_match_is_null(spark, bridge):
    facts = spark.createDataFrame(
        [(1, "first", Decimal("5.00")), (3, "later", Decimal("7.00"))],
        "sub BIGINT, kind STRING, amount DECIMAL(10,2)",
    )
    got = reports.conditional_sums(
        facts, bridge, ["sub"], ["plan"], "amount", "kind", {"a": "first", "b": "later"}
    )
    assert rows(got) == {
        (10, 1, Decimal("5.00"), None, Decimal("5.00")),
        (20, 1, None, Decimal("7.00"), Decimal("7.00")),
    }


def test_net_of_adjustments_none_and_fan_out(spark, bridge):
    base = spark.createDataFrame(
        [(1, 1, Decimal("100.00")), (2, 2, Decimal("50.00")), (3, 3, Decimal("30.00"))],
        "id BIGINT, sub BIGINT, amount DECIMAL(10,2)",
    )
    back = spark.createDataFrame(
        [(1, Decimal("10.00")), (1, Decimal("5.00"))], "id BIGINT, refund DECIMAL(10,2)"
    )
    got = reports.net_of_adjustments(
        base, back, "id", "amount", "refund", bridge, ["sub"], ["plan"]
    )
    assert rows(got) == {
        (10, Decimal("150.00"), Decimal("15.00"), Decimal("135.00"), 10.0),
        (20, Decimal("30.00"), Decimal("0.00"), Decimal("30.00"), 0.0),
    }


def test_exit_rate_without_exit_is_null(spark):
    df = spark.createDataFrame([(1, "active")], "plan BIGINT, status STRING")
    got = reports.exit_rate_by_dimension(df, ["plan"], "status", "cancelled")
    assert rows(got) == {(1, 1, None, None)}


def test_funnel_keeps_an_empty_dimension_row(spark):
    events = spark.createDataFrame(
        [(1, "in"), (1, "in"), (1, "out"), (2, "in"), (9, "in")], "sub BIGINT, kind STRING"
    )
    subs = spark.createDataFrame([(1, 10), (2, 10)], "sub BIGINT, plan BIGINT")
    dims = spark.createDataFrame([(10, "ten"), (20, "twenty")], "plan BIGINT, name STRING")
    got = reports.stage_funnel(
        events,
        subs,
        dims,
        entity=["sub"],
        link=["sub"],
        dim_key="plan",
        stage_col="kind",
        stages={"entered": "in", "left": "out"},
        rates={"rate": ("left", "entered")},
    )
    assert rows(got) == {(10, "ten", 2, 1, 50.0), (20, "twenty", 0, 0, None)}


def monthly(spark, amounts: dict[str, int]):
    return spark.createDataFrame(
        [(ts(f"{month}-15"), Decimal(amount)) for month, amount in amounts.items()],
        f"at {TS}, amount DECIMAL(10,2)",
    )


def test_extreme_changes_keep_ties_and_skip_the_first_month(spark):
    df = monthly(
        spark, {"2024-01": 100, "2024-02": 200, "2024-03": 100, "2024-04": 200, "2024-05": 210}
    )
    found = reports.extreme_period_changes(df, "at", "amount").collect()
    assert sorted((r.period, r.change_pct) for r in found) == [
        (ts("2024-02-01"), 100.0),
        (ts("2024-03-01"), -50.0),
        (ts("2024-04-01"), 100.0),
    ]


def test_extreme_changes_use_the_previous_observed_month(spark):
    df = monthly(spark, {"2024-01": 100, "2024-04": 150})
    got = reports.extreme_period_changes(df, "at", "amount").collect()
    assert [(r.previous_amount, r.change_pct) for r in got] == [(Decimal("100.00"), 50.0)]


def test_transition_orders_ties_by_the_second_key(spark):
    day = ts("2024-01-01")
    df = spark.createDataFrame(
        [(1, 5, day, 20), (1, 4, day, 10), (1, 6, day, 30), (2, 7, day, 10)],
        f"customer BIGINT, sub BIGINT, at {TS}, plan BIGINT",
    )
    got = reports.nth_transition(df, "customer", ["at", "sub"], "plan")
    assert rows(got) == {(10, 20, 1)}
    assert rows(reports.nth_transition(df, "customer", ["at", "sub"], "plan", n=3)) == {
        (10, 30, 1)
    }


def test_crosstab_keeps_null_child_status(spark):
    children = spark.createDataFrame([(1, None), (1, "x"), (2, "x")], "sub BIGINT, a STRING")
    parents = spark.createDataFrame([(1, "p"), (2, "q")], "sub BIGINT, b STRING")
    got = reports.status_crosstab(children, parents, ["sub"], "a", "b")
    assert rows(got) == {(None, "p", 1), ("x", "p", 1), ("x", "q", 1)}


# Checks.


def test_check_passes_on_null_and_domain_rule_does_not(spark):
    df = spark.createDataFrame([(1, "a"), (None, None), (-1, "z")], "n INT, s STRING")
    got = df.select(~passes(F.col("n") > 0), outside("s", ["a"])).collect()
    assert [tuple(r) for r in got] == [(False, False), (False, True), (True, True)]


def test_unused_domain_values_are_accepted(spark):
    values = [
        (schemas.EVENTS, "type_domain", "event_type", "plan_changed"),
        (schemas.EVENTS, "reason_domain", "event_reason", "payment_failed"),
        (schemas.APPOINTMENTS, "status_domain", "appointment_status", "rescheduled"),
        (schemas.REFUNDS, "reason_domain", "refund_reason", "duplicate_charge"),
        (schemas.REFUNDS, "reason_domain", "refund_reason", "plan_change"),
    ]
    for table, check, name, value in values:
        df = spark.createDataFrame([(value,), ("unknown",)], f"{name} STRING")
        failed = quality.check_constraints(df, "t", {check: table.checks()[check]})
        assert rows(failed) == {("t", check, 1)}


def test_payment_failed_is_a_known_reason_but_not_for_a_rejection(spark):
    df = spark.createDataFrame(
        [
            (1, "rejected", "payment_failed"),
            (2, "rejected", None),
            (3, "rejected", "not_eligible"),
            (4, "plan_changed", "payment_failed"),
            (5, "selected", "other"),
            (6, "selected", None),
            (7, "cancelled", "other"),
        ],
        "id INT, event_type STRING, event_reason STRING",
    )
    rule = quality.conditional_domain_rule(
        "event_type", "event_reason", schemas.REASONS_BY_TYPE
    )
    assert rows(quality.violations(df, {"r": rule}).select("id")) == {(1,), (2,), (5,)}


def test_state_rules_pass_fail_and_null(spark):
    t = ts("2024-01-01")
    df = spark.createDataFrame(
        [
            (1, "pending", None, None),
            (2, "pending", t, None),
            (3, "active", t, None),
            (4, "active", None, None),
            (5, "rejected", None, t),
            (6, "rejected", t, t),
            (7, "cancelled", t, None),
            (8, None, t, t),
        ],
        f"id INT, status STRING, a {TS}, b {TS}",
    )
    rule = quality.state_timestamp_rule(
        "status",
        required={"active": ["a"], "cancelled": ["a", "b"], "rejected": ["b"]},
        empty={"pending": ["a", "b"], "active": ["b"], "rejected": ["a"]},
    )
    assert rows(quality.violations(df, {"r": rule}).select("id")) == {(2,), (4,), (6,), (7,)}


def test_prerequisite_must_be_strictly_earlier(spark):
    at = ts("2024-01-02")
    subs = spark.createDataFrame(
        [(i, "active", at) for i in range(1, 6)] + [(6, "pending", None)],
        f"subscription_id BIGINT, subscription_status STRING, activated_at {TS}",
    )
    intakes = spark.createDataFrame(
        [
            (1, 1, "completed", ts("2024-01-01")),
            (2, 2, "completed", at),
            (3, 3, "pending", ts("2024-01-01")),
            (4, 4, "completed", None),
        ],
        f"subscription_id BIGINT, intake_id BIGINT, intake_status STRING, completed_at {TS}",
    )
    got = quality.prerequisite_violations(subs, intakes).select("subscription_id")
    assert rows(got) == {(2,), (3,), (4,), (5,)}


def test_amounts_compare_null_safe(spark):
    subs = spark.createDataFrame(
        [(1, 1, ts("2024-01-01"), None), (2, 2, ts("2024-01-01"), None)],
        f"subscription_id BIGINT, plan_id BIGINT, selected_at {TS}, ended_at {TS}",
    )
    plans = spark.createDataFrame(
        [(1, Decimal("9.00")), (2, None)], "plan_id BIGINT, monthly_price DECIMAL(10,2)"
    )
    paid = ts("2024-02-01")
    payments = spark.createDataFrame(
        [
            (1, 1, paid, "successful", "initial", Decimal("9.00")),
            (2, 1, paid, "successful", "initial", None),
            (3, 2, paid, "successful", "initial", None),
            (4, 1, None, "successful", "initial", Decimal("9.00")),
            (5, 1, paid, "failed", "initial", Decimal("9.00")),
            (6, 1, paid, "failed", "renewal", Decimal("9.00")),
            (7, 1, ts("2023-12-31"), "successful", "renewal", Decimal("9.00")),
            (8, 1, ts("2025-01-02"), "successful", "renewal", Decimal("9.00")),
        ],
        f"""payment_id BIGINT, subscription_id BIGINT, payment_date {TS}, payment_status STRING,
        payment_type STRING, amount DECIMAL(10,2)""",
    )
    got = quality.amount_vs_reference(payments, subs, plans, "2025-01-01 00:00:00")
    assert rows(got.select("payment_id")) == {(2,), (4,), (5,), (7,), (8,)}


def test_child_cardinality_counts_zero(spark):
    parents = spark.createDataFrame([(1,), (2,), (3,), (3,)], "sub BIGINT")
    children = spark.createDataFrame([(1, 1), (2, 2), (2, 3)], "sub BIGINT, id BIGINT")
    assert rows(quality.child_cardinality(parents, children, "sub", "id")) == {(2, 2), (3, 0)}


def test_refund_rules(spark):
    payments = spark.createDataFrame(
        [
            (1, "successful", Decimal("10.00"), ts("2024-01-02")),
            (2, "failed", Decimal("10.00"), ts("2024-01-02")),
        ],
        f"payment_id BIGINT, payment_status STRING, amount DECIMAL(10,2), payment_date {TS}",
    )
    refunds = spark.createDataFrame(
        [
            (1, 1, Decimal("10.00"), ts("2024-01-02"), "completed"),
            (2, 1, Decimal("10.01"), ts("2024-01-02"), "completed"),
            (3, 1, Decimal("1.00"), ts("2024-01-01"), "completed"),
            (4, 2, Decimal("1.00"), ts("2024-01-03"), "completed"),
            (5, 2, Decimal("1.00"), ts("2024-01-03"), "declined"),
            (6, 9, Decimal("1.00"), ts("2024-01-03"), "declined"),
        ],
        f"""refund_id BIGINT, payment_id BIGINT, refund_amount DECIMAL(10,2), processed_at {TS},
        refund_status STRING""",
    )
    got = quality.refund_rules(refunds, payments).select("refund_id")
    assert rows(got) == {(2,), (3,), (4,), (6,)}


def test_chronology_ignores_missing_sides_and_unknown_entities(spark):
    events = spark.createDataFrame(
        [
            (1, "a", ts("2024-01-01")),
            (1, "b", ts("2024-01-02")),
            (2, "a", ts("2024-01-02")),
            (2, "b", ts("2024-01-02")),
            (3, "b", ts("2024-01-02")),
            (9, "a", ts("2024-01-03")),
            (9, "b", ts("2024-01-02")),
        ],
        f"sub BIGINT, kind STRING, at {TS}",
    )
    subs = spark.createDataFrame([(1,), (2,), (3,), (4,)], "sub BIGINT")
    got = quality.chronology_violations(
        events, subs, "sub", "kind", "at", {"a": "a", "b": "b"}, [("a", "b")]
    )
    assert rows(got.select("sub")) == {(2,)}


def test_source_consistency_is_null_safe(spark):
    t = ts("2024-01-01")
    source = spark.createDataFrame([(1, t, None), (2, None, None)], f"sub BIGINT, a {TS}, b {TS}")
    events = spark.createDataFrame(
        [(1, "a", t), (1, "b", t), (2, "b", None), (3, "a", t), (1, "other", t)],
        f"sub BIGINT, kind STRING, at {TS}",
    )
    got = quality.source_consistency(events, source, "sub", "kind", "at", {"a": "a", "b": "b"})
    assert rows(got.select("sub", "kind")) == {(1, "b"), (3, "a")}


def test_orphans_are_counted_per_key_and_null_is_none(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "fk INT")
    parent = spark.createDataFrame([(1,)], "pk BIGINT")
    assert rows(quality.orphans(child, "fk", parent, "pk")) == {(2, 2)}


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "day DATE, a STRING, b STRING")
    assert rows(quality.column_profile(df, "day", ["a", "b"])) == {(0, None, None, 0, 0)}
    full = spark.createDataFrame(
        [(date(2024, 1, 1), "x", None), (date(2024, 1, 3), "x", "y"), (None, "z", "y")], df.schema
    )
    got = rows(quality.column_profile(full, "day", ["a", "b"]))
    assert got == {(3, date(2024, 1, 1), date(2024, 1, 3), 2, 1)}


# Transforms.


def month_later(t: datetime) -> datetime:
    year, month = (t.year + 1, 1) if t.month == 12 else (t.year, t.month + 1)
    after = datetime(year + month // 12, month % 12 + 1, 1)
    last = (after - timedelta(days=1)).day
    return t.replace(year=year, month=month, day=min(t.day, last))


def schedule(start: datetime, stop: datetime) -> list[datetime]:
    out = []
    while start <= stop:
        out.append(start)
        start = month_later(start)
    return out


def expanded(spark, pairs):
    df = spark.createDataFrame(
        [(i, *pair) for i, pair in enumerate(pairs)], f"id INT, a {TS}, b {TS}"
    )
    found: dict[int, list] = {i: [] for i in range(len(pairs))}
    for r in transforms.expand_recurring(df, F.col("a"), F.col("b")).collect():
        found[r.id].append(r.due_at)
    return [sorted(found[i]) for i in range(len(pairs))]


def test_month_end_stays_cut(spark):
    [got] = expanded(spark, [(ts("2024-01-31 10:00:00"), ts("2024-05-31 10:00:00"))])
    assert [t.strftime("%m-%d") for t in got] == ["01-31", "02-29", "03-29", "04-29", "05-29"]
    assert {t.hour for t in got} == {10}


def test_schedule_bounds(spark):
    start = ts("2024-03-15 08:00:00")
    got = expanded(
        spark,
        [
            (start, ts("2024-03-15 07:59:59")),
            (start, start),
            (start, ts("2024-05-15 08:00:00")),
            (start, ts("2024-05-15 07:59:59")),
            (start, ts("2023-01-01")),
        ],
    )
    assert [len(x) for x in got] == [0, 1, 3, 2, 0]


def test_schedule_equals_stepwise_addition_for_every_start_day(spark):
    first = ts("1999-01-01 13:30:15.25")
    pairs = [
        (start, start + timedelta(days=(37 * i) % 1900))
        for i in range(0, 1900)
        if (start := first + timedelta(days=i)).day > 26 or i % 5 == 0
    ]
    assert expanded(spark, pairs) == [schedule(a, b) for a, b in pairs]


def test_schedule_across_a_century_without_leap_day(spark):
    pairs = [(ts("1899-12-31"), ts("1905-01-01")), (ts("2096-01-30"), ts("2105-01-01"))]
    assert expanded(spark, pairs) == [schedule(a, b) for a, b in pairs]


def test_censoring_is_strict_and_leaves_null_alone(spark):
    df = spark.createDataFrame(
        [
            (1, "cancelled", ts("2024-01-01 00:00:01")),
            (2, "cancelled", ts("2024-01-01")),
            (3, "pending", None),
        ],
        f"id INT, status STRING, ended {TS}",
    )
    got = transforms.censor_at(df, "2024-01-01 00:00:00", "ended", "status", "active")
    assert rows(got) == {
        (1, "active", None),
        (2, "cancelled", ts("2024-01-01")),
        (3, "pending", None),
    }


def test_pending_wins_and_still_counts(spark):
    cutoff = ts("2024-06-30")
    edge = cutoff - timedelta(days=7)
    data = [(i, "active", edge - timedelta(days=20 - i)) for i in range(1, 12)]
    data += [(12, "active", edge), (13, "cancelled", edge), (14, "active", edge)]
    data += [(i, "active", edge + timedelta(hours=i)) for i in range(15, 24)]
    data += [(24, "cancelled", cutoff)]
    df = spark.createDataFrame(data, f"id INT, status STRING, due {TS}")
    got = transforms.due_status(df, "2024-06-30 00:00:00", "status", "due", ["due", "id"])
    status = {r.id: r.payment_status for r in got.collect()}
    assert [status[i] for i in (1, 11, 12, 13, 14)] == [
        "successful",
        "successful",
        "pending",
        "successful",
        "pending",
    ]
    assert status[24] == "failed"


def test_latest_payment_tie_takes_the_higher_id(spark):
    end = ts("2024-03-10")
    subs = spark.createDataFrame(
        [(1, "cancelled", end), (2, "cancelled", end), (3, "active", None)],
        f"subscription_id BIGINT, subscription_status STRING, ended_at {TS}",
    )
    payments = spark.createDataFrame(
        [
            (10, 1, end - timedelta(days=1), "successful", Decimal("1.00")),
            (11, 1, end - timedelta(days=1), "successful", Decimal("2.00")),
            (12, 1, end, "failed", Decimal("3.00")),
            (13, 1, end + timedelta(seconds=1), "successful", Decimal("4.00")),
            (20, 2, end - timedelta(days=7), "successful", Decimal("5.00")),
            (21, 2, end - timedelta(days=7, seconds=1), "successful", Decimal("6.00")),
            (30, 3, end, "successful", Decimal("7.00")),
        ],
        f"""payment_id BIGINT, subscription_id BIGINT, payment_date {TS}, payment_status STRING,
        amount DECIMAL(10,2)""",
    )
    got = transforms.latest_in_window(subs, payments).select("payment_id")
    assert rows(got) == {(11,), (20,)}
    late = transforms.cancellation_refunds(subs, payments, "2024-03-10 00:29:59")
    assert late.count() == 0
    in_time = transforms.cancellation_refunds(subs, payments, "2024-03-10 00:30:00")
    assert rows(in_time.select("payment_id", "refund_status")) == {
        (11, "completed"),
        (20, "completed"),
    }


def test_update_reads_the_row_as_it_was(spark):
    target = spark.createDataFrame(
        [(1, "open", None), (2, "open", 5), (3, "open", 5), (4, "open", 5)],
        "id BIGINT, status STRING, n INT",
    )
    source = spark.createDataFrame(
        [(1, 7, True), (2, 8, True), (3, 9, False)], "id BIGINT, m INT, go BOOLEAN"
    )
    got = transforms.update_from(
        target,
        source,
        ["id"],
        {
            "status": F.lit("done"),
            "n": F.when(F.col("t.status") == "open", F.col("t.n") + F.col("s.m")),
        },
        when=F.col("s.go"),
    )
    assert rows(got) == {(1, "done", None), (2, "done", 13), (3, "open", 5), (4, "open", 5)}


def test_append_numbers_on_and_fills_only_missing_columns(spark):
    target = spark.createDataFrame(
        [(7, "a", "x", None)], "id BIGINT, name STRING, tag STRING, note STRING"
    )
    new = spark.createDataFrame([("c", None), ("b", "own")], "name STRING, tag STRING")
    got = transforms.append_with_defaults(
        target, new, "id", ["name"], {"tag": F.lit("default"), "note": F.lit("n")}
    )
    assert rows(got) == {(8, "b", "own", "n"), (9, "c", None, "n")}
    assert got.schema.simpleString() == target.schema.simpleString()
    first = transforms.append_with_defaults(target.limit(0), new, "id", ["name"])
    assert rows(first.select("id", "note")) == {(1, None), (2, None)}


def test_cyclic_bucket_splits_a_cycle_exactly(spark):
    ranges = [(0, 44, "a"), (45, 64, "b"), (65, 79, "c"), (80, 89, "d")]
    number = F.col("id") + 1
    df = spark.range(300).select(
        transforms.cyclic_bucket(number, 100, ranges, "e", multiplier=37).alias("bucket")
    )
    counts = {r.bucket: r["count"] for r in df.groupBy("bucket").count().collect()}
    assert counts == {"a": 135, "b": 60, "c": 45, "d": 30, "e": 30}


def test_rejection_reason_precedence(spark):
    subs = spark.createDataFrame(
        [(i, "rejected", ts("2024-01-01")) for i in (1, 2, 3, 4)] + [(5, "active", None)],
        f"subscription_id BIGINT, subscription_status STRING, ended_at {TS}",
    )
    intakes = spark.createDataFrame(
        [(1, "expired"), (2, "completed"), (3, "completed"), (4, "pending"), (5, "completed")],
        "subscription_id BIGINT, intake_status STRING",
    )
    appts = spark.createDataFrame(
        [
            (1, "initial_appt", "no_show"),
            (2, "initial_appt", "no_show"),
            (3, "initial_appt", "completed"),
            (4, "follow_up", "no_show"),
        ],
        "subscription_id BIGINT, appointment_type STRING, appointment_status STRING",
    )
    got = transforms.reason_from_context(subs, intakes, appts)
    assert {(r.subscription_id, r.event_reason) for r in got.collect()} == {
        (1, "intake_expired"),
        (2, "appointment_no_show"),
        (3, "not_eligible"),
        (4, "not_eligible"),
    }


def test_bounded_event_is_strict_below_and_inclusive_above(spark):
    a, b = ts("2024-01-01"), ts("2024-01-05")
    df = spark.createDataFrame(
        [(1, a, a, b), (2, b, a, b), (3, ts("2024-01-06"), a, b), (4, b, a, None)],
        f"id INT, at {TS}, start {TS}, stop {TS}",
    )
    limit = F.coalesce("stop", ntz("2024-01-04 00:00:00"))
    assert rows(transforms.bounded_event(df, "at", "start", limit).select("id")) == {(2,)}


def test_broadcast_only_below_the_checked_size(spark):
    df = spark.range(10)
    plan = lambda d: d._jdf.queryExecution().optimizedPlan().toString()
    assert "ResolvedHint" not in plan(sized_broadcast(df, max_bytes=239))
    joined = spark.range(100).join(sized_broadcast(df, max_bytes=240), "id")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


# One passing, one failing and one NULL row per rule of the larger checks.


def test_customer_domains(spark):
    from subtide.plans import checks
    from subtide.plans.lifecycle import Lifecycle

    df = spark.createDataFrame(
        [
            (1, "M", date(2024, 1, 1), "TX", "meta"),
            (2, "X", date(2024, 1, 1), "TX", "meta"),
            (3, None, date(2024, 1, 1), "TX", "meta"),
            (4, "F", date(2024, 1, 3), "TX", "meta"),
            (5, "F", None, "TX", "meta"),
            (6, "F", date(2024, 1, 2), "T ", "meta"),
            (7, "F", date(2024, 1, 2), None, "meta"),
            (8, "F", date(2024, 1, 2), "TX", "radio"),
            (9, "F", date(2024, 1, 2), "TX", None),
            (10, "F", date(2024, 1, 2), "TX", "organic"),
        ],
        "customer_id INT, gender STRING, signup_date DATE, state_code STRING, "
        "acquisition_channel STRING",
    )
    unused = dict.fromkeys(schemas.TABLES, df)
    lc = Lifecycle("2024-01-02 23:59:59", **unused)
    got = checks.customer_domains(lc).select("customer_id")
    assert rows(got) == {(i,) for i in range(2, 10)}


def test_intake_consistency(spark):
    t0, t1, t2 = ts("2024-01-01"), ts("2024-01-02"), ts("2024-01-03")
    subs = spark.createDataFrame(
        [(i, t1) for i in range(1, 9)], f"subscription_id BIGINT, selected_at {TS}"
    )
    intakes = spark.createDataFrame(
        [
            (1, "completed", t1, t2),
            (2, "completed", None, t2),
            (3, "completed", t1, None),
            (4, "pending", None, None),
            (5, "pending", t1, t2),
            (6, "expired", t1, t2),
            (7, "expired", t0, None),
            (8, None, t1, None),
        ],
        f"subscription_id BIGINT, intake_status STRING, started_at {TS}, completed_at {TS}",
    )
    got = quality.child_status_consistency(intakes, subs).select("subscription_id")
    assert rows(got) == {(2,), (3,), (5,), (6,), (7,)}


def test_rejection_timing(spark):
    t0, t1, t2 = ts("2024-01-01"), ts("2024-01-02"), ts("2024-01-03")
    subs = spark.createDataFrame(
        [(i, "rejected", t1) for i in range(1, 7)] + [(7, "cancelled", t1)],
        f"subscription_id BIGINT, subscription_status STRING, ended_at {TS}",
    )
    intakes = spark.createDataFrame(
        [
            (1, "completed", t0, t0),
            (2, "completed", t0, t1),
            (3, "completed", t0, t2),
            (4, "completed", t0, None),
            (5, "expired", t1, None),
            (6, "expired", None, None),
            (7, "completed", t0, t2),
        ],
        f"subscription_id BIGINT, intake_status STRING, started_at {TS}, completed_at {TS}",
    )
    assert rows(quality.rejection_timing_counts(subs, intakes)) == {(2, 1)}


def test_appointment_rules(spark):
    t = ts("2024-01-01")
    df = spark.createDataFrame(
        [
            (1, "initial_appt", "completed", "eligible", t),
            (2, "initial_appt", "completed", "eligible", None),
            (3, "initial_appt", "completed", None, t),
            (4, "initial_appt", "no_show", None, None),
            (5, "initial_appt", "no_show", None, t),
            (6, "initial_appt", "no_show", "eligible", None),
            (7, "follow_up", "completed", None, t),
            (8, "follow_up", "completed", "eligible", t),
            (9, "follow_up", "rescheduled", None, None),
            (10, None, None, None, None),
        ],
        f"""id INT, appointment_type STRING, appointment_status STRING,
        eligibility_result STRING, completed_at {TS}""",
    )
    got = quality.appointment_rules(df).select("id")
    assert rows(got) == {(2,), (3,), (5,), (6,), (8,)}


def test_eligible_population_includes_the_exact_day(spark):
    t = ts("2024-01-01")
    df = spark.createDataFrame(
        [
            ("active", t, None),
            ("active", ts("2024-02-01"), None),
            ("cancelled", t, ts("2024-01-31")),
            ("cancelled", t, ts("2024-01-30 23:59:59")),
            ("pending", None, None),
        ],
        f"subscription_status STRING, activated_at {TS}, ended_at {TS}",
    )
    got = quality.eligible_population(df, "2024-02-29 00:00:00")
    assert rows(got) == {("active", 1), ("cancelled", 1)}


def test_appointment_timeline(spark):
    t = {day: ts(f"2024-01-{day:02d}") for day in range(1, 32)}
    subs = spark.createDataFrame(
        [(1, t[5], None), (2, None, None), (3, t[5], t[20])],
        f"subscription_id BIGINT, activated_at {TS}, ended_at {TS}",
    )
    intakes = spark.createDataFrame(
        [(1, 1, "completed", t[4]), (3, 3, "pending", None)],
        f"subscription_id BIGINT, intake_id BIGINT, intake_status STRING, completed_at {TS}",
    )
    appts = spark.createDataFrame(
        [
            (1, 1, "initial_appt", "completed", t[4], t[5]),
            (2, 1, "initial_appt", "completed", t[4], t[4]),
            (3, 1, "initial_appt", "completed", t[4], None),
            (4, 2, "initial_appt", "scheduled", t[4], None),
            (5, 3, "initial_appt", "scheduled", t[4], None),
            (6, 1, "follow_up", "completed", ts("2024-02-04"), None),
            (7, 1, "follow_up", "completed", ts("2024-02-03 23:59:59"), None),
            (8, 2, "follow_up", "scheduled", t[10], None),
            (9, 3, "follow_up", "scheduled", ts("2024-02-05"), None),
            (10, 1, "follow_up", "scheduled", ts("2024-03-01 00:00:01"), None),
            (11, 9, "initial_appt", "scheduled", t[4], None),
        ],
        f"""appointment_id BIGINT, subscription_id BIGINT, appointment_type STRING,
        appointment_status STRING, scheduled_at {TS}, completed_at {TS}""",
    )
    got = quality.timeline_violations(subs, appts, intakes, "2024-03-01 00:00:00")
    assert rows(got.select("appointment_id")) == {(i,) for i in (2, 4, 5, 7, 8, 9, 10)}


def test_first_charge_and_reversal(spark):
    t = ts("2024-01-01")
    subs = spark.createDataFrame(
        [(1, 1), (2, 2), (3, 1)], "subscription_id BIGINT, plan_id BIGINT"
    )
    plans = spark.createDataFrame(
        [(1, Decimal("9.00")), (2, Decimal("19.00"))],
        "plan_id BIGINT, monthly_price DECIMAL(10,2)",
    )
    intakes = spark.createDataFrame(
        [(1, "completed", t), (2, "completed", t), (3, "pending", None)],
        f"subscription_id BIGINT, intake_status STRING, completed_at {TS}",
    )
    appts = spark.createDataFrame(
        [
            (1, "initial_appt", "scheduled", None, None),
            (2, "initial_appt", "completed", "not_eligible", t + timedelta(days=1)),
            (2, "follow_up", "completed", "not_eligible", t),
            (3, "initial_appt", "completed", "not_eligible", t),
        ],
        f"""subscription_id BIGINT, appointment_type STRING, appointment_status STRING,
        eligibility_result STRING, completed_at {TS}""",
    )
    charges = transforms.first_charge(subs, plans, intakes, appts)
    paid = t + timedelta(hours=1)
    assert rows(charges) == {
        (1, paid, "successful", "initial", Decimal("9.00")),
        (2, paid, "successful", "initial", Decimal("19.00")),
    }
    payments = charges.withColumn("payment_id", F.col("subscription_id") * 10)
    back = transforms.full_reversal(payments, appts)
    assert rows(back.select("payment_id", "processed_at", "refund_amount")) == {
        (20, t + timedelta(days=1, minutes=30), Decimal("19.00"))
    }


def test_state_to_events_skips_missing_times(spark):
    a, b = ts("2024-01-01"), ts("2024-01-05")
    df = spark.createDataFrame(
        [(1, "cancelled", a, b), (2, "active", a, None), (3, "completed", b, b)],
        f"id BIGINT, status STRING, started {TS}, ended {TS}",
    )
    got = transforms.state_to_events(
        df,
        "id",
        {
            "began": ("started", None, None),
            "left": ("ended", F.lit("why"), F.col("status") == "cancelled"),
            "done": ("ended", None, F.col("ended") > F.col("started")),
        },
    )
    assert rows(got) == {
        (1, "began", None, a),
        (1, "left", "why", b),
        (1, "done", None, b),
        (2, "began", None, a),
        (3, "began", None, b),
    }


def test_lifecycle_coverage_counts_entities_without_events(spark):
    subs = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "sub BIGINT, status STRING")
    events = spark.createDataFrame(
        [(1, "a"), (1, "a"), (2, "b"), (9, "a")], "sub BIGINT, kind STRING"
    )
    got = quality.lifecycle_coverage(
        events, subs, "sub", "status", "kind", {"a": "a", "b": "b"}
    )
    assert rows(got) == {("x", 2, 1, 1), ("y", 1, 0, 0)}


# A subscription stored twice counts once.


def doubled(df):
    return df.unionAll(df)


def test_distinct_counts_with_a_doubled_row(spark):
    subs = spark.createDataFrame(
        [(1, 10, 7, "x", ts("2024-01-01"), ts("2024-01-03")), (2, 10, 8, "x", ts("2024-01-01"), None)],
        f"sub BIGINT, plan BIGINT, member BIGINT, status STRING, start {TS}, stop {TS}",
    )
    events = spark.createDataFrame(
        [(1, "in", "r"), (1, "out", "r"), (2, "in", None)], "sub BIGINT, kind STRING, why STRING"
    )
    members = spark.createDataFrame([(7, "web"), (8, "web")], "member BIGINT, channel STRING")
    dims = spark.createDataFrame([(10, "ten")], "plan BIGINT, name STRING")
    stages = {"entered": "in", "left": "out"}
    reported = [
        lambda s: reports.stage_funnel(
            events, s, dims, ["sub"], ["sub"], "plan", "kind", stages, {"rate": ("left", "entered")}
        ),
        lambda s: reports.conversion_by_dimension(
            s, members, "sub", "member", "channel", F.col("stop").isNotNull()
        ),
        lambda s: duration_stats(s, "start", "stop", ["plan"], entity="sub"),
        lambda s: reports.exit_reason_share_by_dimension(
            events, s, "sub", "kind", "out", "why", ["plan"]
        ),
        lambda s: quality.lifecycle_coverage(events, s, "sub", "status", "kind", stages),
    ]
    expected = [
        {(10, "ten", 2, 1, 50.0)},
        {("web", 2, 1, 50.0)},
        {(10, 1, 2.0, 2.0, 2.0)},
        {(10, "r", 1, 1, 100.0)},
        {("x", 2, 2, 1)},
    ]
    for report, rows_ in zip(reported, expected):
        assert rows(report(subs)) == rows(report(doubled(subs))) == rows_


def test_sort_order_and_null_placement(spark):
    """Ascending puts NULL last, descending first, and later keys break ties."""
    from subtide.functions import sort_keys

    df = spark.createDataFrame([(1, "b"), (None, "a"), (2, "a"), (1, None), (1, "a")], "n INT, s STRING")
    assert [tuple(r) for r in df.orderBy(*sort_keys("n", "s")).collect()] == [
        (1, "a"), (1, "b"), (1, None), (2, "a"), (None, "a")
    ]
    assert [tuple(r) for r in df.orderBy(*sort_keys("-n", "s")).collect()] == [
        (None, "a"), (2, "a"), (1, "a"), (1, "b"), (1, None)
    ]


def test_reports_come_sorted(spark):
    from subtide.plans.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    channels = [(-r.conversion_pct, r.acquisition_channel) for r in QUERIES["conversion_by_dimension"](spark, folder).collect()]
    assert channels == sorted(channels)
    pairs = [(r.appointment_status, r.eligibility_result is None, r.eligibility_result or "") for r in QUERIES["status_pair_counts"](spark, folder).collect()]
    assert pairs == sorted(pairs) and any(missing for _, missing, _ in pairs)


def test_a_missing_column_of_a_check_is_an_error(spark):
    from subtide.schemas import TABLES

    df = spark.createDataFrame([(1,)], "customer_id BIGINT")
    with pytest.raises(Exception, match="UNRESOLVED_COLUMN"):
        quality.check_constraints(df, "customers", TABLES["customers"].all_checks()).collect()


def test_every_declared_check_runs(spark):
    from subtide.plans.registry import QUERIES

    found = QUERIES["check_constraints"](spark, "/root/testdata/sf0.001").collect()
    updated = {r.table_name: r.failed_rows for r in found if r.check_name == "updated_after_created"}
    assert len(updated) == 7 and all(updated.values())


def test_checks_with_real_faults(spark):
    from subtide.plans.registry import QUERIES

    folder = "/root/testdata/sf0.001"
    keys = {r.key_name: r.duplicate_keys for r in QUERIES["uniqueness"](spark, folder).collect()}
    assert keys["orders.o_orderkey"] == 0 and keys["lineitem.l_orderkey+l_linenumber"] > 0
    relations = {r.relation for r in QUERIES["lifecycle_references"](spark, folder).collect()}
    assert len(relations) == 7
    assert QUERIES["duplicate_dimension_names"](spark, folder).count() > 0


def test_written_once_follows_its_sources(spark, tmp_path):
    from subtide.sources import written_once

    source = str(tmp_path / "a.parquet")
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(source)

    spark.range(3).write.parquet(source)
    assert [written_once(spark, "t", [source], build).count() for _ in range(2)] == [3, 3]
    assert len(calls) == 1
    spark.range(3).write.mode("append").parquet(source)
    assert written_once(spark, "t", [source], build).count() == 6
