"""Table-to-table steps that derive lifecycle tables from one another."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from subtide.functions import days, first_match, hours, ntz
from subtide.operators.core import sized_broadcast
from subtide.operators.numbering import dense_number
from subtide.operators.ranges import binned_join
from subtide.sources import written


def cyclic_bucket(
    number: Column,
    modulus: int,
    ranges: Sequence[tuple[int, int, object]],
    default: object,
    multiplier: int = 1,
) -> Column:
    """Weighted assignment by position: ``(number - 1) * multiplier mod modulus`` in a range.

    Ranges are (first, last, value), both ends included. With a multiplier coprime to the
    modulus, every full cycle of numbers is split exactly by the widths of the ranges.
    """
    slot = (number - 1) * multiplier % modulus
    return first_match([(slot.between(a, b), F.lit(value)) for a, b, value in ranges], default)


def offset_days(base: str, number: Column, step: int, spread: int, least: int) -> Column:
    """``base`` plus between ``least`` and ``least + spread - 1`` days, chosen by the number."""
    return F.col(base) + days(number * step % spread + least)


def offset_hours(base: str, number: Column, step: int, spread: int, least: int) -> Column:
    return F.col(base) + hours(number * step % spread + least)


def derive_timestamps(
    df: DataFrame, rules: Mapping[str, Sequence[tuple[Column, Column]]]
) -> DataFrame:
    """Add one nullable timestamp per entry, by the first rule whose condition holds.

    Entries apply in order, so a later column may use an earlier one. Narrow, no shuffle.
    """
    for name, cases in rules.items():
        empty = F.lit(None).cast("timestamp_ntz")
        df = df.withColumn(name, first_match(cases).otherwise(empty))
    return df


# Zero-based numbers of the 30-day months (April, June, September, November).
THIRTY_DAY_MONTHS = (3, 5, 8, 10)


def expand_recurring(
    df: DataFrame, start: Column, stop: Column, name: str = "due_at"
) -> DataFrame:
    """One row per monthly due time from ``start`` to ``stop``, both included.

    Each due time is one month after the previous one, so a day cut by a short month stays
    cut: Jan 31, Feb 29, Mar 29. The k-th day is thus the smallest of the start day and the
    lengths of the months passed. Those lengths drop at three known steps: the first 30-day
    month, the first February, and the first February of 28 days. All of that is worked out
    once per input row; each output row costs one comparison chain. No shuffle, no array
    folding. A start after the stop gives no row.
    """
    first = F.trunc(F.col("_start").cast("date"), "month")
    month = F.month("_start") - 1
    to_february = F.pmod(-month, F.lit(12)) + 1
    next_february = F.last_day(F.add_months(first, to_february))
    is_leap = F.dayofmonth(next_february) == 29
    years_to_stop = F.year("_stop") - F.year("_start")
    spans = (
        df.withColumns({"_start": start, "_stop": stop})
        .filter(F.col("_start") <= F.col("_stop"))
        .withColumns(
            {
                # The start's clock time on the first of its month: adding months never cuts it.
                "_base": F.col("_start") - days(F.dayofmonth("_start") - 1),
                "_day": F.dayofmonth("_start"),
                "_to_30": F.least(
                    *[F.pmod(m - 1 - month, F.lit(12)) + 1 for m in THIRTY_DAY_MONTHS]
                ),
                "_to_29": to_february,
                # Two Februaries in a row are never both leap.
                "_to_28": to_february + F.when(is_leap, 12).otherwise(0),
                "_months": years_to_stop * 12 + F.month("_stop") - F.month("_start"),
            }
        )
    )

    def due(k: Column) -> Column:
        longest = first_match(
            [
                (k >= F.col("_to_28"), F.lit(28)),
                (k >= F.col("_to_29"), F.lit(29)),
                (k >= F.col("_to_30"), F.lit(30)),
            ],
            F.lit(31),
        )
        day = F.least(F.col("_day"), longest)
        return F.col("_base") + F.make_ym_interval(F.lit(0), k) + days(day - 1)

    # Only the due time in the stop's own month can lie beyond the stop.
    last = F.col("_months") - F.when(due(F.col("_months")) > F.col("_stop"), 1).otherwise(0)
    steps = spans.withColumn("_k", F.explode(F.sequence(F.lit(0), last)))
    return steps.select(*df.columns, due(F.col("_k")).alias(name))


def censor_at(
    df: DataFrame, cutoff: str, ts_col: str, status_col: str, fallback: str
) -> DataFrame:
    """Undo events after the cutoff: the time becomes NULL and the status falls back.

    An event exactly at the cutoff, and a row without the event, stay as they are. Only this one
    column is censored; earlier timestamps of the row are left alone.
    """
    late = F.col(ts_col) > ntz(cutoff)
    return df.withColumns(
        {
            status_col: F.when(late, F.lit(fallback)).otherwise(F.col(status_col)),
            ts_col: F.when(late, F.lit(None)).otherwise(F.col(ts_col)),
        }
    )


def due_status(
    df: DataFrame,
    cutoff: str,
    status_col: str,
    due: str,
    order_by: Sequence[str],
    window_days: int = 7,
    every: int = 12,
    name: str = "payment_status",
    no_ties: bool = False,
) -> DataFrame:
    """Status of a due payment: pending, failed or successful, first match wins.

    Pending if the owner is active and the due time is within the window before the
    cutoff; failed for every n-th row in order, where the numbering includes pending rows.
    ``no_ties`` says that the order is unique. Numbering reads its input twice: hand in a written
    table if ``df`` is expensive.
    """
    numbered = dense_number(df, order_by, name="_no", no_ties=no_ties)
    open_since = ntz(cutoff) - days(window_days)
    status = first_match(
        [
            ((F.col(status_col) == "active") & (F.col(due) >= open_since), F.lit("pending")),
            (F.col("_no") % every == 0, F.lit("failed")),
        ],
        F.lit("successful"),
    )
    return numbered.withColumn(name, status).drop("_no")


def first_charge(
    subscriptions: DataFrame, plans: DataFrame, intakes: DataFrame, appointments: DataFrame
) -> DataFrame:
    """The initial payment: one hour after a completed intake that led to an initial appointment.

    The appointment's own status does not matter. The amount is the plan's price.
    """
    completed = intakes.filter(F.col("intake_status") == "completed").select(
        "subscription_id", "completed_at"
    )
    initial = appointments.filter(F.col("appointment_type") == "initial_appt").select(
        "subscription_id"
    )
    prices = sized_broadcast(plans.select("plan_id", "monthly_price"))
    charged = (
        completed.join(initial, "subscription_id")
        .join(subscriptions.select("subscription_id", "plan_id"), "subscription_id")
        .join(prices, "plan_id")
    )
    return charged.select(
        "subscription_id",
        (F.col("completed_at") + hours(1)).alias("payment_date"),
        F.lit("successful").alias("payment_status"),
        F.lit("initial").alias("payment_type"),
        F.col("monthly_price").alias("amount"),
    )


def minutes(count: int) -> Column:
    return F.make_dt_interval(F.lit(0), F.lit(0), F.lit(count))


def full_reversal(payments: DataFrame, appointments: DataFrame) -> DataFrame:
    """Refund the successful initial payment after a not-eligible decision, 30 minutes later."""
    paid = payments.filter(
        (F.col("payment_type") == "initial") & (F.col("payment_status") == "successful")
    ).select("payment_id", "subscription_id", "amount")
    declined = appointments.filter(
        (F.col("appointment_type") == "initial_appt")
        & (F.col("appointment_status") == "completed")
        & (F.col("eligibility_result") == "not_eligible")
    ).select("subscription_id", F.col("completed_at").alias("created_at"))
    return paid.join(declined, "subscription_id").select(
        "payment_id",
        (F.col("created_at") + minutes(30)).alias("processed_at"),
        F.col("amount").alias("refund_amount"),
        F.lit("treatment_rejection").alias("refund_reason"),
        F.lit("completed").alias("refund_status"),
        "created_at",
    )


def latest_in_window(
    subscriptions: DataFrame, payments: DataFrame, lookback_days: int = 7
) -> DataFrame:
    """The latest successful payment of each cancelled subscription before its end.

    The window is [ended_at - lookback, ended_at]; of two payments at the same time the higher
    id wins. Payments and ends meet under (subscription, time bin), see ``binned_join``, so the
    payments of one subscription spread by time. The rank filter also runs before any shuffle above the join.
    """
    ended = subscriptions.filter(
        (F.col("subscription_status") == "cancelled") & F.col("ended_at").isNotNull()
    ).select("subscription_id", "ended_at")
    paid = payments.filter(F.col("payment_status") == "successful").select(
        "payment_id", "subscription_id", "payment_date", "amount"
    )
    newest = Window.partitionBy("subscription_id").orderBy(
        F.col("payment_date").desc(), F.col("payment_id").desc()
    )
    start = F.col("ended_at") - days(lookback_days)
    width = max(lookback_days, 1) * 86400
    found = binned_join(paid, ended, "subscription_id", "payment_date", start, F.col("ended_at"), width)
    return (
        found.withColumn("_rank", F.row_number().over(newest))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def cancellation_refunds(
    subscriptions: DataFrame,
    payments: DataFrame,
    cutoff: str,
    lookback_days: int = 7,
    declined_every: int = 5,
) -> DataFrame:
    """Refund requests 30 minutes after a cancellation; every n-th, by end and id, is declined.

    The ids of the payments must be unique.
    """
    latest = latest_in_window(subscriptions, payments, lookback_days)
    in_time = latest.filter(F.col("ended_at") + minutes(30) <= ntz(cutoff))
    numbered = dense_number(written(in_time), ["ended_at", "payment_id"], name="_no", no_ties=True)
    declined = F.col("_no") % declined_every == 0
    return numbered.select(
        "payment_id",
        (F.col("ended_at") + minutes(30)).alias("processed_at"),
        F.col("amount").alias("refund_amount"),
        F.lit("subscription_cancelled").alias("refund_reason"),
        F.when(declined, "declined").otherwise("completed").alias("refund_status"),
        F.col("ended_at").alias("created_at"),
    )


def state_to_events(
    df: DataFrame,
    entity: str,
    events: Mapping[str, tuple[str, Column | None, Column | None]],
) -> DataFrame:
    """One event row per state timestamp that is present.

    ``events`` maps an event type to (timestamp column, reason or None, condition or None).
    The source is read once whatever the number of types.
    """
    no_reason = F.lit(None).cast("string")
    choices = []
    for kind, (ts, reason, condition) in events.items():
        at = F.col(ts) if condition is None else F.when(condition, F.col(ts))
        choices.append(
            F.struct(
                F.lit(kind).alias("event_type"),
                (no_reason if reason is None else reason).alias("event_reason"),
                at.alias("event_timestamp"),
            )
        )
    return df.select(entity, F.inline(F.array(*choices))).filter(
        F.col("event_timestamp").isNotNull()
    )


def reason_from_context(
    subscriptions: DataFrame, intakes: DataFrame, appointments: DataFrame
) -> DataFrame:
    """Rejection events with the first reason that fits: expired intake, no-show, not eligible.

    Subscriptions without an initial appointment are kept.
    """
    rejected = subscriptions.filter(F.col("subscription_status") == "rejected")
    initial = appointments.filter(F.col("appointment_type") == "initial_appt").select(
        "subscription_id", "appointment_status"
    )
    context = (
        rejected.select("subscription_id", "ended_at")
        .join(intakes.select("subscription_id", "intake_status"), "subscription_id")
        .join(initial, "subscription_id", "left")
    )
    reason = first_match(
        [
            (F.col("intake_status") == "expired", F.lit("intake_expired")),
            (F.col("appointment_status") == "no_show", F.lit("appointment_no_show")),
        ],
        F.lit("not_eligible"),
    )
    return context.select(
        "subscription_id",
        F.lit("rejected").alias("event_type"),
        reason.alias("event_reason"),
        F.col("ended_at").alias("event_timestamp"),
    )


def update_from(
    target: DataFrame,
    source: DataFrame,
    on: Sequence[str],
    sets: Mapping[str, Column],
    when: Column | None = None,
) -> DataFrame:
    """Set columns of the target from its matching source row.

    Expressions name target columns ``t.x`` and source columns ``s.x`` and read the row as it
    was before the update. Rows without a match, or not meeting ``when``, are unchanged.
    The source must hold one row per key, or target rows would multiply; ``one_per_key`` picks one.
    """
    t, s = target.alias("t"), source.withColumn("_found", F.lit(True)).alias("s")
    same = reduce(and_, [F.col(f"t.{c}") == F.col(f"s.{c}") for c in on])
    hit = F.col("s._found").isNotNull()
    if when is not None:
        hit = hit & when
    columns = [
        F.when(hit, sets[c]).otherwise(F.col(f"t.{c}")).alias(c)
        if c in sets
        else F.col(f"t.{c}")
        for c in target.columns
    ]
    return t.join(s, same, "left").select(*columns)


def one_per_key(source: DataFrame, on: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The last row of each key by an order, all columns; a tie goes to the row with the larger hash.

    Counted map-side: a key with a third of all rows sends one row per task.
    """
    rest = [c for c in source.columns if c not in on]
    rank = F.struct(*order_by, F.xxhash64(*source.columns).alias("_hash"))
    rows = source.groupBy(*on).agg(F.max_by(F.struct(*rest), rank).alias("_row"))
    return rows.select(*[F.col(c) if c in on else F.col(f"_row.{c}").alias(c) for c in source.columns])


def bounded_event(df: DataFrame, ts: str, after: str, not_after: Column) -> DataFrame:
    """Keep derived events strictly after one time and not after another."""
    return df.filter((F.col(ts) > F.col(after)) & (F.col(ts) <= not_after))


def append_with_defaults(
    target: DataFrame,
    rows: DataFrame,
    key: str,
    order_by: Sequence[str],
    defaults: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The new rows in the target's shape: next dense keys, defaults for columns not given.

    A column the rows do carry wins over its default, NULL included. A target column with
    neither becomes NULL. The result is to be appended; the target is not rewritten.
    """
    last = target.agg(F.max(key)).first()[0] or 0
    numbered = dense_number(rows, order_by, name=key, start=last + 1)
    columns = []
    for field in target.schema:
        if field.name in numbered.columns:
            value = F.col(field.name)
        else:
            value = (defaults or {}).get(field.name, F.lit(None))
        columns.append(value.cast(field.dataType).alias(field.name))
    return numbered.select(*columns)
