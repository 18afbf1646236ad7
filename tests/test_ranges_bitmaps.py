"""Joins by time bins, and distinct counts, repeats and orphans by bitmaps."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from subtide.operators import bitmaps, quality, transforms
from subtide.operators.ranges import binned_join, time_bin
from subtide.sources import written

START = datetime(2024, 1, 1)
DAY = 86400


def exchanges(plan):
    """(partitioning, rows written) of every shuffle in a plan that has run."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from exchanges(plan.executedPlan())
    elif kind in ("ShuffleQueryStageExec", "BroadcastQueryStageExec"):
        yield from exchanges(plan.plan())
    elif kind == "ShuffleExchangeExec":
        yield plan.outputPartitioning().toString(), plan.metrics().apply("shuffleRecordsWritten").value()
    children = plan.children()
    for i in range(children.length()):
        yield from exchanges(children.apply(i))


def run(df):
    rows = df.collect()
    return rows, list(exchanges(df._jdf.queryExecution().executedPlan()))


# --- time bins ----------------------------------------------------------------------------------


def test_bins_are_as_wide_as_asked(spark):
    times = ["1970-01-01 00:00:00", "1970-01-01 00:59:59.999999", "1970-01-01 01:00:00", "1969-12-31 23:59:59"]
    df = spark.createDataFrame([(t,) for t in times], "t string").select(F.col("t").cast("timestamp_ntz"))
    assert [r[0] for r in df.select(time_bin("t", 3600)).collect()] == [0, 0, 1, -1]


@pytest.mark.parametrize("width", [600, DAY, 30 * DAY])
def test_binned_join_equals_all_pairs(spark, width):
    dice = random.Random(width)
    rows = [(i, dice.randrange(4), START + timedelta(minutes=dice.randrange(6000))) for i in range(300)]
    spans = []
    for i in range(60):
        low = START + timedelta(minutes=dice.randrange(6000))
        spans.append((100 + i, dice.randrange(5), low, low + timedelta(minutes=dice.randrange(-30, 900))))
    # Bounds that equal a row's time, a point, and what meets nothing.
    spans += [(200, 1, rows[0][2], rows[0][2]), (201, rows[1][1], rows[1][2], rows[1][2])]
    spans += [(202, 1, None, START), (203, 1, START, None), (204, None, START, START + timedelta(90))]
    rows += [(900, 1, None), (901, None, START)] + rows[:5]
    expected = Counter(
        (r, s) for r, k, at in rows for s, j, low, high in spans if k is not None and k == j and at and low and high and low <= at <= high
    )
    left = spark.createDataFrame(rows, "row long, k int, at timestamp_ntz")
    right = spark.createDataFrame(spans, "span long, k int, low timestamp_ntz, high timestamp_ntz")
    joined = binned_join(left, right, "k", "at", F.col("low"), F.col("high"), width)
    assert joined.columns == ["k", "row", "at", "span", "low", "high"]
    assert Counter((r.row, r.span) for r in joined.collect()) == expected


@pytest.fixture
def no_help(spark):
    """No skew joins, no broadcasts, and partitions as they come from the shuffle."""
    conf = {
        "spark.sql.adaptive.skewJoin.enabled": "false",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_a_hot_key_spreads_by_time(spark, no_help):
    """A third of all payments and cancelled spans of one key: no task gets more than a fraction of them."""
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 40).cast("int"))
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.lit(5000)))
    rows = spark.range(120_000).select(key.alias("k"), at.alias("at"), F.col("id").alias("row"))
    spans = spark.range(0, 120_000, 100).select(F.lit(7).cast("long").alias("k"), at.alias("high"))
    spans = spans.withColumn("low", F.col("high") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(30)))
    joined = binned_join(rows, spans, "k", "at", F.col("low"), F.col("high"), 3600)
    placed = joined.groupBy(F.spark_partition_id()).count().collect()
    counts = [r["count"] for r in placed]
    assert len(counts) == 16 and max(counts) < 3 * sum(counts) / 16


def test_latest_in_window_spreads_a_hot_subscription(spark, no_help):
    """One subscription, cancelled often enough to be found in every bin, against all pairs."""
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("id") * 7).cast("int"))
    payments = spark.range(5000).select(
        F.col("id").alias("payment_id"),
        F.lit(1).cast("long").alias("subscription_id"),
        at.alias("payment_date"),
        F.when(F.col("id") % 2 == 0, "successful").otherwise("failed").alias("payment_status"),
        F.lit(9).alias("amount"),
    )
    end = F.lit("2024-01-11 12:00:00").cast("timestamp_ntz")
    subscriptions = spark.range(2).select(
        F.col("id").alias("subscription_id"), F.lit("cancelled").alias("subscription_status"), end.alias("ended_at")
    )
    found = transforms.latest_in_window(written(subscriptions), written(payments))
    assert "hashpartitioning(subscription_id" in found._jdf.queryExecution().executedPlan().toString()
    assert "_bin" in found._jdf.queryExecution().executedPlan().toString()
    minutes = (datetime(2024, 1, 11, 12) - START).total_seconds() / 60
    latest = max(i for i in range(0, 5000, 2) if i * 7 <= minutes)
    assert [r.payment_id for r in found.collect()] == [latest]


# --- bitmaps --------------------------------------------------------------------------------------


def table(spark, values, name="v", kind="long"):
    return written(spark.createDataFrame([(v,) for v in values], f"{name} {kind}"))


VALUES = [0, 1, 1, 5, -1, -32768, -32769, 32767, 32768, 70000, 70000, 70000, None, None, 2**40]


@pytest.mark.parametrize("values", [VALUES, [], [None], [3], [None, None, 3, 3]])
def test_counts_and_repeats_equal_a_plain_count(spark, values):
    df = table(spark, values)
    pairs = bitmaps.close_together([(df, "v")])[0]
    assert pairs is not None or not values
    assert bitmaps.distinct_count(df, "v", "n").first()[0] == len(set(values) - {None})
    counts = Counter(values)
    found = {r["value"]: r["row_count"] for r in bitmaps.repeats(df, "v", pairs or 0).collect()}
    assert found == {v: n for v, n in counts.items() if n > 1}


@pytest.mark.parametrize("parents", [VALUES, [], [1, 2, 3], [0, 1, 5, -1, 70001, 2**40]])
def test_missing_keys_equal_an_anti_join(spark, parents):
    child, parent = table(spark, VALUES), table(spark, parents, "p", "int" if parents == [1, 2, 3] else "long")
    found = {r["missing_key"]: r["row_count"] for r in bitmaps.missing(child, "v", parent, "p", 10).collect()}
    assert found == {v: n for v, n in Counter(VALUES).items() if v is not None and v not in parents}
    checked = quality.referential_integrity({"r": (child, "v", parent, "p")}).collect()
    assert {r.missing_key: r.row_count for r in checked} == found


def test_values_far_apart_are_compared_as_before(spark):
    """One bitmap per value would be 4 KB a row."""
    far = spark.range(5000).select(F.xxhash64("id").alias("far"), "id", F.col("id").cast("string").alias("text"))
    assert bitmaps.close_together([(far, "far"), (far, "id"), (far, "text")])[::2] == [None, None]
    assert bitmaps.close_together([(far, "id")])[0] is not None
    profile = quality.column_profile(far.withColumn("d", F.lit("2024-01-01").cast("date")), "d", ["far", "id", "text"])
    assert [profile.first()[f"distinct_{c}"] for c in ("far", "id", "text")] == [5000] * 3
    keys = quality.uniqueness({c: (far, [c]) for c in ("far", "id", "text")}).collect()
    assert all((r.duplicate_keys, r.surplus_rows) == (0, 0) for r in keys)


def test_no_exchange_by_value(spark):
    df = written(spark.range(0, 200_000, 1, 8).select("id", (F.col("id") % 1000).alias("k")))
    rows, shuffled = run(bitmaps.distinct_count(df, "id", "n"))
    assert rows[0][0] == 200_000
    # 7 buckets, from 8 tasks, and then one row each.
    assert all("bucket" in kind or "Single" in kind for kind, _ in shuffled)
    assert sum(n for _, n in shuffled) < 200


def test_clean_keys_and_relations_shuffle_no_key(spark):
    ids = written(spark.range(0, 100_000, 1, 8))
    child = written(spark.range(0, 100_000, 1, 8).select((F.col("id") * 3 % 100_000).alias("id")))
    for frame in (bitmaps.repeats(ids, "id", 64), bitmaps.missing(child, "id", ids, "id", 64)):
        rows, shuffled = run(frame)
        assert rows == [] and sum(n for _, n in shuffled) < 200
    gap = ids.filter("id <> 40000")
    rows, shuffled = run(bitmaps.missing(child, "id", gap, "id", 64))
    assert [tuple(r) for r in rows] == [(40000, 1)]
    # Both sides' values of one bucket.
    assert sum(n for _, n in shuffled) < 2 * 32768 + 200


def test_missing_keys_shuffle_a_row_for_several_values_and_sort_nothing(spark):
    ids = written(spark.range(0, 100_000, 1, 8))
    child = written(spark.range(0, 100_000, 1, 8).select((F.col("id") * 3 % 100_000).alias("id")))
    frame = bitmaps.missing(child, "id", ids.filter("id <> 40000"), "id", 64)
    rows, shuffled = run(frame)
    assert [tuple(r) for r in rows] == [(40000, 1)]
    assert sum(n for _, n in shuffled) < 32768
    scattered = quality.orphans(child, "id", ids.filter("id % 7 <> 3"), "id")
    plan = scattered._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Sort" not in plan
    assert {tuple(r) for r in scattered.collect()} == {(i, 1) for i in range(100_000) if i % 7 == 3}
