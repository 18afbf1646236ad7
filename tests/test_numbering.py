"""Numbering against plain Python, with hot groups and repeated rows."""

from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from subtide.operators import numbering
from subtide.operators.core import sized_broadcast
from subtide.operators.numbering import dense_number, every_nth

HOT = "hot"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of 60,000 rows in one group, the rest in 200 groups, in random order."""
    group = F.when(F.col("id") % 3 == 0, HOT).otherwise(
        F.concat(F.lit("g"), (F.col("id") % 200).cast("string"))
    )
    return spark.range(60_000).select(
        group.alias("g"), (F.xxhash64("id") % 1000).alias("v"), "id"
    ).repartition(7)


def expected(rows, by_group: bool) -> dict[int, int]:
    counters: dict = {}
    out = {}
    for r in sorted(rows, key=lambda r: (r.g if by_group else "", r.v, r.id)):
        key = r.g if by_group else None
        counters[key] = out[r.id] = counters.get(key, 0) + 1
    return out


@pytest.mark.parametrize("by_group", [False, True])
def test_numbers_are_dense_and_in_order(skewed, by_group):
    numbered = dense_number(skewed, ["v", "id"], ["g"] if by_group else [])
    got = {r.id: r.row_no for r in numbered.collect()}
    assert got == expected(skewed.collect(), by_group)


def test_a_hot_group_is_spread_over_tasks(spark, skewed, monkeypatch):
    parts = spread(spark, monkeypatch, skewed, ["v", "id"], ["g"])
    assert len([key for key in parts if key[1] == HOT]) > 1
    assert max(parts.values()) < 60_000 / 3


def spread(spark, monkeypatch, df, *args) -> dict:
    """Rows per task of the written table, without merging small partitions."""
    kept = []
    plain = numbering.written
    monkeypatch.setattr(numbering, "written", lambda d: kept.append(plain(d)) or kept[-1])
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")
    try:
        dense_number(df, *args)
    finally:
        spark.conf.set(conf, "true")
    tasks = kept[0].groupBy(F.shiftright("_pos", 33).alias("task"), *df.columns[:1]).count()
    return {tuple(r)[:2]: r["count"] for r in tasks.collect()}


def test_a_frequent_order_value_is_spread_and_repeatable(spark, skewed, monkeypatch):
    parts = spread(spark, monkeypatch, skewed, ["g"])
    assert len([key for key in parts if key[1] == HOT]) > 1
    assert max(parts.values()) < 60_000 / 3
    first = {r.id: r.row_no for r in dense_number(skewed, ["g"]).collect()}
    again = {r.id: r.row_no for r in dense_number(skewed.repartition(3), ["g"]).collect()}
    assert first == again


def test_copies_of_one_row_are_spread_and_counted_once_each(spark, monkeypatch):
    copied = F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id"))
    df = spark.range(60_000).select(copied.alias("v")).repartition(7)
    kept = []
    plain = numbering.written
    monkeypatch.setattr(numbering, "written", lambda d: kept.append(plain(d)) or kept[-1])
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        numbered = dense_number(df, ["v"], spread_copies=True)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert numbered.columns == ["v", "row_no"]
    got = numbered.collect()
    assert sorted(r.row_no for r in got) == list(range(1, 60_001))
    assert {r.row_no for r in got if r.v == -1} == set(range(1, 20_001))
    tasks = kept[-1].filter("v = -1").select(F.shiftright("_pos", 33)).distinct().count()
    assert tasks > 1


def test_columns_that_cannot_be_hashed(spark):
    df = spark.range(5).select(F.create_map(F.lit("k"), "id").alias("m"), "id")
    assert sorted(r.row_no - r.id for r in dense_number(df, ["id"]).collect()) == [1] * 5


def test_many_groups_need_no_broadcast(skewed, monkeypatch):
    monkeypatch.setattr(numbering, "sized_broadcast", lambda df: sized_broadcast(df, max_bytes=10))
    got = {r.id: r.row_no for r in dense_number(skewed, ["v", "id"], ["g"]).collect()}
    assert got == expected(skewed.collect(), True)


def test_many_slices_shuffle_the_table_once(spark):
    """Half a million offsets are sent to the tasks; the numbered rows stay where they were written."""
    df = spark.range(500_000).select(F.col("id").alias("g"), (-F.col("id")).alias("v"))
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    numbered = dense_number(df, ["v"], ["g"])
    assert numbered.agg(F.sum("row_no")).first()[0] == 500_000
    numbered.write.format("noop").mode("overwrite").save()
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    spark.conf.set(key, before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "hashpartitioning(_task" not in plan


def test_ranges_follow_the_size_of_the_input(spark, monkeypatch):
    df = spark.range(100_000)
    assert numbering._ranges(df) == 8
    monkeypatch.setattr(numbering, "RANGE_BYTES", 20_000)
    assert numbering._ranges(df) == 40
    assert sorted(r.row_no - r.id for r in dense_number(df.limit(50), ["id"], ranges=3).collect()) == [1] * 50


def test_start_and_null_groups(spark):
    df = spark.createDataFrame([(None, 3), (None, 1), ("a", 2)], "g STRING, v INT")
    got = {(r.g, r.v): r.row_no for r in dense_number(df, ["v"], ["g"], start=10).collect()}
    assert got == {(None, 1): 10, (None, 3): 11, ("a", 2): 10}


def test_empty_input(spark):
    df = spark.createDataFrame([], "g STRING, v INT")
    assert dense_number(df, ["v"]).count() == 0


def test_equal_rows_get_consecutive_numbers(spark):
    df = spark.range(3000).select((F.col("id") % 3).alias("v"))
    got = dense_number(df, ["v"]).collect()
    assert sorted(r.row_no for r in got) == list(range(1, 3001))
    assert all((r.row_no - 1) // 1000 == r.v for r in got)


def test_every_nth(spark):
    df = spark.range(1, 24).withColumnRenamed("id", "n")
    assert sorted(r.n for r in every_nth(df, ["n"], 5).collect()) == [5, 10, 15, 20]
    kept = every_nth(df, ["n"], 5, keep=(0, 1, 2), first=0).collect()
    assert sorted(r.n for r in kept) == [n for n in range(1, 24) if (n - 1) % 5 < 3]


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    data=st.lists(st.tuples(st.sampled_from("abc"), st.integers(-5, 5)), min_size=1, max_size=60)
)
def test_any_table(spark, data):
    rows = [(g, v, i) for i, (g, v) in enumerate(data)]
    df = spark.createDataFrame(rows, "g STRING, v INT, id INT")
    got = {r.id: r.row_no for r in dense_number(df, ["v", "id"], ["g"]).collect()}
    assert got == expected(df.collect(), True)


def test_ranges_fit_a_sort_and_map_tasks_need_none(spark, monkeypatch):
    """Sixteen times the old range is cut; many shuffle partitions do not make map tasks sort a table of 8 GB."""
    df = spark.range((256 << 20) // 8)
    assert numbering._ranges(df) == 16
    conf = "spark.sql.shuffle.partitions"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "500")
    try:
        assert numbering._ranges(df) == 200
        assert numbering._ranges(spark.range((8 << 30) // 8)) == 200
        assert numbering._ranges(spark.range((32 << 30) // 8)) == 512
    finally:
        spark.conf.set(conf, before)


def test_numbered_lines_are_written_once(spark, monkeypatch, tmp_path):
    from subtide.plans import bindings
    from subtide.sources import scratch

    day = "TIMESTAMP_NTZ '1998-03-01 00:00:00'"
    line = f"id, 2L, 3L, 1, 4D, 10.5D, 0.1D, 0.05D, 'R', 'F', {day}"
    names = [part.split()[0] for part in bindings.TABLES["lineitem"].split(",")]
    lines = spark.range(50).selectExpr(f"inline(array(struct({line})))").toDF(*names)
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    stored = []
    for module in (numbering, scratch):
        plain = module.written
        monkeypatch.setattr(module, "written", lambda df, plain=plain: stored.append(df.columns) or plain(df))
    lc = bindings.lifecycle(spark, str(tmp_path), ids=True)
    assert sorted(r.payment_id for r in lc.payments.collect()) == list(range(1, 51))
    again = bindings.lifecycle(spark, str(tmp_path), ids=True)
    assert {(r.payment_id, r.subscription_id) for r in again.payments.collect()} == {(i + 1, i) for i in range(50)}
    assert sum("l_extendedprice" in columns for columns in stored) == 1
