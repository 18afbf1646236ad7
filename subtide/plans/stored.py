"""Reports and checks over tables that are stored for them: checked, partitioned, bucketed."""

from __future__ import annotations

import uuid
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from subtide.operators import partitions, quality
from subtide.plans.bindings import TABLES, open_table
from subtide.plans.lifecycle import Lifecycle
from subtide.schemas import TABLES as LIFECYCLE
from subtide.sources import open_for_figures, save_bucketed, scratch_root, written_checked

MONTHS = (date(1998, 3, 1), date(1998, 5, 1))


def checks_on_write(lc: Lifecycle) -> DataFrame:
    """Failed rows per declared check, counted by the tasks that write the eight tables."""
    figures = [written_checked(df, name, LIFECYCLE[name].all_checks())[1] for name, df in lc.tables().items()]
    return reduce(DataFrame.unionByName, figures)


def key_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, least and largest value of every integer column of the order tables, from the footers."""
    found = []
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"):
        df = open_for_figures(spark, f"{folder}/{name}.parquet", TABLES[name])
        whole = [f.name for f in df.schema if isinstance(f.dataType, (ByteType, ShortType, IntegerType, LongType))]
        bounds = [b(c).alias(f"{n}_{c}") for c in whole for n, b in (("low", F.min), ("high", F.max))]
        row = df.agg(F.count(F.lit(1)).alias("row_count"), *bounds)
        column = F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column_name"),
                        F.col(f"low_{c}").cast("long").alias("min_value"),
                        F.col(f"high_{c}").cast("long").alias("max_value"),
                    )
                    for c in whole
                ]
            )
        )
        found.append(row.select(F.lit(name).alias("table_name"), "row_count", column))
    return reduce(DataFrame.unionByName, found)


def successful_partials(lc: Lifecycle) -> DataFrame:
    """Monthly partials of successful payments: stored without the last two months, which are then added."""
    spark = lc.payments.sparkSession
    paid = lc.payments.filter(F.col("payment_status") == "successful")
    stored = partitions.MonthlyPartials(
        spark, f"{scratch_root(spark)}/{uuid.uuid4().hex}", "payment_date", ["payment_type"], "amount"
    )
    last = paid.agg(F.max("payment_date").cast("date")).first()[0]
    if last is None:
        stored.refresh(paid)
        return stored.read(paid)
    newest = last.replace(day=1)
    before = date(newest.year - (newest.month == 1), (newest.month - 2) % 12 + 1, 1)
    old = F.col("payment_date").isNull() | (F.col("payment_date") < F.lit(before).cast("timestamp_ntz"))
    stored.refresh(paid.filter(old))
    stored.refresh(paid, [before, newest])
    return stored.read(paid)


def partials_comparison(lc: Lifecycle) -> DataFrame:
    return partitions.comparison(successful_partials(lc), *MONTHS, ["payment_type"])


def partials_extremes(lc: Lifecycle) -> DataFrame:
    return partitions.extremes(successful_partials(lc))


def partition_update(spark: SparkSession, folder: str) -> DataFrame:
    """Orders stored by priority; urgent ones of six lines or more take the date of their last shipment."""
    path = f"{scratch_root(spark)}/{uuid.uuid4().hex}"
    columns = ["o_orderkey", "o_orderdate", "o_orderpriority"]
    orders = open_table(spark, folder, "orders").select(*columns)
    orders.repartition("o_orderpriority").write.partitionBy("o_orderpriority").parquet(path)
    shipped = open_table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    shipped = shipped.agg(F.max("l_shipdate").alias("last_ship"), F.count(F.lit(1)).alias("lines"))
    urgent = F.col("t.o_orderpriority").startswith("1") & (F.col("s.lines") >= 6)
    target = spark.read.schema(orders.schema).parquet(path)
    sets = {"o_orderdate": F.col("s.last_ship")}
    partitions.update_partitions(target, path, ["o_orderpriority"], shipped, ["o_orderkey"], sets, urgent)
    return spark.read.schema(orders.schema).parquet(path).select(*columns)


def bucketed_prerequisites(lc: Lifecycle) -> DataFrame:
    """The prerequisite check on subscriptions and intakes in buckets: the join has no exchange."""
    spark = lc.subscriptions.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    subscriptions, intakes = (
        save_bucketed(df, f"{name}_{uuid.uuid4().hex}", "subscription_id", buckets)
        for name, df in (("subscriptions", lc.subscriptions), ("intakes", lc.intakes))
    )
    return quality.prerequisite_violations(subscriptions, intakes)
