from __future__ import annotations

import pytest
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from subtide.operators.numbering import dense_number
from subtide.plans.lifecycle import Lifecycle
from subtide.schemas import SIGNUP_FILE, TABLES
from subtide.sources import (
    append_table,
    read_positioned_csv,
    read_table,
    save_table,
    scratch,
    written,
)
from subtide.sources.tables import POSITION

SPARK_ERRORS = (PySparkException, Py4JError)
HEADER = "gender,signup_date,state_code,acquisition_channel\n"


def csv_file(folder, lines: list[str], name="signups.csv") -> str:
    path = folder / name
    path.write_text(HEADER + "".join(f"{line}\n" for line in lines))
    return str(path)


def test_csv_rows_keep_their_file_order_across_splits(spark, tmp_path):
    lines = [f"{'MF'[i % 2]},2024-01-{i % 28 + 1:02d},S{i % 10},c{i}" for i in range(5000)]
    path = csv_file(tmp_path, lines)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        df = read_positioned_csv(spark, path, SIGNUP_FILE)
        assert df.rdd.getNumPartitions() > 3
        numbered = dense_number(df, POSITION, name="customer_id", no_ties=True, drop=POSITION)
        assert not set(POSITION) & set(numbered.columns)
        got = numbered.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert all(r.acquisition_channel == f"c{r.customer_id - 1}" for r in got)
    assert len(got) == 5000


def test_csv_stops_on_a_bad_value_and_a_wrong_header(spark, tmp_path):
    bad = csv_file(tmp_path, ["M,not-a-date,TX,meta"], "bad.csv")
    with pytest.raises(SPARK_ERRORS):
        read_positioned_csv(spark, bad, SIGNUP_FILE).collect()
    other = tmp_path / "other.csv"
    other.write_text("gender,when,state_code,acquisition_channel\nM,2024-01-01,TX,meta\n")
    with pytest.raises(SPARK_ERRORS):
        read_positioned_csv(spark, str(other), SIGNUP_FILE).collect()


def test_save_append_and_read(spark, tmp_path):
    path = str(tmp_path / "t.parquet")
    df = spark.range(3).withColumn("x", F.lit("a"))
    save_table(df, path)
    append_table(spark.range(3, 5).withColumn("x", F.lit("b")), path)
    assert read_table(spark, str(tmp_path), "t").count() == 5
    with pytest.raises(SPARK_ERRORS):
        save_table(df, path)


def test_written_table_equals_its_source(spark):
    df = spark.range(100).withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    copy = written(df)
    assert copy.exceptAll(df).count() == 0
    assert copy.count() == 100
    assert "range" not in copy._jdf.queryExecution().logical().toString().lower()


class FakeSession:
    def __init__(self, master: str, root: str | None):
        self._conf, self.sparkContext = {scratch.SETTING: root}, self
        self.master, self.applicationId, self.conf = master, "app-1", self

    def get(self, key, default=None):
        return self._conf.get(key) or default

    def set(self, key, value):
        self._conf[key] = value


def test_scratch_folder_comes_from_the_session():
    assert scratch.scratch_root(FakeSession("yarn", "s3://x/ckpt/")) == "s3://x/ckpt/subtide-app-1"


def test_no_machine_local_scratch_on_a_cluster():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_root(FakeSession("spark://host:7077", None))


def test_local_scratch_is_set_once():
    session = FakeSession("local[2]", None)
    assert scratch.scratch_root(session) == scratch.scratch_root(session)


def test_lifecycle_reads_a_folder_of_tables(spark, tmp_path):
    for name, table in TABLES.items():
        save_table(spark.createDataFrame([], table.struct), str(tmp_path / f"{name}.parquet"))
    lc = Lifecycle.read(spark, str(tmp_path), "2024-01-01 00:00:00")
    assert all(df.count() == 0 for df in lc.tables().values())
    with pytest.raises(AttributeError):
        lc.unknown
    with pytest.raises(ValueError, match="missing"):
        Lifecycle("2024-01-01", plans=lc.plans)
