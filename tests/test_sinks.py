import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarterbell.operators import table_columns, with_day, with_hour, with_run_date
from quarterbell.functions import event_time
from quarterbell.schema import table_schema
from quarterbell.session import new_folder, shared_folder
from quarterbell.sinks import (
    DAILY_COMMIT,
    CommitRule,
    append_files,
    append_table,
    commit_pending,
    committable_partitions,
    create_table,
    list_tables,
    partition_time,
    read_files,
    use_database,
    written_partitions,
)


def hourly(make_readings, *hours, value=1):
    readings = make_readings([("a", value, f"2024-01-01 {hour:02}:30:00") for hour in hours])
    stamped = readings.withColumn("ts", event_time(F.col("sampletime")))
    return table_columns(with_hour(stamped), "dt", "hr")


def at(text):
    return F.lit(text + "Z").cast("timestamp")


def test_decimal_conversion_rounds_and_never_stops(spark, make_readings):
    rows = make_readings([("a", v, "x") for v in (12.31, 0.123456785, -0.123456785, 1e21, 1e23, float("nan"))])
    assert [r.value1 for r in table_columns(rows).collect()] == [
        Decimal("12.31000000"), Decimal("0.12345679"), Decimal("-0.12345679"), Decimal("1E21"), None, None]


def test_flat_daily_and_hourly_round_trip(spark, make_readings):
    readings = make_readings([("a", 1, "2024-01-01 00:30:00"), ("b", 2, "2024-01-02 01:30:00")])
    rows = table_columns(readings)
    hourly_rows = with_hour(rows.withColumn("ts", event_time(F.col("sampletime")))).drop("ts")
    for data, partitions in (
        (rows, ()), (with_day(rows), ("daytime",)), (with_run_date(rows, 1704067200000), ("daytime",)),
        (hourly_rows, ("dt", "hr")),
    ):
        path = new_folder(spark, "sink")
        append_files(data, path, partitions)
        append_files(data, path, partitions)
        back = read_files(spark, path, partitions)
        assert back.schema == table_schema(partitions)
        assert sorted(back.collect()) == sorted(data.collect() * 2)


def test_partition_texts_survive_reading(spark, make_readings):
    path = new_folder(spark, "text")
    append_files(hourly(make_readings, 0, 9), path, ("dt", "hr"))
    assert {r.hr for r in read_files(spark, path, ("dt", "hr")).collect()} == {"00", "09"}


def test_a_partition_filter_prunes_files(spark, make_readings):
    path = new_folder(spark, "prune")
    append_files(hourly(make_readings, *range(6)), path, ("dt", "hr"))
    plan = read_files(spark, path, ("dt", "hr")).where("hr = '03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(hr" in plan and plan.count("DataFilters: []") == 1


def test_tables_are_made_once_and_filled_by_name(spark, make_readings):
    use_database(spark, "ods")
    try:
        for _ in range(2):
            create_table(spark, "hourly_readings", ("dt", "hr"))
        assert "hourly_readings" in list_tables(spark)
        rows = hourly(make_readings, 1, 2)
        append_table(rows, "hourly_readings", ("dt", "hr"))
        shuffled = rows.select("sampletime", "value1", "measuretag", "measurepointid", "dt", "hr")
        append_table(shuffled, "ods.hourly_readings", ("dt", "hr"))
        table = spark.table("hourly_readings")
        assert table.schema == table_schema(("dt", "hr"))
        assert sorted(table.collect()) == sorted(rows.collect() * 2)
    finally:
        spark.catalog.setCurrentDatabase("default")


@pytest.mark.parametrize("pattern, row, expected", [
    ("$dt $hr:00:00", {"dt": "2024-01-01", "hr": "05"}, "2024-01-01 05:00:00"),
    ("$daytime", {"daytime": "2024-03-10"}, "2024-03-10 00:00:00"),
])
def test_partition_time(spark, any_zone, pattern, row, expected):
    frame = spark.createDataFrame([tuple(row.values())], list(row))
    seen = frame.select(F.unix_millis(partition_time(pattern)) == F.unix_millis(at(expected))).head()[0]
    assert seen is True


def test_due_only_after_time_plus_delay(spark, any_zone):
    parts = spark.createDataFrame([("2024-01-01", f"{h:02}") for h in range(4)], "dt STRING, hr STRING")
    hours = lambda wm, delay: sorted(r.hr for r in committable_partitions(
        parts, at(wm), CommitRule(("dt", "hr"), "$dt $hr:00:00", delay, ())).collect())
    assert hours("2024-01-01 02:15:00", 900) == ["00", "01"]
    assert hours("2024-01-01 02:15:01", 900) == ["00", "01", "02"]
    assert hours("2024-01-01 00:00:01", 0) == ["00"]


def test_commit_registers_marks_and_repeats_only_for_new_files(spark, make_readings):
    path, partitions = new_folder(spark, "commit"), ("dt", "hr")
    append_files(hourly(make_readings, 0, 1, 2), path, partitions)
    create_table(spark, "committed_hours", partitions, path)
    commit = lambda: [r.hr for r in commit_pending(
        spark, "committed_hours", path, path + "-ledger", at("2024-01-01 01:30:00"))]
    assert commit() == ["00", "01"]
    listed = [r.partition for r in spark.sql("SHOW PARTITIONS committed_hours").collect()]
    assert listed == ["dt=2024-01-01/hr=00", "dt=2024-01-01/hr=01"]
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    marked = lambda hour: (lambda p: p.getFileSystem(conf).exists(p))(hadoop(f"{path}/dt=2024-01-01/hr={hour}/_SUCCESS"))
    assert marked("00") and marked("01") and not marked("02")
    assert commit() == []
    time.sleep(0.05)
    append_files(hourly(make_readings, 1, value=2), path, partitions)
    assert commit() == ["01"]
    assert commit() == []
    assert read_files(spark, path, partitions).count() == 4


def test_metastore_policy_alone_leaves_no_file(spark, make_readings):
    path = new_folder(spark, "daily")
    rows = with_day(table_columns(make_readings([("a", 1, "2024-01-01 00:30:00"), ("a", 1, "2024-01-02 00:30:00")])))
    append_files(rows, path, ("daytime",))
    create_table(spark, "daily_readings", ("daytime",), path)
    done = commit_pending(
        spark, "daily_readings", path, path + "-ledger", at("2024-01-02 00:00:00"), DAILY_COMMIT)
    assert [r.daytime for r in done] == ["2024-01-01"]
    names = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").collect()
    assert not [r for r in names if "daytime" in r.path and r.path.endswith("_SUCCESS")]


def test_listing_written_partitions_opens_no_file(spark, make_readings):
    path = new_folder(spark, "written")
    append_files(hourly(make_readings, 3, 4), path, ("dt", "hr"))
    written = written_partitions(spark, path, ("dt", "hr"))
    assert sorted((r.dt, r.hr) for r in written.collect()) == [("2024-01-01", "03"), ("2024-01-01", "04")]
    plan = written._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<path:string,modificationTime:timestamp>" in plan


def test_shared_folder_is_the_one_the_session_names(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert new_folder(spark, "x") != new_folder(spark, "x")


def test_a_cluster_must_name_a_shared_folder():
    class Context:
        master = "yarn"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)
