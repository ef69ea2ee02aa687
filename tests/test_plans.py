"""What the physical plans must look like to hold at a thousand times the data."""

import contextlib
import re

import pytest
from pyspark.sql import functions as F

from checks import queries as registered
from checks.bindings import as_messages, events
from quarterbell import JobOptions
from quarterbell.operators import (
    in_windows,
    late_readings,
    newest_per_window,
    on_time_readings,
    readings,
    table_columns,
    with_event_time,
    with_hour,
)
from quarterbell.plans import flat_rows, hourly_rows, quarter_hour_rows
from quarterbell.session import new_folder
from quarterbell.sinks import append_files, read_files

SF = "/root/testdata/sf0.01"


@contextlib.contextmanager
def settings(spark, values):
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def plan(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def operators(frame, name):
    return len(re.findall(rf"^[\s:+\-*()\d]*{name}\b", plan(frame), re.M))


@pytest.fixture
def messages(spark):
    path = spark.conf.get("spark.checkpoint.dir") + "/plan-messages"
    as_messages(events(spark, SF)).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def late_messages(spark):
    path = spark.conf.get("spark.checkpoint.dir") + "/late-messages"
    as_messages(events(spark, SF), dirty=True).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("bound", [None, 1 << 53])
def test_the_quarter_hour_job_shuffles_once_and_never_sorts(messages, bound):
    rows = quarter_hour_rows(messages, JobOptions(arrival_bound=bound))
    assert operators(rows, "Exchange") == 1
    assert operators(rows, "HashAggregate") == 2
    assert operators(rows, "SortAggregate") == operators(rows, "Sort") == 0
    assert "Python" not in plan(rows)


def test_the_unused_source_partition_is_not_read(messages):
    bounded = quarter_hour_rows(messages, JobOptions(arrival_bound=1 << 53))
    assert "ReadSchema: struct<raw:string,seq:bigint>" in plan(bounded)


def test_typed_readings_read_only_what_they_need(spark):
    text = plan(registered.time_neat_clean(spark, SF))
    assert "props" not in text


@pytest.mark.parametrize("job", [hourly_rows, flat_rows])
def test_raw_jobs_do_not_shuffle(messages, job):
    assert operators(job(messages), "Exchange") == 0


def test_each_text_is_parsed_once(messages):
    for job in (quarter_hour_rows, hourly_rows, flat_rows):
        text = plan(job(messages))
        assert text.count("Generate json_tuple") == 1 and "from_json" not in text


def test_the_table_time_is_worked_out_once(messages):
    assert plan(hourly_rows(messages)).count("RLIKE(") == 1


def test_times_are_worked_out_once_per_scan(late_messages):
    """A null check derived for a join key would repeat the pattern match, a second summary the scan."""
    late = late_readings(with_event_time(readings(late_messages)))
    late.collect()
    final = plan(late).split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final
    assert final.count("RLIKE(sampletime") == final.count("Generate json_tuple") == 2, "summary and rows"


def test_the_audit_never_sorts_readings(spark, messages):
    stamped = with_event_time(readings(messages))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        text = plan(late_readings(stamped))
    assert "CartesianProduct" not in text and "NestedLoop" not in text
    assert text.count("ShuffledHashJoin") >= 1
    join = text[text.index("ShuffledHashJoin"):]
    assert not re.match(r"ShuffledHashJoin[^\n]*\n[^\n]*Sort ", join), "the readings come from their exchange"
    for window in re.finditer(r"Window \[", text):
        assert "HashAggregate" in text[window.start():], "windows run over the summary"


def _shuffled_records(frame):
    """Records that crossed the first exchange of a plan without adaptive execution."""
    frame.collect()
    stack = [frame._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        if node.nodeName() == "Exchange":
            return node.metrics().get("shuffleRecordsWritten").get().value()
        children = node.children()
        stack.extend(children.apply(i) for i in range(children.size()))


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    with settings(spark, {"spark.sql.adaptive.enabled": "false"}):
        hot = spark.range(0, 300000, 1, 6).select(
            F.col("id").alias("seq"),
            F.lit("hot").alias("measurepointid"),
            F.lit("t").alias("measuretag"),
            F.col("id").cast("double").alias("value"),
            F.lit("").alias("sampletime"),
        )
        newest = newest_per_window(in_windows(with_event_time(hot)))
        assert _shuffled_records(newest) == 6, "one row per task"
        assert newest.head().value == 0.0


def _skewed(spark, rows=400000):
    """Two thirds of the readings in one source partition and hour, the sentinel's among them."""
    second = F.when(F.col("id") % 3 == 0, F.col("id") % 86400).otherwise(F.lit(7200) + F.col("id") % 600)
    text = F.date_format(F.timestamp_seconds(second + 1704067200), "yyyy-MM-dd HH:mm:ss")
    return spark.range(0, rows, 1, 8).select(
        F.col("id").alias("seq"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 7).otherwise(1).cast("int").alias("source_partition"),
        F.xxhash64("id").cast("string").alias("measurepointid"),
        F.lit("t").alias("measuretag"),
        F.col("id").cast("double").alias("value"),
        text.alias("sampletime"),
    )


def test_a_hot_hour_is_written_by_several_tasks(spark):
    rows = table_columns(with_hour(with_event_time(_skewed(spark)), "event_time"), "dt", "hr")
    path = new_folder(spark, "hot-hour")
    with settings(spark, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB"}):
        append_files(rows, path, ("dt", "hr"))
    back = read_files(spark, path, ("dt", "hr"))
    files = {r.hr: r.n for r in back.groupBy("hr").agg(F.countDistinct("_metadata.file_path").alias("n")).collect()}
    assert files["02"] > 4
    assert len(files) == 24 and sum(files.values()) < 8 * 24 / 2, "far fewer than one per task and hour"
    assert back.count() == 400000


def test_a_hot_window_is_split_in_the_joins(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "512KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    stamped = with_event_time(_skewed(spark)).cache()
    with settings(spark, small):
        late, kept = late_readings(stamped), on_time_readings(stamped)
        numbers = len(late.collect()), len(kept.collect())
        assert "ShuffledHashJoin(skew=true)" in plan(late)
        assert "ShuffledHashJoin(skew=true)" in plan(kept)
    stamped.unpersist()
    assert min(numbers) > 0 and sum(numbers) == 400000
