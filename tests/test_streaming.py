import json

import pytest
from pyspark.sql import functions as F

from checks.bindings import as_messages, events
from quarterbell import JobOptions
from quarterbell.operators import late_readings, readings, table_rows, with_event_time, with_watermark
from quarterbell.plans import flat_rows, hourly_rows, hourly_rows_sql, quarter_hour_rows
from quarterbell.session import new_folder
from quarterbell.sinks import commit_pending, create_table, read_files
from quarterbell.sources import read_messages
from quarterbell.streaming import (
    LateRows,
    append_stream,
    commit_while_running,
    dropped_late,
    preview_stream,
    start_job,
    watermark_of,
)
from tests.conftest import hours_due

SF = "/root/testdata/sf0.001"
ONE_FILE = JobOptions(max_files_per_trigger=1, daytime="event_date")
RAW = "raw STRING, source_partition INT, seq BIGINT"


def message(key, value, time):
    return json.dumps({"MEASUREPOINTID": key, "MEASURETAG": "t", "VALUE": value, "SAMPLETIME": time})


def write_batch(spark, path, rows):
    """One file, which the stream reads as one micro-batch."""
    spark.createDataFrame(rows, RAW).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, folder, rows=quarter_hour_rows, options=ONE_FILE, partitions=("daytime",)):
    messages = read_messages(spark, "parquet", options, path)
    query = append_stream(rows(messages, options), f"{folder}/rows", f"{folder}/checkpoint", partitions, available_now=True)
    query.awaitTermination()
    return query


def archive(spark, dirty, files=4):
    """The messages in order, one file per micro-batch."""
    path = new_folder(spark, "archive")
    messages = as_messages(events(spark, SF), dirty).orderBy("seq").collect()
    size = -(-len(messages) // files)
    for start in range(0, len(messages), size):
        write_batch(spark, path, messages[start:start + size])
    return path


def test_late_data_stream(spark):
    """Each batch is run on its own, so that the watermark moves between them."""
    path, folder = new_folder(spark, "late-in"), new_folder(spark, "late-out")
    day = "2024-01-01 "
    batches = [
        [("a", 1, "00:01:00"), ("a", 2, "00:14:00"), ("a", 3, "00:14:00"), ("bad", 9, None)],
        [("a", 4, "00:17:00")],
        [("a", 5, "00:14:59"), ("bad", 8, None), ("a", 6, "00:20:00")],
        [("z", 0, "02:00:00")],
    ]
    seq = 0
    for batch in batches:
        rows = []
        for key, value, time in batch:
            rows.append((message(key, value, day + time if time else ""), 0, seq))
            seq += 1
        write_batch(spark, path, rows)
    query = run(spark, path, folder)
    found = sorted((r.measurepointid, float(r.value1), r.sampletime) for r in read_files(spark, f"{folder}/rows", ("daytime",)).collect())
    assert found == [
        ("a", 5.0, day + "00:15:00"),
        ("a", 6.0, day + "00:15:00"),
        ("bad", 9.0, "1970-01-01 16:00:00"),
    ], "the window of z stays open"
    assert dropped_late(query) == 1


def test_a_stream_equals_the_batch_up_to_open_windows(spark):
    path, folder = archive(spark, dirty=False), new_folder(spark, "parity")
    query = run(spark, path, folder)
    assert len([p for p in query.recentProgress if p.numInputRows]) == 4
    batch = quarter_hour_rows(read_messages(spark, "parquet", ONE_FILE, path, streaming=False), ONE_FILE)
    streamed = read_files(spark, f"{folder}/rows", ("daytime",))
    missing = batch.exceptAll(streamed).collect()
    assert streamed.exceptAll(batch).count() == 0
    assert 0 < len(missing) < 5
    assert dropped_late(query) == 0


def test_a_restart_neither_loses_nor_repeats(spark):
    whole = archive(spark, dirty=False)
    messages = spark.read.schema(RAW).parquet(whole).orderBy("seq").collect()
    path, folder = new_folder(spark, "halves"), new_folder(spark, "restart")
    write_batch(spark, path, messages[:500])
    run(spark, path, folder)
    first = read_files(spark, f"{folder}/rows", ("daytime",)).count()
    run(spark, path, folder)
    assert read_files(spark, f"{folder}/rows", ("daytime",)).count() == first
    write_batch(spark, path, messages[500:])
    run(spark, path, folder)
    once = new_folder(spark, "once")
    run(spark, whole, once)
    again = read_files(spark, f"{folder}/rows", ("daytime",))
    straight = read_files(spark, f"{once}/rows", ("daytime",))
    assert again.exceptAll(straight).count() == 0 and straight.exceptAll(again).count() == 0
    assert again.count() > first


def test_a_crash_in_mid_batch_neither_loses_nor_repeats(spark):
    """Some tasks of the second batch write their file, one fails for good; the next run redoes the batch."""
    path, folder = archive(spark, dirty=False, files=2), new_folder(spark, "crash")

    def failing(messages, options):
        lost = F.when(F.col("seq") == 700, F.raise_error(F.lit("task lost")).cast("string"))
        return flat_rows(messages.repartition(4, "seq").withColumn("raw", lost.otherwise(F.col("raw"))))

    with pytest.raises(Exception, match="task lost"):
        run(spark, path, folder, failing, partitions=())
    assert read_files(spark, f"{folder}/rows").count() == 500
    run(spark, path, folder, flat_rows, partitions=())
    batch, streamed = flat_rows(spark.read.schema(RAW).parquet(path)), read_files(spark, f"{folder}/rows")
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0


@pytest.mark.parametrize("name, rows, partitions", [("hourly", hourly_rows, ("dt", "hr")), ("flat", flat_rows, ())])
def test_stateless_jobs_lose_nothing(spark, name, rows, partitions):
    path, folder = archive(spark, dirty=True, files=2), new_folder(spark, name)
    messages = read_messages(spark, "parquet", ONE_FILE, path)
    for query in start_job(name, messages, folder, ONE_FILE, available_now=True):
        query.awaitTermination()
    batch = rows(spark.read.schema(RAW).parquet(path))
    streamed = read_files(spark, f"{folder}/rows", partitions)
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() == 0
    rejected = spark.read.parquet(f"{folder}/quarantine")
    assert streamed.count() + rejected.count() == 1000
    assert rejected.groupBy("seq").count().where("count > 1").count() == 0


def test_the_quarter_hour_job_runs_with_its_quarantine(spark):
    path, folder = archive(spark, dirty=True, files=1), new_folder(spark, "quarter-hour")
    for query in start_job("quarter_hour", read_messages(spark, "parquet", ONE_FILE, path), folder, ONE_FILE, available_now=True):
        query.awaitTermination()
    reasons = {r.reason for r in spark.read.parquet(f"{folder}/quarantine").collect()}
    assert reasons == {"malformed", "null_value"}
    assert read_files(spark, f"{folder}/rows", ("daytime",)).count() > 900


def test_a_stream_of_text_lines(spark):
    path, folder = new_folder(spark, "text"), new_folder(spark, "text-out")
    as_messages(events(spark, SF)).select("raw").repartition(3).write.text(path)
    with pytest.raises(ValueError, match="no order of arrival"):
        start_job("quarter_hour", read_messages(spark, "text", JobOptions(), path), folder)
    messages = read_messages(spark, "text", JobOptions(), path, position=F.xxhash64("value"))
    query = append_stream(quarter_hour_rows(messages), f"{folder}/rows", f"{folder}/checkpoint", available_now=True)
    query.awaitTermination()
    assert spark.read.parquet(f"{folder}/rows").count() > 900


def test_the_stream_drops_no_reading_the_audit_calls_on_time(spark):
    """Spark drops late rows one micro-batch later than the strict rule, never earlier."""
    path, folder = archive(spark, dirty=True), new_folder(spark, "audit")
    query = run(spark, path, folder)
    stamped = with_event_time(readings(spark.read.schema(RAW).parquet(path))).withColumn("source_partition", F.lit(0))
    assert 0 < dropped_late(query) <= late_readings(stamped).count()


def test_preview_stops_after_its_rows(spark):
    path = archive(spark, dirty=False, files=2)
    assert preview_stream(read_messages(spark, "parquet", ONE_FILE, path), "first_two").count() == 2


def test_partitions_are_committed_from_the_watermark_of_the_query(spark):
    path, folder = archive(spark, dirty=False, files=2), new_folder(spark, "commit-stream")
    create_table(spark, "streamed_hours", ("dt", "hr"), f"{folder}/rows")
    messages = read_messages(spark, "parquet", ONE_FILE, path)
    query = append_stream(
        hourly_rows(messages), f"{folder}/rows", f"{folder}/checkpoint", ("dt", "hr"), table="streamed_hours", available_now=True)
    done = []
    commit_while_running(query, lambda watermark: done.extend(commit_pending(
        spark, "streamed_hours", f"{folder}/rows", f"{folder}/ledger", watermark)), "3 minutes")
    newest = read_files(spark, f"{folder}/rows", ("dt", "hr")).agg(F.max("sampletime")).head()[0]
    behind = spark.range(1).select(
        F.unix_seconds(F.lit(newest + "Z").cast("timestamp")) - F.unix_seconds(watermark_of(query, "3 minutes"))).head()[0]
    assert behind == 180
    listed = {r.partition for r in spark.sql("SHOW PARTITIONS streamed_hours").collect()}
    assert listed == {f"dt={r.dt}/hr={r.hr}" for r in done}
    assert listed == hours_due(read_files(spark, f"{folder}/rows", ("dt", "hr")))


def test_state_is_kept_in_rocksdb(spark):
    path, folder = archive(spark, dirty=False, files=1), new_folder(spark, "rocks")
    query = run(spark, path, folder)
    metrics = [op.customMetrics for p in query.recentProgress for op in p.stateOperators]
    assert any("rocksdbPutCount" in m for m in metrics)


def test_a_failure_of_the_quarantine_ends_the_job(spark):
    path, folder = archive(spark, dirty=False, files=1), new_folder(spark, "failure")
    messages = read_messages(spark, "parquet", ONE_FILE, path)
    main = append_stream(flat_rows(messages), f"{folder}/rows", f"{folder}/c1", interval="1 second")
    broken = messages.select(F.raise_error(F.lit("broken")).cast("string").alias("raw"))
    side = append_stream(broken, f"{folder}/quarantine", f"{folder}/c2", interval="1 second")
    with pytest.raises(Exception, match="broken"):
        commit_while_running(main, lambda watermark: [], "2 minutes", 2, side)
    assert not main.isActive


def test_the_count_of_late_rows_outlives_the_reports_of_the_query(spark):
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    path, folder = archive(spark, dirty=True, files=6), new_folder(spark, "reports")
    whole = dropped_late(run(spark, path, new_folder(spark, "all-reports")))
    assert whole > 0

    class Reports:
        """A query seen at moments when it keeps two reports each."""

        def __init__(self, query):
            self.reports, self.at = query.recentProgress, 0

        @property
        def recentProgress(self):
            return self.reports[max(0, self.at - 2):self.at]

    seen = LateRows(Reports(run(spark, path, folder)))
    for at in range(1, len(seen.query.reports) + 1):
        seen.query.at = at
        seen.poll()
        seen.poll()
    assert (seen.total, seen.complete) == (whole, True)
    gap = LateRows(seen.query)
    gap.query.at = 1
    gap.poll()
    gap.query.at = len(seen.query.reports)
    gap.poll()
    assert not gap.complete
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        with pytest.raises(RuntimeError, match="only the newest"):
            dropped_late(run(spark, path, new_folder(spark, "few-reports")))
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)


def test_a_micro_batch_of_the_stateful_job_writes_few_files(spark):
    path, folder = archive(spark, dirty=False, files=1), new_folder(spark, "few-files")
    options = JobOptions(max_files_per_trigger=1, files_per_batch=2)
    for query in start_job("quarter_hour", read_messages(spark, "parquet", options, path), folder, options, available_now=True):
        query.awaitTermination()
    rows = read_files(spark, f"{folder}/rows", ("daytime",))
    assert rows.select("_metadata.file_path").distinct().count() <= 2 and rows.count() > 900


def test_a_stream_in_sql_commits_from_its_watermark(spark):
    path, folder = archive(spark, dirty=False, files=2), new_folder(spark, "sql-stream")
    create_table(spark, "sql_hours", ("dt", "hr"), f"{folder}/rows")
    rows = hourly_rows_sql(read_messages(spark, "parquet", ONE_FILE, path), "sql_source")
    query = append_stream(rows, f"{folder}/rows", f"{folder}/checkpoint", ("dt", "hr"), table="sql_hours", available_now=True)
    commit_while_running(query, lambda watermark: commit_pending(
        spark, "sql_hours", f"{folder}/rows", f"{folder}/ledger", watermark), "3 minutes")
    listed = {r.partition for r in spark.sql("SHOW PARTITIONS sql_hours").collect()}
    assert listed and listed == hours_due(read_files(spark, f"{folder}/rows", ("dt", "hr")))


def test_a_commit_that_fails_is_tried_again_and_at_last_given_up(spark):
    def started(name):
        path, folder = archive(spark, dirty=False, files=1), new_folder(spark, name)
        messages = with_watermark(table_rows(read_messages(spark, "parquet", ONE_FILE, path)), "3 minutes", "ts")
        return append_stream(messages.drop("ts"), f"{folder}/rows", f"{folder}/c", interval="1 second")

    calls = []

    def twice(watermark):
        calls.append(watermark)
        if len(calls) < 3:
            raise OSError("hiccup")
        query.stop()

    query = started("retry")
    commit_while_running(query, twice, "3 minutes", 2)
    assert len(calls) >= 3

    def never(watermark):
        raise OSError("gone")

    query = started("give-up")
    with pytest.raises(OSError, match="gone"):
        commit_while_running(query, never, "3 minutes", 1, attempts=2)
    assert not query.isActive
