"""Readings dropped by the state of a stream, found again from the log of its checkpoint."""

import json

import pytest
from pyspark.sql import functions as F

from quarterbell import JobOptions
from quarterbell.operators import in_windows, with_event_time
from quarterbell.plans import quarter_hour_rows
from quarterbell.session import new_folder
from quarterbell.sinks import read_files
from quarterbell.sources import read_groups, read_messages
from quarterbell.sources.messages import exact_range, kafka_options
from quarterbell.streaming import LateRows, collect_late, dropped_late, finished_batches, late_rows, start_job
from quarterbell.streaming.late import FinishedBatch, _topic_range, batch_messages
from tests.test_streaming import ONE_FILE, RAW, archive, message, write_batch


def run_job(spark, messages, folder, options=ONE_FILE):
    main, side = start_job("quarter_hour", messages, folder, options, available_now=True)
    main.awaitTermination()
    side.awaitTermination()
    return main


def small_batches(spark, path):
    """The five-batch input of FIXTURES section 6; the last batch has no data."""
    day, seq = "2024-01-01 ", 0
    for batch in [
        [("a", 1, "00:01:00"), ("a", 2, "00:14:00"), ("a", 3, "00:14:00"), ("bad", 9, None)],
        [("a", 4, "00:17:00")],
        [("a", 5, "00:14:59"), ("bad", 8, None), ("a", 6, "00:20:00")],
        [("z", 0, "02:00:00")],
    ]:
        rows = []
        for key, value, time in batch:
            rows.append((message(key, value, day + time if time else ""), 0, seq))
            seq += 1
        write_batch(spark, path, rows)


def test_the_reading_dropped_from_the_five_batches_is_kept(spark):
    path, folder = new_folder(spark, "late in ä"), new_folder(spark, "late-job")
    small_batches(spark, path)
    run_job(spark, read_messages(spark, "parquet", ONE_FILE, path), folder)
    assert collect_late(spark, "parquet", folder, ONE_FILE) == ([0, 1, 2, 3, 4], 0)
    found = [(r.measurepointid, r.value, r.sampletime, int(r.seq), r.batch) for r in late_rows(spark, folder).collect()]
    assert found == [("bad", 8.0, "", 6, 2)]
    assert collect_late(spark, "parquet", folder, ONE_FILE) == ([], 0), "batches are read once"
    assert late_rows(spark, folder).count() == 1


def test_what_was_dropped_and_what_was_kept_make_the_whole(spark):
    """The rows of the stream are those of a batch without the late readings, up to open windows."""
    path, folder = archive(spark, dirty=True, files=6), new_folder(spark, "late-whole")
    query = run_job(spark, read_messages(spark, "parquet", ONE_FILE, path), folder)
    counted = LateRows(query)
    assert counted.poll() > 0
    read, lost = collect_late(spark, "parquet", folder, ONE_FILE, counted.by_batch)
    assert lost == 0 and read == [b for b, n in sorted(counted.by_batch.items()) if n], "batches that dropped nothing are not read"
    late = late_rows(spark, folder)
    # rows reach the state after the map-side reduction
    windows = in_windows(with_event_time(late)).select("batch", "measurepointid", "measuretag", "window").distinct()
    assert windows.count() == dropped_late(query)
    kept = spark.read.schema(RAW).parquet(path).join(late.select(F.col("seq").cast("long").alias("seq")), "seq", "left_anti")
    batch, streamed = quarter_hour_rows(kept, ONE_FILE), read_files(spark, f"{folder}/rows", ("daytime",))
    assert streamed.exceptAll(batch).count() == 0 and 0 < batch.exceptAll(streamed).count() < 5


def test_steps_between_runs_add_up(spark):
    whole, path = archive(spark, dirty=True, files=6), new_folder(spark, "late-parts")
    at_once, folder = new_folder(spark, "late-at-once"), new_folder(spark, "late-steps")
    run_job(spark, read_messages(spark, "parquet", ONE_FILE, whole), at_once)
    collect_late(spark, "parquet", at_once, ONE_FILE)
    rows = spark.read.schema(RAW).parquet(whole).orderBy("seq").collect()
    size, steps = -(-len(rows) // 6), []
    for start in range(0, len(rows), size):
        write_batch(spark, path, rows[start:start + size])
        run_job(spark, read_messages(spark, "parquet", ONE_FILE, path), folder)
        steps += collect_late(spark, "parquet", folder, ONE_FILE)[0]
    assert steps == sorted(set(steps))
    # each run ends with a batch without data, after which the watermark is the newest: nothing less is dropped
    straight, stepped = (late_rows(spark, f).select("seq") for f in (at_once, folder))
    assert straight.exceptAll(stepped).count() == 0 and stepped.count() == stepped.distinct().count()
    dropped = {int(r.seq) for r in stepped.collect()}
    kept = [r for r in rows if r.seq not in dropped]
    batch, streamed = quarter_hour_rows(spark.createDataFrame(kept, RAW), ONE_FILE), read_files(spark, f"{folder}/rows", ("daytime",))
    assert streamed.exceptAll(batch).count() == 0 and batch.exceptAll(streamed).count() < 5


def test_each_group_of_sources_is_read_again(spark):
    paths, folder = [new_folder(spark, "late-g0"), new_folder(spark, "late-g1")], new_folder(spark, "late-groups")
    day = "2024-01-01 "
    for path, times in zip(paths, (["10:00:00", "12:00:00", "09:00:00"], ["10:30:00", "13:00:00", "12:30:00"])):
        for at, time in enumerate(times):
            write_batch(spark, path, [(message(path[-4:], at, day + time), 0, at)])
    query = run_job(spark, read_groups(spark, "parquet", ONE_FILE, paths), folder)
    collect_late(spark, "parquet", folder, ONE_FILE)
    found = [(r.measurepointid, r.sampletime, r.batch) for r in late_rows(spark, folder).collect()]
    assert found == [(paths[0][-4:], day + "09:00:00", 2)] and dropped_late(query) == 1


def test_batches_that_left_the_log_are_counted_as_lost(spark):
    kept = spark.conf.get("spark.sql.streaming.minBatchesToRetain")
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
    try:
        path, folder = archive(spark, dirty=True, files=8), new_folder(spark, "late-lost")
        run_job(spark, read_messages(spark, "parquet", ONE_FILE, path), folder)
    finally:
        spark.conf.set("spark.sql.streaming.minBatchesToRetain", kept)
    found, lost = finished_batches(spark, f"{folder}/checkpoints/rows", -1)
    assert lost > 0 and lost + len(found) == found[-1].number + 1
    read, again = collect_late(spark, "parquet", folder, ONE_FILE)
    assert (read, again) == ([b.number for b in found], lost)
    assert collect_late(spark, "parquet", folder, ONE_FILE) == ([], 0)


def test_a_log_of_files_is_read_across_its_compact_entries(spark):
    """Every third entry of the source's log is compact here, and some single ones are taken away as Spark does later."""
    import os

    name = "spark.sql.streaming.fileSource.log.compactInterval"
    spark.conf.set(name, "3")
    try:
        path, folder = archive(spark, dirty=True, files=7), new_folder(spark, "late-compact")
        run_job(spark, read_messages(spark, "parquet", ONE_FILE, path), folder)
    finally:
        spark.conf.unset(name)
    checkpoint = f"{folder}/checkpoints/rows"
    log = f"{checkpoint}/sources/0"
    assert any(n.endswith(".compact") for n in os.listdir(log))
    os.remove(f"{log}/0")
    os.remove(f"{log}/1")
    found, _ = finished_batches(spark, checkpoint, -1)
    seen = []
    for batch in found:
        for messages in batch_messages(spark, "parquet", ONE_FILE, checkpoint, batch):
            seen.append(sorted(r.seq for r in messages.collect()))
    assert len(seen) == 7 and sorted(s for part in seen for s in part) == list(range(1000))


def test_a_stream_that_has_read_nothing_has_no_late_rows(spark):
    folder = new_folder(spark, "late-none")
    assert collect_late(spark, "parquet", folder, ONE_FILE) == ([], 0)
    assert late_rows(spark, folder).count() == 0


def test_a_batch_of_a_topic_is_read_between_its_offsets():
    options = JobOptions(bootstrap_servers="b:9092", topic="t", until_millis=5)
    after, upto = '{"t":{"0":10,"1":7}}', '{"t":{"0":12,"1":7,"2":4}}'
    start, end = _topic_range(options, after, upto)
    assert json.loads(start) == {"t": {"0": 10, "1": 7, "2": -2}} and json.loads(end) == json.loads(upto)
    given = exact_range(kafka_options(JobOptions(bootstrap_servers="b:9092", topic="t", start=start), False), end)
    assert json.loads(given["assign"]) == {"t": [0, 1, 2]} and "subscribe" not in given and "endingTimestamp" not in given
    assert (given["startingOffsets"], given["endingOffsets"]) == (start, end)
    first, _ = _topic_range(JobOptions(start='{"t":{"0":3}}'), None, upto)
    assert json.loads(first) == {"t": {"0": 3, "1": -2, "2": -2}}
    nothing = FinishedBatch(4, 0, (after,), (after,))
    assert batch_messages(None, "kafka", options, "", nothing) == []


def test_only_a_stream_with_state_keeps_late_rows():
    from quarterbell.__main__ import arguments

    assert arguments(["quarter_hour", "--folder", "f", "--keep-late"]).keep_late
    for wrong in (["hourly", "--folder", "f", "--keep-late"], ["quarter_hour", "--folder", "f", "--keep-late", "--replay"]):
        with pytest.raises(SystemExit):
            arguments(wrong)


def test_the_command_line_keeps_late_rows(spark):
    from quarterbell.__main__ import arguments, run

    path, folder = new_folder(spark, "late-cli-in"), new_folder(spark, "late-cli")
    small_batches(spark, path)
    run(spark, arguments(["quarter_hour", "--folder", folder, "--format", "parquet", "--path", path, "--max-files", "1",
                          "--available-now", "--keep-late", "--commit-seconds", "1"]))
    assert [(int(r.seq), r.batch) for r in late_rows(spark, folder).collect()] == [(6, 2)]
