"""Commits from the log of the file sink: what they read, and that they miss nothing."""

import pytest
from pyspark.sql import functions as F

from quarterbell.session import new_folder
from quarterbell.sinks import commit, commit_pending, create_table, seen_partitions, written_partitions
from quarterbell.sinks.sinklog import files_since, log_files, newest_batch
from quarterbell.streaming import append_stream

ROWS = "measurepointid STRING, measuretag STRING, value1 DECIMAL(30,8), sampletime STRING, dt STRING, hr STRING"
PARTS = ("dt", "hr")


def stream_hours(spark, source, out, hours):
    """One micro-batch for each list of hours."""
    for some in hours:
        rows = [("a", "t", None, f"2024-01-01 {h:02d}:00:00", "2024-01-01", f"{h:02d}") for h in some]
        spark.createDataFrame(rows, ROWS).coalesce(1).write.mode("append").parquet(source)
        messages = spark.readStream.schema(ROWS).parquet(source)
        append_stream(messages, f"{out}/rows", f"{out}/checkpoint", PARTS, available_now=True).awaitTermination()


def at(text):
    return F.lit(f"{text}Z").cast("timestamp")


@pytest.fixture
def folders(spark):
    root = new_folder(spark, "sinklog")
    return f"{root}/source", f"{root}/out"


def test_a_step_reads_the_batches_since_the_last(spark, folders):
    source, out = folders
    stream_hours(spark, source, out, [[0, 1], [2]])
    files, newest = files_since(spark, f"{out}/rows", -1)
    assert newest == newest_batch(spark, f"{out}/rows") == 1 and files.count() == 3
    files, newest = files_since(spark, f"{out}/rows", 0)
    assert newest == 1 and [r.path.split("/rows/")[1].rsplit("/", 1)[0] for r in files.collect()] == ["dt=2024-01-01/hr=02"]
    assert files_since(spark, f"{out}/rows", 1) == (None, 1)
    assert files_since(spark, f"{out}/nothing", -1) == (None, -1)


def test_compact_files_stand_for_the_batches_before_them(spark, folders):
    source, out = folders
    spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "3")
    spark.conf.set("spark.sql.streaming.fileSink.log.cleanupDelay", "0")
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "1")
    try:
        seen = f"{out}/ledger-seen"
        for upto in range(8):
            stream_hours(spark, source, out, [[upto]])
            if upto in (0, 1, 4, 7):  # also steps that come after several batches, small files of which are gone
                found = {tuple(r) for r in seen_partitions(spark, f"{out}/rows", seen, PARTS).collect()}
                assert found == {tuple(r) for r in written_partitions(spark, f"{out}/rows", PARTS).collect()}
    finally:
        for key in ("fileSink.log.compactInterval", "fileSink.log.cleanupDelay", "minBatchesToRetain"):
            spark.conf.unset(f"spark.sql.streaming.{key}")
    kept = log_files(spark, f"{out}/rows")
    assert any(whole for whole, _ in kept.values()) and 0 not in kept, kept


def test_a_commit_with_nothing_new_lists_no_file(spark, folders, monkeypatch):
    source, out = folders
    create_table(spark, "logged_hours", PARTS, f"{out}/rows")
    stream_hours(spark, source, out, [[0, 1, 2]])

    def step(now):
        return sorted(r.hr for r in commit_pending(spark, "logged_hours", f"{out}/rows", f"{out}/ledger", at(now)))

    def listed(*_):
        raise AssertionError("data files were listed")

    monkeypatch.setattr(commit, "written_partitions", listed)
    assert step("2024-01-01 01:20:00") == ["00", "01"]
    monkeypatch.setattr(commit, "_newest_files", listed)  # nothing new: the log is not read either
    assert step("2024-01-01 01:30:00") == []
    # what was seen but not due is remembered
    assert step("2024-01-01 02:20:00") == ["02"]
    monkeypatch.undo()
    stream_hours(spark, source, out, [[1, 3]])
    assert step("2024-01-01 02:30:00") == ["01"], "newer files are committed again"
    assert step("2024-01-01 03:30:00") == ["03"]
    assert {r.partition for r in spark.sql("SHOW PARTITIONS logged_hours").collect()} == {f"dt=2024-01-01/hr=0{h}" for h in range(4)}


def test_a_step_that_dies_is_done_again(spark, folders, monkeypatch):
    source, out = folders
    create_table(spark, "died_hours", PARTS, f"{out}/rows")
    stream_hours(spark, source, out, [[0], [1]])

    def dies(*_):
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(commit, "carry_out", dies)
        with pytest.raises(OSError, match="lost"):
            commit_pending(spark, "died_hours", f"{out}/rows", f"{out}/ledger", at("2024-01-01 09:00:00"))
    assert len(commit_pending(spark, "died_hours", f"{out}/rows", f"{out}/ledger", at("2024-01-01 09:00:00"))) == 2
    assert commit_pending(spark, "died_hours", f"{out}/rows", f"{out}/ledger", at("2024-01-01 09:00:00")) == []
