"""The jobs as they are started from the command line."""

import glob

import pytest
from pyspark.sql import functions as F

from checks.bindings import as_messages, events
from quarterbell.__main__ import arguments, run
from quarterbell.plans import JOBS, commit_replay, replay_job
from quarterbell.schema import table_schema
from quarterbell.session import new_folder
from quarterbell.sinks import append_files, read_files
from tests.conftest import hours_due

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def archive(spark):
    path = new_folder(spark, "job-input")
    as_messages(events(spark, SF), dirty=True).coalesce(1).write.parquet(path)
    return path


def start(spark, job, path, *more):
    folder = new_folder(spark, job)
    run(spark, arguments([job, "--format", "parquet", "--path", path, "--folder", folder, "--shuffle-partitions", "4", *more]))
    return folder


@pytest.mark.parametrize("job", sorted(JOBS))
def test_replay_and_stream_agree(spark, archive, job):
    partitions = JOBS[job].partitions
    more = ["--daytime", "event_date", "--bad-time", "quarantine"]
    once = start(spark, job, archive, "--replay", *more)
    live = start(spark, job, archive, "--available-now", *more)
    batch, stream = (read_files(spark, f"{folder}/rows", partitions) for folder in (once, live))
    assert stream.exceptAll(batch).count() == 0
    missing = batch.exceptAll(stream).count()
    assert missing < 5 if JOBS[job].stateful else missing == 0
    rejected = [sorted(r.seq for r in spark.read.parquet(f"{folder}/quarantine").collect()) for folder in (once, live)]
    assert rejected[0] == rejected[1] and rejected[0]


@pytest.mark.parametrize("job, daytime", [("hourly", "run_date"), ("quarter_hour", "event_date")])
def test_a_table_is_made_and_its_partitions_committed(spark, archive, job, daytime):
    table = f"job_{job}"
    folder = start(spark, job, archive, "--available-now", "--daytime", daytime, "--table", table, "--commit-seconds", "5")
    listed = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    rows = read_files(spark, f"{folder}/rows", JOBS[job].partitions)
    assert listed and spark.table(table).count() == rows.count()
    last = rows.agg({JOBS[job].partitions[0]: "max"}).head()[0]
    if job == "hourly":
        assert listed == hours_due(rows)
    else:
        assert f"daytime={last}" in listed, "a day is due as soon as it has begun"


@pytest.mark.parametrize("job", ["flat", "quarter_hour"])
def test_a_replay_may_fill_a_table(spark, archive, job):
    more = ["--replay", "--daytime", "event_date", "--table", f"replayed_{job}"]
    folder = start(spark, job, archive, *more)
    table = spark.table(f"replayed_{job}")
    assert table.count() == read_files(spark, f"{folder}/rows", JOBS[job].partitions).count() > 900
    assert table.schema == table_schema(JOBS[job].partitions)


def test_a_replay_may_be_repeated_and_commits(spark, archive):
    def counts(folder):
        rows = read_files(spark, f"{folder}/rows", JOBS["hourly"].partitions)
        return rows.count(), spark.read.parquet(f"{folder}/quarantine").count()

    messages, folder = spark.read.parquet(archive), new_folder(spark, "repeated")
    replay_job("hourly", messages, folder, table="repeated_hours")
    once = counts(folder)
    broken = messages.withColumn("raw", F.when(F.col("raw").rlike("VALUE"), F.col("raw")).otherwise(F.raise_error(F.lit("lost")).cast("string")))
    with pytest.raises(Exception, match="lost"):
        append_files(broken.select("raw"), f"{folder}/quarantine", mode="overwrite")
    replay_job("hourly", messages, folder, table="repeated_hours")
    assert counts(folder) == once
    commit_replay(spark, "hourly", folder, "repeated_hours")
    listed = spark.sql("SHOW PARTITIONS repeated_hours").count()
    markers = glob.glob(f"{folder.removeprefix('file:')}/rows/dt=*/hr=*/_SUCCESS")
    assert listed == len(markers) > 0


def test_the_folder_of_a_stream_is_not_replayed_into(spark, archive):
    folder = start(spark, "flat", archive, "--available-now")
    with pytest.raises(ValueError, match="belongs to a stream"):
        start_replay(spark, archive, folder)


def start_replay(spark, path, folder):
    run(spark, arguments(["flat", "--format", "parquet", "--path", path, "--folder", folder, "--replay"]))


def test_modes_exclude_each_other():
    with pytest.raises(SystemExit):
        arguments(["flat", "--folder", "x", "--replay", "--available-now"])
