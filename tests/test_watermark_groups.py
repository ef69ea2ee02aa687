"""Several groups of sources, each with its own watermark; the least of them decides."""

import json

import pytest
from pyspark.sql import functions as F

from quarterbell import JobOptions
from quarterbell.__main__ import arguments
from quarterbell.plans import flat_rows, hourly_quarantine, hourly_rows, quarter_hour_rows
from quarterbell.session import new_folder
from quarterbell.sources import kafka_options, read_groups, read_messages
from quarterbell.streaming import append_stream, commit_while_running, dropped_late, start_job
from quarterbell.sinks import read_files

ONE_FILE = JobOptions(max_files_per_trigger=1, run_millis=1704067200000)


def write(spark, folder, minutes, key, first=0):
    """One file for each list of minutes of 2024-01-01, in the order given."""
    for at, part in enumerate(minutes):
        rows = [
            (json.dumps({"MEASUREPOINTID": key, "MEASURETAG": "t", "VALUE": float(m), "SAMPLETIME": f"2024-01-01 {m // 60:02d}:{m % 60:02d}:00"}), 0, first + 1000 * at + i)
            for i, m in enumerate(part)]
        spark.createDataFrame(rows, "raw STRING, source_partition INT, seq BIGINT").coalesce(1).write.mode("append").parquet(folder)


@pytest.fixture
def folders(spark):
    """A fast group, and one whose readings lag an hour and more behind it."""
    root = new_folder(spark, "groups")
    write(spark, f"{root}/fast", [range(0, 300, 5), [300], [301], [302]], "fast")
    write(spark, f"{root}/slow", [range(0, 60, 5), range(60, 120, 5), range(120, 180, 5), range(180, 240, 5)], "slow", first=10**6)
    return root


def run(spark, messages, folder):
    query = append_stream(quarter_hour_rows(messages, ONE_FILE), f"{folder}/rows", f"{folder}/checkpoint", ("daytime",), available_now=True)
    query.awaitTermination()
    return query


def test_a_group_that_lags_loses_nothing(spark, folders):
    out = new_folder(spark, "grouped")
    query = run(spark, read_groups(spark, "parquet", ONE_FILE, [f"{folders}/fast", f"{folders}/slow"]), out)
    assert dropped_late(query) == 0
    got = {(r.measurepointid, r.value1, r.sampletime) for r in read_files(spark, f"{out}/rows", ("daytime",)).collect()}
    both = spark.read.schema("raw STRING, source_partition INT, seq BIGINT").parquet(f"{folders}/fast", f"{folders}/slow")
    batch = {(r.measurepointid, r.value1, r.sampletime) for r in quarter_hour_rows(both, ONE_FILE).collect()}
    # the least watermark is 03:55 less two minutes: windows that end by 03:45 are out, of both groups
    assert got == {r for r in batch if r[1] < 225}
    assert {r[0] for r in got} == {"fast", "slow"}


def test_with_one_watermark_the_same_group_loses_readings(spark, folders):
    out, joined = new_folder(spark, "one-watermark"), new_folder(spark, "joined")
    # the same files in the same order, as one source
    write(spark, joined, [range(0, 300, 5)], "fast")
    write(spark, joined, [range(0, 60, 5), range(60, 120, 5), range(120, 180, 5)], "slow", first=10**6)
    query = run(spark, read_messages(spark, "parquet", ONE_FILE, joined), out)
    assert dropped_late(query) > 0


def test_a_group_without_readings_holds_the_watermark_back(spark, folders):
    out = new_folder(spark, "idle")
    idle = new_folder(spark, "idle-source")
    write(spark, idle, [[]], "none")
    query = run(spark, read_groups(spark, "parquet", ONE_FILE, [f"{folders}/fast", idle]), out)
    assert dropped_late(query) == 0 and read_files(spark, f"{out}/rows", ("daytime",)).count() == 0


def test_partitions_are_due_by_the_slowest_group(spark, folders):
    out, seen = new_folder(spark, "due"), []
    groups = read_groups(spark, "parquet", ONE_FILE, [f"{folders}/fast", f"{folders}/slow"])
    main, side = start_job("hourly", groups, out, ONE_FILE, available_now=True)
    commit_while_running(main, lambda w: seen.append(spark.range(1).select(F.date_format(F.to_utc_timestamp(w, "UTC"), "HH:mm")).head()[0]), "3 minutes", 1, side, groups=2)
    side.awaitTermination()
    assert seen and max(seen) <= "03:52" and seen == sorted(seen)
    assert read_files(spark, f"{out}/rows", ("dt", "hr")).count() == 63 + 48


def test_jobs_over_groups_are_those_over_all_messages(spark, folders):
    paths = [f"{folders}/fast", f"{folders}/slow"]
    groups = read_groups(spark, "parquet", JobOptions(), paths, streaming=False)
    both = spark.read.schema("raw STRING, source_partition INT, seq BIGINT").parquet(*paths)
    for rows in (hourly_rows, flat_rows, hourly_quarantine):
        assert rows(groups).exceptAll(rows(both)).count() == 0 == rows(both).exceptAll(rows(groups)).count()


def test_groups_of_a_topic():
    options = JobOptions(topic="t", bootstrap_servers="h:1", start='{"t":{"0":5,"1":6,"2":7}}')
    found = kafka_options(options, partitions=(0, 2))
    assert json.loads(found["assign"]) == {"t": [0, 2]} and "subscribe" not in found
    assert json.loads(found["startingOffsets"]) == {"t": {"0": 5, "2": 7}}
    assert kafka_options(JobOptions(bootstrap_servers="h:1"), partitions=(1,))["startingOffsets"] == "earliest"


@pytest.mark.parametrize("groups", [(), ((),), ((0, 1), (1, 2))])
def test_groups_must_part_the_partitions(spark, groups):
    with pytest.raises(ValueError, match="each in one of them"):
        read_groups(spark, "kafka", JobOptions(bootstrap_servers="h:1", partition_groups=groups))


def test_groups_on_the_command_line():
    given = arguments(["quarter_hour", "--folder", "x", "--path", "a", "--path", "b", "--partition-groups", "0,1;2"])
    assert given.path == ["a", "b"] and given.partition_groups == "0,1;2"
