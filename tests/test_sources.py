import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quarterbell import JobOptions
from quarterbell.operators import readings
from quarterbell.plans import quarter_hour_rows
from quarterbell.sources import kafka_options, read_messages, spark_consumer_options


def test_consumer_properties_become_source_options():
    consumer = {
        "bootstrap.servers": "one:6667,two:6667",
        "group.id": "g",
        "auto.offset.reset": "latest",
        "partition.assignment.strategy": "some.Assignor",
        "key.deserializer": "some.Deserializer",
        "value.deserializer": "some.Deserializer",
        "security.protocol": "SASL_SSL",
    }
    assert spark_consumer_options(consumer) == {
        "kafka.bootstrap.servers": "one:6667,two:6667",
        "kafka.group.id": "g",
        "kafka.security.protocol": "SASL_SSL",
        "startingOffsets": "latest",
    }


@pytest.mark.parametrize("start, streaming, expected", [
    ("earliest", True, "earliest"),
    ("latest", True, "latest"),
    ("group-offsets", True, "earliest"),
    ("earliest", False, "earliest"),
])
def test_start_position(start, streaming, expected):
    options = kafka_options(JobOptions(bootstrap_servers="h:1", start=start), streaming)
    assert options["startingOffsets"] == expected
    assert ("endingOffsets" in options) is not streaming


def test_a_batch_has_one_end_and_does_not_start_at_it():
    options = JobOptions(bootstrap_servers="h:1", start="latest")
    with pytest.raises(ValueError, match="reads nothing"):
        kafka_options(options, streaming=False)
    ended = kafka_options(JobOptions(bootstrap_servers="h:1", until_millis=17), streaming=False)
    assert ended["endingTimestamp"] == "17" and "endingOffsets" not in ended


def test_limits_and_topic():
    options = kafka_options(JobOptions(
        topic="t", bootstrap_servers="h:1", group_id="g", max_offsets_per_trigger=5, min_partitions=7,
        max_records_per_task=9))
    assert options["maxRecordsPerPartition"] == "9"
    assert options["subscribe"] == "t" and options["kafka.group.id"] == "g"
    assert options["maxOffsetsPerTrigger"] == "5" and options["minPartitions"] == "7"
    assert "maxOffsetsPerTrigger" not in kafka_options(
        JobOptions(bootstrap_servers="h:1", max_offsets_per_trigger=5), streaming=False)


def test_a_topic_needs_servers(spark):
    with pytest.raises(ValueError):
        kafka_options(JobOptions())


def test_kafka_goes_to_the_connector(spark):
    """The connector is a separate package; without it Spark itself says so."""
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        read_messages(spark, "kafka", JobOptions(bootstrap_servers="h:1"), streaming=False)


def test_unknown_formats_and_missing_paths_are_refused(spark):
    with pytest.raises(ValueError):
        read_messages(spark, "csv", JobOptions(), "/tmp/x")
    with pytest.raises(ValueError):
        read_messages(spark, "text", JobOptions())
    with pytest.raises(ValueError):
        JobOptions(daytime="never")
    with pytest.raises(ValueError):
        JobOptions(bad_time="drop")


@pytest.fixture
def lines(tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    for name in ("a", "b"):
        records = [json.dumps({"MEASUREPOINTID": name, "VALUE": at, "SAMPLETIME": "2024-01-01 00:00:00", "SEQ": at}) for at in range(3000)]
        (folder / f"{name}.json").write_text("\n".join(records) + "\n")
    return str(folder)


def test_lines_of_a_batch_are_numbered_in_file_order_across_splits(spark, lines):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16KB")
    try:
        rows = readings(read_messages(spark, "text", JobOptions(), lines, streaming=False))
        assert rows.rdd.getNumPartitions() > 4
        for name in ("a", "b"):
            ordered = rows.where(F.col("measurepointid") == name).orderBy("seq").collect()
            assert [r.value for r in ordered] == [float(at) for at in range(3000)]
            assert len({r.source_partition for r in ordered}) == 1
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_a_position_may_come_from_the_text(spark, lines):
    position = F.get_json_object("value", "$.SEQ").cast("bigint")
    rows = readings(read_messages(spark, "json", JobOptions(), lines, streaming=False, position=position)).collect()
    assert len(rows) == 6000 and all(r.seq == r.value for r in rows)


def test_files_of_one_stream_are_numbered_through(spark, lines):
    rows = read_messages(spark, "text", JobOptions(), lines, streaming=False, stream=F.lit(7))
    ordered = rows.orderBy("seq").collect()
    assert {r.source_partition for r in ordered} == {7} and len({r.seq for r in ordered}) == 6000
    assert [json.loads(r.raw)["MEASUREPOINTID"] for r in ordered] == ["a"] * 3000 + ["b"] * 3000


def test_late_readings_of_files_need_their_stream(spark, lines):
    late = JobOptions(drop_late=True)
    with pytest.raises(ValueError, match="stream"):
        quarter_hour_rows(read_messages(spark, "text", JobOptions(), lines, streaming=False), late)
    assert quarter_hour_rows(read_messages(spark, "text", JobOptions(), lines, streaming=False, stream=F.lit(7)), late).count() == 2
