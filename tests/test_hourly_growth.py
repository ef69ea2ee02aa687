"""What the hourly queries write and read must not grow with the tasks, nor depend on how the table's file is cut."""

import glob

import pytest
from pyspark.sql import functions as F

from checks import queries
from quarterbell.session import new_folder

HOURS = 3


@pytest.fixture
def tables(spark):
    """Events in one file of one part, each fourth of which has all hours."""
    path = new_folder(spark, "growth-input")
    at = F.lit(1704070800) + (F.col("id") % HOURS) * 3600 + 2700
    spark.range(0, 900, 1, 1).select(
        F.col("id").alias("event_id"),
        F.timestamp_seconds(at).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.col("id").cast("double").alias("value"),
        F.lit("{}").alias("props"),
    ).write.parquet(f"{path}/events.parquet")
    return path


def test_a_micro_batch_writes_one_file_for_each_hour(spark, tables, monkeypatch):
    made = []
    monkeypatch.setattr(queries, "new_folder", lambda *given: made.append(new_folder(*given)) or made[-1])
    rows = queries.published_hours(spark, tables)
    # of 900 events those are left out that have no time (ids by 97, 101) or are cut off (107)
    assert rows.count() == sum(all(n % rule for rule in (97, 101)) and (n % 103 == 0 or n % 107 > 0) for n in range(900))
    written = glob.glob(f"{made[0].removeprefix('file:')}/rows/dt=*/hr=*/*.parquet")
    assert HOURS <= len({f.rsplit("/", 2)[1] for f in written}) <= HOURS + 1
    assert 4 * HOURS == len(written)


def test_replays_read_messages_in_many_tasks_and_make_them_once(spark, tables, monkeypatch):
    seen = []
    monkeypatch.setattr(queries, "replay_job", lambda job, messages, *rest, **given: seen.append(messages))
    queries._replayed_runs(spark, tables, "hourly")
    tasks = [m.select(F.spark_partition_id().alias("task")).distinct().count() for m in seen]
    assert len(tasks) == 3 and min(tasks) > 1, "the file of the table has one part"
    assert not any("to_json" in m._jdf.queryExecution().executedPlan().toString() for m in seen)
    assert sum(m.count() for m in seen[:2]) == 900
