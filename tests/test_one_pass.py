"""Rows and quarantine written by one query."""

import pytest
from pyspark.sql import functions as F

from quarterbell import JobOptions
from quarterbell.plans import JOBS, flat_one_pass
from quarterbell.session import new_folder
from quarterbell.sinks import commit_pending, create_table, written_partitions
from quarterbell.sources import read_messages
from quarterbell.streaming import both_kinds, start_one_pass
from tests.conftest import hours_due
from tests.test_streaming import ONE_FILE, RAW, archive


def same(a, b):
    return a.exceptAll(b).count() == 0 == b.exceptAll(a).count()


@pytest.mark.parametrize("name", ["hourly", "flat"])
def test_one_query_writes_what_two_would(spark, name):
    path, folder = archive(spark, dirty=True, files=2), new_folder(spark, "one-pass")
    start_one_pass(name, read_messages(spark, "parquet", ONE_FILE, path), folder, ONE_FILE, available_now=True).awaitTermination()
    messages, job = spark.read.schema(RAW).parquet(path), JOBS[name]
    rows, rejected = both_kinds(spark, name, folder)
    assert same(rows, job.rows(messages, ONE_FILE)) and same(rejected, job.rejected(messages, ONE_FILE))
    assert rows.count() + rejected.count() == 1000 and rejected.count() > 10


def test_messages_are_read_and_parsed_once(spark):
    path = archive(spark, dirty=True, files=1)
    plan = flat_one_pass(spark.read.schema(RAW).parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and plan.count("json_tuple") == 1


def test_after_a_crash_both_kinds_agree(spark, monkeypatch):
    """A task of the second batch fails for good after others wrote files; the next run redoes the batch."""
    path, folder = archive(spark, dirty=True, files=2), new_folder(spark, "one-pass-crash")
    options = JobOptions(max_files_per_trigger=1, gather=False)

    def failing(messages):
        lost = F.when(F.col("seq") == 700, F.raise_error(F.lit("task lost")).cast("string"))
        return messages.repartition(4, "seq").withColumn("raw", lost.otherwise(F.col("raw")))

    messages = read_messages(spark, "parquet", options, path)
    with pytest.raises(Exception, match="task lost"):
        start_one_pass("flat", failing(messages), folder, options, available_now=True).awaitTermination()
    rows, rejected = both_kinds(spark, "flat", folder)
    assert rows.count() + rejected.count() == 500
    start_one_pass("flat", messages, folder, options, available_now=True).awaitTermination()
    rows, rejected = both_kinds(spark, "flat", folder)
    whole, job = spark.read.schema(RAW).parquet(path), JOBS["flat"]
    assert same(rows, job.rows(whole, options)) and same(rejected, job.rejected(whole, options))


def test_partitions_are_committed_from_the_common_log(spark, monkeypatch):
    from quarterbell.sinks import commit

    path, folder = archive(spark, dirty=True, files=2), new_folder(spark, "one-pass-commit")
    start_one_pass("hourly", read_messages(spark, "parquet", ONE_FILE, path), folder, ONE_FILE, True, "one_pass_hours").awaitTermination()
    rows, _ = both_kinds(spark, "hourly", folder)
    monkeypatch.setattr(commit, "written_partitions", None)
    newest = rows.agg(F.max("sampletime")).head()[0]
    watermark = F.lit(newest + "Z").cast("timestamp") - F.expr("INTERVAL 3 MINUTES")
    done = commit_pending(spark, "one_pass_hours", f"{folder}/all/kind=rows", f"{folder}/ledger", watermark, log=f"{folder}/all")
    assert {f"dt={r.dt}/hr={r.hr}" for r in done} == hours_due(rows) == {r.partition for r in spark.sql("SHOW PARTITIONS one_pass_hours").collect()}


def test_a_job_with_state_keeps_two_queries(spark):
    with pytest.raises(ValueError, match="keeps state"):
        start_one_pass("quarter_hour", spark.range(1), "x")
