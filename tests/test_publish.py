"""Publishing partitions of a stream as few files, and replays that add up."""

import glob

import pytest
from pyspark.sql import functions as F

from checks.bindings import as_messages, events
from quarterbell.__main__ import arguments, run
from quarterbell.plans import replay_job
from quarterbell.schema import table_schema
from quarterbell.session import new_folder
from quarterbell.sinks import attempts_that_count, drop_superseded, publish, publish_pending, published, read_files, read_runs
from tests.conftest import hours_due
from tests.test_sinklog import PARTS, at, stream_hours

SF = "/root/testdata/sf0.001"


@pytest.fixture
def root(spark):
    return new_folder(spark, "publish")


def table_of(root):
    return root.rsplit("/", 1)[1].replace("-", "_")


def local(path):
    return path.removeprefix("file:")


def hours(frame):
    return sorted(r.hr for r in frame.collect())


def step(spark, root, now):
    return hours_of(publish_pending(spark, table_of(root), f"{root}/out/rows", f"{root}/published", at(now)))


def hours_of(page):
    return sorted(r.hr for r in page)


def test_many_small_files_become_one(spark, root):
    stream_hours(spark, f"{root}/source", f"{root}/out", [[0, 1], [0, 1], [0], [2]])
    assert len(glob.glob(f"{local(root)}/out/rows/dt=*/hr=00/*.parquet")) == 3
    assert step(spark, root, "2024-01-01 01:20:00") == ["00", "01"]
    assert hours(spark.table(table_of(root))) == ["00"] * 3 + ["01"] * 2, "what is not due is not in the table"
    files = {f.rsplit("/", 2)[1] for f in spark.table(table_of(root)).inputFiles()}
    assert files == {"hr=00", "hr=01"} and len(spark.table(table_of(root)).inputFiles()) == 2
    assert step(spark, root, "2024-01-01 01:20:00") == []
    assert step(spark, root, "2024-01-01 02:20:00") == ["02"]
    assert spark.table(table_of(root)).schema == table_schema(PARTS)


def test_newer_files_are_swapped_in_and_old_ones_go_after_a_while(spark, root):
    stream_hours(spark, f"{root}/source", f"{root}/out", [[0], [1]])
    assert step(spark, root, "2024-01-01 05:00:00") == ["00", "01"]
    stream_hours(spark, f"{root}/source", f"{root}/out", [[1]])
    before = spark.table(table_of(root))
    before.count()  # a reader that has listed the old files
    assert step(spark, root, "2024-01-01 05:00:00") == ["01"]
    assert hours(spark.table(table_of(root))) == ["00", "01", "01"]
    assert drop_superseded(spark, f"{root}/published", PARTS, 3600) == 0, "readers may still be at it"
    assert drop_superseded(spark, f"{root}/published", PARTS, 0) == 1
    assert drop_superseded(spark, f"{root}/published", PARTS, 0) == 0
    assert hours(spark.table(table_of(root))) == ["00", "01", "01"]
    assert len(glob.glob(f"{local(root)}/published/generation-*/dt=*/hr=*")) == 2


@pytest.mark.parametrize("dies_in", ["point_partitions", "append_files"])
def test_a_step_that_dies_is_done_again_and_leaves_no_rows_twice(spark, root, monkeypatch, dies_in):
    stream_hours(spark, f"{root}/source", f"{root}/out", [[0], [0, 1]])
    done = getattr(publish, dies_in)

    def dies(*given):
        done(*given)
        raise OSError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(publish, dies_in, dies)
        with pytest.raises(OSError, match="lost"):
            step(spark, root, "2024-01-01 05:00:00")
    assert published(spark, f"{root}/published", PARTS).count() == 0
    assert step(spark, root, "2024-01-01 05:00:00") == ["00", "01"]
    assert hours(spark.table(table_of(root))) == ["00", "00", "01"]
    assert drop_superseded(spark, f"{root}/published", PARTS, 0) == 1, "the folder that no entry names"
    assert hours(spark.table(table_of(root))) == ["00", "00", "01"]


def test_remains_of_a_batch_that_died_are_not_published(spark, root):
    stream_hours(spark, f"{root}/source", f"{root}/out", [[0]])
    lost = spark.createDataFrame([("x", "t", None, "lost")], "measurepointid string, measuretag string, value1 decimal(30,8), sampletime string")
    lost.write.mode("append").parquet(f"{root}/out/rows/dt=2024-01-01/hr=00")
    assert step(spark, root, "2024-01-01 05:00:00") == ["00"]
    assert [r.measurepointid for r in spark.table(table_of(root)).collect()] == ["a"]


def test_pages_are_generations_of_their_own(spark, root, monkeypatch):
    monkeypatch.setattr(publish, "PAGE", 2)
    stream_hours(spark, f"{root}/source", f"{root}/out", [[0, 1, 2, 3, 4]])
    assert len(step(spark, root, "2024-01-01 09:00:00")) == 5
    assert published(spark, f"{root}/published", PARTS).select("generation").distinct().count() == 3
    assert hours(spark.table(table_of(root))) == [f"0{h}" for h in range(5)]


def test_nothing_written_is_nothing_published(spark, root):
    assert step(spark, root, "2024-01-01 09:00:00") == []
    assert drop_superseded(spark, f"{root}/published", PARTS) == 0
    assert spark.table(table_of(root)).count() == 0


@pytest.fixture(scope="module")
def archive(spark):
    path = new_folder(spark, "publish-input")
    as_messages(events(spark, SF), dirty=True).coalesce(1).write.parquet(path)
    return path


@pytest.mark.parametrize("more", [[], ["--one-pass"]])
def test_a_job_publishes_its_table(spark, archive, root, more):
    run(spark, arguments([
        "hourly", "--format", "parquet", "--path", archive, "--folder", root, "--shuffle-partitions", "4", "--available-now",
        "--table", table_of(root), "--publish", "--commit-seconds", "5", *more]))
    rows = read_files(spark, f"{root}/all/kind=rows" if more else f"{root}/rows", PARTS)
    listed = {r.partition for r in spark.sql(f"SHOW PARTITIONS {table_of(root)}").collect()}
    assert listed == hours_due(rows) and listed
    due = rows.where(F.concat(F.lit("dt="), "dt", F.lit("/hr="), "hr").isin(listed))
    table = spark.table(table_of(root))
    assert table.exceptAll(due).count() == due.exceptAll(table).count() == 0


@pytest.mark.parametrize("given", [["--run", "a"], ["--publish"], ["--publish", "--table", "t", "--replay"]])
def test_options_that_need_others(given):
    with pytest.raises(SystemExit):
        arguments(["hourly", "--folder", "x", *given])


def same(a, b):
    return a.exceptAll(b).count() == b.exceptAll(a).count() == 0


@pytest.mark.parametrize("job", ["flat", "hourly", "quarter_hour"])
def test_ranges_add_and_a_repeated_one_replaces_its_own(spark, archive, root, job):
    from quarterbell import JobOptions
    from quarterbell.plans import JOBS

    options, partitions = JobOptions(daytime="event_date"), JOBS[job].partitions
    messages = spark.read.parquet(archive)
    low, high = messages.where("seq < 400"), messages.where("seq >= 400")
    wanted = JOBS[job].rows(low, options).unionByName(JOBS[job].rows(high, options))
    rejected = JOBS[job].rejected(messages, options).count()
    for name, some in (("low", low), ("high", high), ("low", low)):
        replay_job(job, some, root, options, table_of(root), name)
    assert same(read_runs(spark, root, partitions), wanted)
    assert same(spark.table(table_of(root)).drop("run"), wanted)
    assert read_runs(spark, root, kind="quarantine").count() == rejected > 0
    assert list(attempts_that_count(spark, root)) == ["high", "low"]


def test_a_run_that_shrinks_loses_its_partitions(spark, archive, root):
    messages = spark.read.parquet(archive)
    replay_job("hourly", messages, root, table=table_of(root), run="all")
    many = spark.sql(f"SHOW PARTITIONS {table_of(root)}").count()
    replay_job("hourly", messages.where("seq < 5"), root, table=table_of(root), run="all")
    few = spark.sql(f"SHOW PARTITIONS {table_of(root)}").count()
    assert 0 < few < many and spark.table(table_of(root)).count() <= 5
    replay_job("hourly", messages.where("seq < 0"), root, table=table_of(root), run="all")
    assert spark.table(table_of(root)).count() == read_runs(spark, root, PARTS).count() == 0


def test_a_run_that_dies_changes_nothing(spark, archive, root):
    messages = spark.read.parquet(archive)
    replay_job("flat", messages.where("seq < 100"), root, run="a")
    before = read_runs(spark, root).count()
    broken = messages.withColumn("raw", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        replay_job("flat", broken, root, run="a")
    assert read_runs(spark, root).count() == before > 0
    assert read_runs(spark, f"{root}/nowhere").count() == 0
    with pytest.raises(ValueError, match="named by"):
        replay_job("flat", messages, root, run="../a")
