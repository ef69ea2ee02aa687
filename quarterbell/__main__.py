"""Run one of the jobs: ``spark-submit ... quarterbell/__main__.py hourly --servers h:9092 ...``."""

from __future__ import annotations

import argparse
import time

from pyspark.sql import Column, SparkSession

from quarterbell.plans import JOBS, KIND, commit_replay, groups_of, replay_job
from quarterbell.schema import JobOptions
from quarterbell.session import configure
from quarterbell.sinks import commit_pages, drop_superseded, publish_pages
from quarterbell.sources import read_groups, read_messages
from quarterbell.streaming import LateRows, collect_late, commit_while_running, start_job, start_one_pass


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="quarterbell")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--folder", required=True, help="rows, quarantine, checkpoints and ledger go below it")
    parser.add_argument("--format", default="kafka", choices=("kafka", "parquet", "text", "json"))
    parser.add_argument("--path", action="append", help="input of the file formats; each one given is a group of its own")
    parser.add_argument("--servers", default="")
    parser.add_argument("--topic", default="readings")
    parser.add_argument("--partition-groups", help="partitions of the topic that keep pace, as 0,1;2,3: each group has a watermark")
    parser.add_argument("--start", default="earliest", help="earliest, latest, group-offsets, or offsets as JSON")
    parser.add_argument("--group")
    parser.add_argument("--table", help="catalog table over the rows; its partitions are committed")
    parser.add_argument("--daytime", default="run_date", choices=("run_date", "event_date"))
    parser.add_argument("--bad-time", default="sentinel", choices=("sentinel", "quarantine"))
    parser.add_argument("--drop-late", action="store_true", help="a replay leaves out late readings as a stream does")
    parser.add_argument("--no-gather", action="store_true", help="write input in time order without a shuffle")
    parser.add_argument("--one-pass", action="store_true", help="one query for rows and quarantine (hourly, flat)")
    parser.add_argument("--max-files", type=int)
    parser.add_argument("--max-offsets", type=int)
    parser.add_argument("--shuffle-partitions", type=int)
    parser.add_argument("--publish", action="store_true",
                        help="commit by rewriting each due partition as few files, from which the table is read")
    parser.add_argument("--keep-published-seconds", type=int, default=86_400, help="how long replaced files of --publish stay")
    parser.add_argument("--run", help="with --replay: add the rows under this name; repeated, it replaces only its own")
    parser.add_argument("--keep-late", action="store_true",
                        help="quarter_hour: write the readings that the state dropped below folder/late")
    parser.add_argument("--commit-seconds", type=int, default=90)
    mode = parser.add_mutually_exclusive_group()
    mode.add_argument("--available-now", action="store_true", help="stop when the present input is done")
    mode.add_argument("--replay", action="store_true", help="one batch over the present input")
    given = parser.parse_args(argv)
    if given.run is not None and not given.replay:
        parser.error("--run names a --replay")
    if given.keep_late and (given.replay or not JOBS[given.job].stateful):
        parser.error("--keep-late needs a stream with state; other jobs drop nothing")
    if given.publish and (given.replay or given.table is None):
        parser.error("--publish needs a stream and a --table")
    return given


def run(spark: SparkSession, given: argparse.Namespace) -> None:
    configure(spark, given.shuffle_partitions)
    options = JobOptions(
        topic=given.topic,
        bootstrap_servers=given.servers,
        start=given.start,
        group_id=given.group,
        max_offsets_per_trigger=given.max_offsets,
        max_files_per_trigger=given.max_files,
        daytime=given.daytime,
        bad_time=given.bad_time,
        drop_late=given.drop_late,
        gather=not given.no_gather,
        partition_groups=tuple(tuple(map(int, g.split(","))) for g in given.partition_groups.split(";")) if given.partition_groups else (),
        # one end for all reads of a replay
        until_millis=int(time.time() * 1000) if given.replay else None,
    )
    paths = given.path or []
    if len(paths) > 1 or options.partition_groups:
        messages = read_groups(spark, given.format, options, paths, streaming=not given.replay)
    else:
        messages = read_messages(spark, given.format, options, *paths, streaming=not given.replay)
    if given.replay:
        replay_job(given.job, messages, given.folder, options, given.table, given.run)
        if given.table is not None and given.run is None:
            commit_replay(spark, given.job, given.folder, given.table)
        return
    job, start = JOBS[given.job], start_one_pass if given.one_pass else start_job
    started = start(given.job, messages, given.folder, options, given.available_now, None if given.publish else given.table)
    main, side = (started, started) if given.one_pass else started
    log, rows = (f"{given.folder}/all", f"{given.folder}/all/{KIND}=rows") if given.one_pass else (None, f"{given.folder}/rows")

    def step(watermark: Column) -> None:
        commit(watermark)
        if given.keep_late:
            batches, lost = collect_late(spark, given.format, given.folder, options, late.by_batch)
            if lost:
                print(f"late rows of {lost} batches are lost: the log of the checkpoint no longer has them")
            late.forget(max(batches, default=0))

    def commit(watermark: Column) -> None:
        if given.table is None or job.commit is None:
            return
        if given.publish:
            folder = f"{given.folder}/published"
            for _ in publish_pages(spark, given.table, rows, folder, watermark, job.commit, log):
                drop_superseded(spark, folder, job.commit.partitions, given.keep_published_seconds)
            return
        for _ in commit_pages(spark, given.table, rows, f"{given.folder}/ledger", watermark, job.commit, log):
            pass

    delay = options.delay if job.stateful else options.table_delay
    late = LateRows(main)
    commit_while_running(main, step, delay, given.commit_seconds, side, late, groups=len(groups_of(messages)))
    side.awaitTermination()
    if job.stateful:
        print(f"late rows dropped: {'' if late.complete else 'at least '}{late.poll()}")


if __name__ == "__main__":
    run(SparkSession.builder.appName("quarterbell").getOrCreate(), arguments())
