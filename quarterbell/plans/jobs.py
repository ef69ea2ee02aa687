"""The three jobs, each a plan from messages to table rows for batch or stream."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbell.operators import (
    all_records,
    all_table_records,
    on_time_readings,
    quarantine,
    readings,
    table_columns,
    table_quarantine,
    table_rows,
    time_neat,
    with_day,
    with_event_time,
    with_hour,
    with_run_date,
    with_watermark,
)
from quarterbell.schema import DAILY_PARTITIONS, HOURLY_PARTITIONS, JobOptions
from quarterbell.sinks import (
    DAILY_COMMIT,
    HOURLY_COMMIT,
    CommitRule,
    append_files,
    attempt_folder,
    commit_pending,
    create_table,
    has_stream_log,
    new_attempt,
    point_run,
    register_attempt,
)
from quarterbell.sources.messages import NO_ORDER, NO_STREAM


#: Messages of one source, or of several groups of sources.
Messages = DataFrame | Sequence[DataFrame]


def groups_of(messages: Messages) -> list[DataFrame]:
    return [messages] if isinstance(messages, DataFrame) else list(messages)


def _united(messages: Messages, prepare: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """All groups as one, each prepared by itself: what gives a watermark gives one to each."""
    return reduce(DataFrame.unionByName, map(prepare, groups_of(messages)))


def _marked(messages: DataFrame, column: str, mark: str) -> bool:
    return column in messages.columns and bool(messages.schema[column].metadata.get(mark))


def quarter_hour_rows(
    messages: Messages,
    options: JobOptions = JobOptions(),
    arrival: Column | None = None,
) -> DataFrame:
    """Normalised quarter-hour readings with their ``daytime`` partition.

    A stream drops late readings in its state; a batch keeps them unless
    ``drop_late`` asks for the same rule. Of several groups (``sources.read_groups``)
    each has its own watermark, and the least of them decides.
    """
    streaming = any(m.isStreaming for m in groups_of(messages))
    if streaming and arrival is None and any(_marked(m, "seq", NO_ORDER) for m in groups_of(messages)):
        raise ValueError("a stream of text has no order of arrival; give read_messages a position")
    if options.drop_late and not streaming and any(_marked(m, "source_partition", NO_STREAM) for m in groups_of(messages)):
        raise ValueError("late readings of files need the stream that each file is part of; give read_messages a stream")
    stamped = _united(messages, lambda m: with_watermark(with_event_time(readings(m, options.bad_time)), options.delay))
    if options.drop_late and not streaming:
        stamped = on_time_readings(stamped, options.window, options.delay)
    neat = time_neat(stamped, options.window, arrival, options.arrival_bound)
    rows = table_columns(neat)
    if options.daytime == "event_date":
        return with_day(rows)
    return with_run_date(rows, options.run_millis)


def quarter_hour_quarantine(messages: Messages, options: JobOptions = JobOptions()) -> DataFrame:
    """What ``quarter_hour_rows`` leaves out."""
    return _united(messages, lambda m: quarantine(m, options.bad_time))


def hourly_rows(messages: Messages, options: JobOptions = JobOptions()) -> DataFrame:
    """Raw readings with their ``dt`` and ``hr`` partition."""
    stamped = _united(messages, lambda m: with_watermark(table_rows(m), options.table_delay, "ts"))
    return table_columns(with_hour(stamped), "dt", "hr")


def register_source(
    messages: DataFrame, name: str = "message_source", options: JobOptions = JobOptions(),
) -> None:
    """Make messages a view for SQL: the four message columns, ``ts`` with its watermark, ``dt`` and ``hr``.

    ``dt`` and ``hr`` are there because ``date_format(ts, ...)`` would go
    through the session zone.
    """
    stamped = with_watermark(table_rows(messages), options.table_delay, "ts")
    with_hour(stamped).createOrReplaceTempView(name)


def hourly_rows_sql(
    messages: DataFrame, name: str = "message_source", options: JobOptions = JobOptions(),
) -> DataFrame:
    """The rows of ``hourly_rows`` for those who write SQL."""
    register_source(messages, name, options)
    return messages.sparkSession.sql(f"""
        SELECT MEASUREPOINTID, MEASURETAG, TRY_CAST(VALUE AS DECIMAL(30, 8)) AS VALUE1, SAMPLETIME, dt, hr
        FROM {name}
    """).toDF("measurepointid", "measuretag", "value1", "sampletime", "dt", "hr")


def hourly_quarantine(messages: Messages, options: JobOptions = JobOptions()) -> DataFrame:
    """What ``hourly_rows`` leaves out."""
    return _united(messages, table_quarantine)


def flat_rows(messages: Messages, options: JobOptions = JobOptions()) -> DataFrame:
    """Raw readings for the unpartitioned table."""
    return table_columns(_united(messages, readings))


def flat_quarantine(messages: Messages, options: JobOptions = JobOptions()) -> DataFrame:
    """What ``flat_rows`` leaves out."""
    return _united(messages, quarantine)


#: What a one-pass row is, and the columns that only a quarantined record has.
KIND, _REJECTED = "kind", ("source_partition", "seq", "raw", "reason")


def _of_both_kinds(records: DataFrame, *partitions: str) -> DataFrame:
    """Table rows and quarantined records side by side, told apart by ``kind``."""
    good = F.col("reason").isNull()
    kind = F.when(good, "rows").otherwise("quarantine").alias(KIND)
    where = [F.when(good, F.col(c)).alias(c) for c in partitions]
    rejected = [c if c in ("raw", "reason") else F.when(~good, F.col(c)).alias(c) for c in _REJECTED]
    return table_columns(records, *rejected, kind, *where)


def hourly_one_pass(messages: Messages, options: JobOptions = JobOptions()) -> DataFrame:
    """The rows and the quarantine of the hourly job, from one read of the messages."""
    stamped = _united(messages, lambda m: with_watermark(all_table_records(m), options.table_delay, "ts"))
    return _of_both_kinds(with_hour(stamped), *HOURLY_PARTITIONS)


def flat_one_pass(messages: Messages, options: JobOptions = JobOptions()) -> DataFrame:
    """The rows and the quarantine of the flat job, from one read of the messages."""
    return _of_both_kinds(_united(messages, all_records))


@dataclass(frozen=True)
class Job:
    """Table rows, quarantined records, and how the table is partitioned and committed."""

    rows: Callable[[Messages, JobOptions], DataFrame]
    rejected: Callable[[Messages, JobOptions], DataFrame]
    partitions: tuple[str, ...]
    stateful: bool = False
    commit: CommitRule | None = None
    one_pass: Callable[[Messages, JobOptions], DataFrame] | None = None


JOBS = {
    "quarter_hour": Job(
        quarter_hour_rows, quarter_hour_quarantine, DAILY_PARTITIONS, stateful=True, commit=DAILY_COMMIT),
    "hourly": Job(hourly_rows, hourly_quarantine, HOURLY_PARTITIONS, commit=HOURLY_COMMIT, one_pass=hourly_one_pass),
    "flat": Job(flat_rows, flat_quarantine, (), one_pass=flat_one_pass),
}


def replay_job(
    name: str,
    messages: Messages,
    folder: str,
    options: JobOptions = JobOptions(),
    table: str | None = None,
    run: str | None = None,
) -> None:
    """Run a job once over a bounded source, into the partitions of ``folder`` that its rows belong to.

    These partitions (a table without any: all of it) and the quarantine are
    replaced, so a replay that is repeated, or that died between the two, ends
    the same way; with ``daytime="run_date"`` give ``run_millis``. A topic should
    be read with ``until_millis``: all reads of it then end at the same records.
    The folder of a stream is refused, as its log would no longer be true.
    With ``table`` the rows are also a table of the catalog, which learns their
    partitions. Rows of one run date need no shuffle of their own: the
    aggregation has already spread them evenly over the tasks.

    With ``run`` nothing of other runs is replaced: the rows are added under that name, and a repeated
    run takes the place of its own earlier rows and quarantine (``sinks.read_runs`` reads them all). The
    table then has a leading partition ``run``.
    """
    job = JOBS[name]
    spark = groups_of(messages)[0].sparkSession
    if run is not None:
        attempt = new_attempt(run)
        _write_rows(name, messages, attempt_folder(folder, run, attempt), options)
        append_files(job.rejected(messages, options), attempt_folder(folder, run, attempt, "quarantine"))
        register_attempt(spark, folder, run, attempt)
        if table is not None:
            point_run(spark, table, folder, run, job.partitions)
        return
    if has_stream_log(spark, f"{folder}/rows"):
        raise ValueError(f"{folder} belongs to a stream; replay into another folder")
    _write_rows(name, messages, f"{folder}/rows", options)
    if table is not None:
        create_table(spark, table, job.partitions, f"{folder}/rows")
        if job.partitions:
            spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")
        spark.catalog.refreshTable(table)
    append_files(job.rejected(messages, options), f"{folder}/quarantine", mode="overwrite")


def _write_rows(name: str, messages: Messages, path: str, options: JobOptions) -> None:
    """Write the rows of a replay in place of the partitions that they belong to."""
    job = JOBS[name]
    one_partition = name == "quarter_hour" and options.daytime == "run_date"
    rebalance = options.gather and not one_partition
    append_files(job.rows(messages, options), path, job.partitions, rebalance, mode="overwrite")


def commit_replay(spark: SparkSession, name: str, folder: str, table: str) -> list:
    """Commit all partitions that a replay wrote: its input has ended, so all are due."""
    job = JOBS[name]
    if job.commit is None:
        return []
    # past every partition time
    ended = F.timestamp_millis(F.lit(253402300800000 + 86400000))
    return commit_pending(spark, table, f"{folder}/rows", f"{folder}/ledger", ended, job.commit)
