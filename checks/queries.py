"""One query per operator, each over the whole ``events`` table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.bindings import as_messages, as_readings, as_tied_messages, as_wildly_stamped, events
from quarterbell import JobOptions
from quarterbell.functions import event_time, is_present, is_valid_sample_time, time_text
from quarterbell.operators import (
    in_windows,
    late_readings,
    newest_per_window,
    on_time_readings,
    quarantine,
    readings,
    table_columns,
    table_quarantine,
    table_rows,
    time_neat,
    with_event_time,
    with_hour,
)
from quarterbell.plans import commit_replay, flat_rows, hourly_rows, hourly_rows_sql, quarter_hour_rows, replay_job
from quarterbell.session import new_folder
from quarterbell.sinks import (
    DAILY_COMMIT,
    append_files,
    commit_pending,
    committable_partitions,
    create_table,
    list_tables,
    publish_pending,
    read_files,
    read_runs,
    spread,
    use_database,
)
from quarterbell.sources import read_groups, read_messages
from quarterbell.streaming import append_stream, both_kinds, collect_late, late_rows, preview_stream, start_job, start_one_pass

# The day the daily table is filled, as the start of a run.
RUN_MILLIS = 1704067200000
# Files of each part of an archive: as many tasks write and read it.
FILES = 8


def _readings(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return as_readings(events(spark, sf_dir), dirty_times=dirty)


def _stamped(spark: SparkSession, sf_dir: str, dirty: bool = False) -> DataFrame:
    return with_event_time(_readings(spark, sf_dir, dirty))


def _messages(spark: SparkSession, sf_dir: str, dirty: bool = False, streaming: bool = False) -> DataFrame:
    return as_messages(events(spark, sf_dir, streaming), dirty)


def _write_archive(table: DataFrame, path: str) -> None:
    """Damaged messages of some events kept as an archive. The events are dealt evenly first, however few parts of
    the table's file hold them, so that as many tasks as there are cores make, write and later read the messages."""
    tasks = max(FILES, table.sparkSession.sparkContext.defaultParallelism)
    as_messages(table.repartition(tasks), dirty=True).write.mode("append").parquet(path)


def decode_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(_messages(spark, sf_dir, dirty=True))


def decode_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(_messages(spark, sf_dir, dirty=True)).drop("raw")


def quarantine_bad_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quarantine(_messages(spark, sf_dir, dirty=True), bad_time="quarantine").drop("raw")


def sample_time_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("sampletime")
    return _readings(spark, sf_dir, dirty=True).select(
        "seq", is_present(text).alias("present"), is_valid_sample_time(text).alias("valid"),
    )


def event_time_sentinel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _readings(spark, sf_dir, dirty=True).select(
        "seq", F.unix_millis(event_time(F.col("sampletime"))).alias("event_millis"),
    )


def table_decode_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table_rows(_messages(spark, sf_dir, dirty=True), keep_null_time=True)
    return rows.withColumn("ts", time_text(F.col("ts")))


def table_quarantined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_quarantine(_messages(spark, sf_dir, dirty=True)).drop("raw")


def project_decimal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_columns(_readings(spark, sf_dir), "seq")


def hourly_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_hour(_stamped(spark, sf_dir), "event_time").select("seq", "dt", "hr")


def window_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_windows(_stamped(spark, sf_dir, dirty=True)).select(
        "seq",
        time_text(F.col("window.start")).alias("window_start"),
        time_text(F.col("window.end")).alias("window_end"),
    )


def latest_per_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = newest_per_window(in_windows(_stamped(spark, sf_dir)))
    return newest.select(
        "measurepointid",
        "measuretag",
        time_text(F.col("window.start")).alias("window_start"),
        "value",
        time_text(F.col("event_time")).alias("event_time"),
    )


def time_neat_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_columns(time_neat(_stamped(spark, sf_dir)))


def time_neat_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_columns(time_neat(_stamped(spark, sf_dir, dirty=True)))


def time_neat_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole quarter-hour job, from damaged JSON text to dated table rows."""
    return quarter_hour_rows(_messages(spark, sf_dir, dirty=True), JobOptions(daytime="event_date"))


def time_neat_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job where positions repeat over source partitions and most times are equal."""
    return quarter_hour_rows(as_tied_messages(events(spark, sf_dir)), JobOptions(run_millis=RUN_MILLIS))


def time_neat_wild_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with timestamps of the records, many of them outside any real range."""
    return quarter_hour_rows(as_wildly_stamped(as_tied_messages(events(spark, sf_dir))), JobOptions(run_millis=RUN_MILLIS))


def time_neat_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job with the cheaper ranking for positions below 2^53."""
    return quarter_hour_rows(
        _messages(spark, sf_dir, dirty=True),
        JobOptions(run_millis=RUN_MILLIS, bad_time="quarantine", arrival_bound=1 << 53),
    )


def time_neat_on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch replay that leaves out what a stream would have dropped as late."""
    return table_columns(time_neat(on_time_readings(_stamped(spark, sf_dir, dirty=True))))


def time_neat_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole job over damaged JSON text with the late-data rule of the stream."""
    return quarter_hour_rows(
        _messages(spark, sf_dir, dirty=True), JobOptions(daytime="event_date", drop_late=True))


def late_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = late_readings(_stamped(spark, sf_dir, dirty=True))
    return late.select("seq", "source_partition", time_text(F.col("event_time")).alias("event_time"))


def late_audit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit over text files, several of which make up each stream."""
    path = new_folder(spark, "files")
    messages = _messages(spark, sf_dir, dirty=True).withColumn("file", F.floor(F.col("seq") * 4 / events(spark, sf_dir).count()))
    ordered = messages.repartition("source_partition", "file").sortWithinPartitions("source_partition", "file", "seq")
    ordered.select("raw", F.col("source_partition").alias("stream"), "file").write.partitionBy("stream", "file").text(path)
    stream = F.regexp_extract("path", "/stream=([0-9]+)/", 1).cast("int")
    lines = read_messages(spark, "text", JobOptions(), path, streaming=False, stream=stream)
    late = late_readings(with_event_time(readings(lines)))
    return late.select(
        "source_partition", "measurepointid", "measuretag", "value", time_text(F.col("event_time")).alias("event_time"))


def hourly_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_rows_sql(_messages(spark, sf_dir, dirty=True))


def append_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "hourly")
    append_files(hourly_rows(_messages(spark, sf_dir)), path, ("dt", "hr"))
    return read_files(spark, path, ("dt", "hr"))


def append_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "daily")
    rows = quarter_hour_rows(_messages(spark, sf_dir), JobOptions(run_millis=RUN_MILLIS))
    append_files(rows, path, ("daytime",), rebalance=False)
    return read_files(spark, path, ("daytime",))


def append_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "flat")
    append_files(flat_rows(_messages(spark, sf_dir)), path)
    return read_files(spark, path)


def _hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly partitions of the readings; their text is made once per hour, not per reading."""
    hour = F.window("event_time", "1 hour")
    spans = _stamped(spark, sf_dir).groupBy(hour.alias("hour")).agg(
        F.min("event_time").alias("first"), F.max("event_time").alias("last"),
    )
    return with_hour(spans, "first")


def _watermark_in_the_middle(hours: DataFrame) -> Column:
    """The watermark of the moment half the time span had passed."""
    first, last = F.unix_millis(F.min("first")), F.unix_millis(F.max("last"))
    half = F.floor((last - first) / 2)
    return hours.agg(F.timestamp_millis(first + half - 180000).alias("watermark")).scalar()


def committable(spark: SparkSession, sf_dir: str) -> DataFrame:
    hours = _hours(spark, sf_dir)
    return committable_partitions(hours, _watermark_in_the_middle(hours)).select("dt", "hr")


def committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the hourly table, commit what is due, and read the catalog's partitions."""
    path = new_folder(spark, "committed")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    append_files(hourly_rows(_messages(spark, sf_dir)), path, ("dt", "hr"))
    create_table(spark, table, ("dt", "hr"), path)
    watermark = _watermark_in_the_middle(_hours(spark, sf_dir))
    commit_pending(spark, table, path, f"{path}-ledger", watermark)
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    spark.sql(f"DROP TABLE {table}")
    return listed.select(
        F.regexp_extract("partition", "dt=([^/]*)", 1).alias("dt"),
        F.regexp_extract("partition", "hr=([^/]*)", 1).alias("hr"),
    )


def _partitions_of(spark: SparkSession, table: str, *names: str) -> DataFrame:
    listed = spark.sql(f"SHOW PARTITIONS {table}")
    return listed.select(*[F.regexp_extract("partition", f"{name}=([^/]*)", 1).alias(name) for name in names])


def committed_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the daily table, commit the days that are due, and read the catalog's partitions."""
    path = new_folder(spark, "committed-daily")
    table = path.rsplit("/", 1)[1].replace("-", "_")
    append_files(quarter_hour_rows(_messages(spark, sf_dir), JobOptions(daytime="event_date")), path, ("daytime",))
    create_table(spark, table, ("daytime",), path)
    commit_pending(spark, table, path, f"{path}-ledger", _watermark_in_the_middle(_hours(spark, sf_dir)), DAILY_COMMIT)
    listed = _partitions_of(spark, table, "daytime")
    spark.sql(f"DROP TABLE {table}")
    return listed


def replay_committed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replay the hourly job twice, commit, and count the rows of the committed partitions."""
    folder = new_folder(spark, "replayed")
    table = folder.rsplit("/", 1)[1].replace("-", "_")
    messages = _messages(spark, sf_dir)
    for _ in range(2):
        replay_job("hourly", messages, folder, table=table)
    commit_replay(spark, "hourly", folder, table)
    committed = spark.read.parquet(f"{folder}/ledger").select("dt", "hr")
    rows = read_files(spark, f"{folder}/rows", ("dt", "hr")).groupBy("dt", "hr").agg(F.count("*").alias("n"))
    spark.sql(f"DROP TABLE {table}")
    return rows.join(committed, ["dt", "hr"], "left_semi")


def listed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A database with a table for each tag of the readings, listed."""
    before, name = spark.catalog.currentDatabase(), new_folder(spark, "listed").rsplit("/", 1)[1].replace("-", "_")
    use_database(spark, name)
    try:
        for row in _readings(spark, sf_dir).select("measuretag").distinct().collect():
            create_table(spark, f"readings_{row.measuretag}")
        found = [(table,) for table in list_tables(spark) if table.startswith("readings_")]
    finally:
        spark.catalog.setCurrentDatabase(before)
        spark.sql(f"DROP DATABASE {name} CASCADE")
    return spark.createDataFrame(found, "table_name STRING")


def previewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of the previewed rows of the stream are rows of the table."""
    name = new_folder(spark, "previewed").rsplit("/", 1)[1].replace("-", "_")
    first = preview_stream(table_rows(_messages(spark, sf_dir, streaming=True)).drop("ts"), name)
    return first.join(table_rows(_messages(spark, sf_dir)).drop("ts"), "seq", "left_semi").agg(F.count("*").alias("n"))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_rows(_messages(spark, sf_dir)).drop("ts").orderBy("seq").limit(2)


def source_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages kept as lines of text, read back through the file source."""
    path = new_folder(spark, "lines")
    _messages(spark, sf_dir, dirty=True).select("raw").write.text(path)
    lines = read_messages(spark, "text", JobOptions(), path, streaming=False)
    return readings(lines).drop("source_partition", "seq")


def source_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages kept as a parquet archive with their positions, read back and decoded."""
    path = new_folder(spark, "archive")
    _messages(spark, sf_dir, dirty=True).write.parquet(path)
    return readings(read_messages(spark, "parquet", JobOptions(), path, streaming=False))


def stream_time_neat(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-quarter-hour")
    rows = quarter_hour_rows(_messages(spark, sf_dir, streaming=True), JobOptions(run_millis=RUN_MILLIS))
    append_stream(rows, f"{folder}/rows", f"{folder}/checkpoint", ("daytime",), available_now=True).awaitTermination()
    return read_files(spark, f"{folder}/rows", ("daytime",))


def stream_append_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "stream-hourly")
    rows = spread(hourly_rows(_messages(spark, sf_dir, dirty=True, streaming=True)), ("dt", "hr"))
    append_stream(rows, f"{folder}/rows", f"{folder}/checkpoint", ("dt", "hr"), available_now=True).awaitTermination()
    return read_files(spark, f"{folder}/rows", ("dt", "hr"))


def stream_hourly_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly job written in SQL over a stream."""
    folder = new_folder(spark, "stream-sql")
    name = folder.rsplit("/", 1)[1].replace("-", "_")
    rows = spread(hourly_rows_sql(_messages(spark, sf_dir, dirty=True, streaming=True), name), ("dt", "hr"))
    append_stream(rows, f"{folder}/rows", f"{folder}/checkpoint", ("dt", "hr"), available_now=True).awaitTermination()
    return read_files(spark, f"{folder}/rows", ("dt", "hr"))


def stream_time_neat_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarter-hour job over an archive in four parts, one for each micro-batch, with late data."""
    folder = new_folder(spark, "stream-batches")
    messages = _messages(spark, sf_dir, dirty=True)
    part = F.floor(F.col("seq") * 4 / events(spark, sf_dir).count())
    for number in range(4):
        messages.where(part == number).repartition(FILES).write.mode("append").parquet(f"{folder}/archive")
    options = JobOptions(run_millis=RUN_MILLIS, max_files_per_trigger=FILES)
    archive = read_messages(spark, "parquet", options, f"{folder}/archive")
    rows = quarter_hour_rows(archive, options)
    append_stream(rows, f"{folder}/rows", f"{folder}/checkpoint", ("daytime",), available_now=True).awaitTermination()
    return read_files(spark, f"{folder}/rows", ("daytime",))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The readings that the quarter-hour job drops over an archive in four parts, and the micro-batch that dropped each."""
    folder = new_folder(spark, "stream-late")
    messages = _messages(spark, sf_dir, dirty=True)
    part = F.floor(F.col("seq") * 4 / events(spark, sf_dir).count())
    for number in range(4):
        messages.where(part == number).repartition(FILES).write.mode("append").parquet(f"{folder}/archive")
    options = JobOptions(run_millis=RUN_MILLIS, max_files_per_trigger=FILES)
    archive = read_messages(spark, "parquet", options, f"{folder}/archive")
    for query in start_job("quarter_hour", archive, folder, options, available_now=True):
        query.awaitTermination()
    collect_late(spark, "parquet", folder, options)
    return late_rows(spark, folder).withColumn("seq", F.col("seq").cast("long"))


def stream_time_neat_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarter-hour job over two groups of sources, one of which is read at once and the other in four parts.

    The watermark is that of the slower group, so that no reading is late.
    """
    folder = new_folder(spark, "stream-groups")
    messages = _messages(spark, sf_dir)
    part = F.floor(F.col("seq") * 4 / events(spark, sf_dir).count())
    messages.where("seq % 2 = 0").repartition(FILES).write.parquet(f"{folder}/fast")
    for number in range(4):
        messages.where((part == number) & (F.col("seq") % 2 == 1)).repartition(FILES).write.mode("append").parquet(f"{folder}/slow")
    options = JobOptions(run_millis=RUN_MILLIS, max_files_per_trigger=FILES)
    groups = read_groups(spark, "parquet", options, [f"{folder}/fast", f"{folder}/slow"])
    append_stream(quarter_hour_rows(groups, options), f"{folder}/rows", f"{folder}/checkpoint", ("daytime",), available_now=True).awaitTermination()
    return read_files(spark, f"{folder}/rows", ("daytime",))


def _stream_flat(spark: SparkSession, sf_dir: str) -> str:
    folder = new_folder(spark, "stream-flat")
    messages = _messages(spark, sf_dir, dirty=True, streaming=True)
    for query in start_job("flat", messages, folder, available_now=True):
        query.awaitTermination()
    return folder


def _stream_one_pass(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    folder = new_folder(spark, "stream-one-pass")
    start_one_pass("flat", _messages(spark, sf_dir, dirty=True, streaming=True), folder, available_now=True).awaitTermination()
    return both_kinds(spark, "flat", folder)


def stream_one_pass_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a job that writes rows and quarantine as one query."""
    return _stream_one_pass(spark, sf_dir)[0]


def stream_one_pass_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quarantine of the same."""
    return _stream_one_pass(spark, sf_dir)[1].drop("raw")


def stream_append_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_files(spark, f"{_stream_flat(spark, sf_dir)}/rows")


def stream_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_stream_flat(spark, sf_dir)}/quarantine").drop("raw")


def published_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hourly job in four micro-batches of many files, published after each, read from the table.

    As in ``start_job`` a micro-batch writes few files into each hour; a file for each task and hour would make
    the number of files, all of which are listed and opened to be published, grow with the tasks.
    """
    folder = new_folder(spark, "published-hours")
    table = folder.rsplit("/", 1)[1].replace("-", "_")
    whole = events(spark, sf_dir)
    part = F.floor(F.col("event_id") * 4 / whole.count())
    ended = F.lit("9999-12-31T00:00:00Z").cast("timestamp")
    for number in range(4):
        _write_archive(whole.where(part == number), f"{folder}/archive")
        rows = spread(hourly_rows(read_messages(spark, "parquet", JobOptions(), f"{folder}/archive")), ("dt", "hr"))
        append_stream(rows, f"{folder}/rows", f"{folder}/checkpoint", ("dt", "hr"), available_now=True).awaitTermination()
        publish_pending(spark, table, f"{folder}/rows", f"{folder}/published", ended)
    return spark.table(table)


def _replayed_runs(spark: SparkSession, sf_dir: str, job: str) -> str:
    """Two ranges replayed as runs of their own, the first of them again; the folder and name of their table.

    The replays read an archive, as each would make all messages twice otherwise.
    """
    folder = new_folder(spark, "replayed-runs")
    _write_archive(events(spark, sf_dir), f"{folder}/archive")
    messages = read_messages(spark, "parquet", JobOptions(), f"{folder}/archive", streaming=False)
    even = F.col("seq") % 2 == 0
    for run, some in (("first", even), ("second", ~even), ("first", even)):
        replay_job(job, messages.where(some), folder, table=folder.rsplit("/", 1)[1].replace("-", "_"), run=run)
    return folder


def replay_runs_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_runs(spark, _replayed_runs(spark, sf_dir, "flat"))


def replay_runs_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from the table, whose partitions are also those of the runs."""
    return spark.table(_replayed_runs(spark, sf_dir, "hourly").rsplit("/", 1)[1].replace("-", "_")).drop("run")


def replay_runs_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_runs(spark, _replayed_runs(spark, sf_dir, "flat"), kind="quarantine").drop("raw")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "decode_messages": decode_messages,
        "decode_quarantine": decode_quarantine,
        "quarantine_bad_time": quarantine_bad_time,
        "sample_time_valid": sample_time_valid,
        "event_time_sentinel": event_time_sentinel,
        "table_decode_nulls": table_decode_nulls,
        "table_quarantine": table_quarantined,
        "project_decimal": project_decimal,
        "hourly_columns": hourly_columns,
        "window_assign": window_assign,
        "latest_per_window": latest_per_window,
        "time_neat": time_neat_clean,
        "time_neat_dirty": time_neat_dirty,
        "time_neat_messages": time_neat_messages,
        "time_neat_ties": time_neat_ties,
        "time_neat_wild_stamps": time_neat_wild_stamps,
        "time_neat_bounded": time_neat_bounded,
        "time_neat_on_time": time_neat_on_time,
        "time_neat_replay": time_neat_replay,
        "late_audit": late_audit,
        "late_audit_files": late_audit_files,
        "hourly_sql": hourly_sql,
        "append_hourly": append_hourly,
        "append_daily": append_daily,
        "append_flat": append_flat,
        "committable_partitions": committable,
        "committed_partitions": committed,
        "committed_daily": committed_daily,
        "replay_committed": replay_committed,
        "list_tables": listed_tables,
        "preview": preview,
        "preview_stream": previewed,
        "source_text": source_text,
        "source_archive": source_archive,
        "stream_time_neat": stream_time_neat,
        "stream_time_neat_batches": stream_time_neat_batches,
        "stream_late_rows": stream_late_rows,
        "stream_time_neat_groups": stream_time_neat_groups,
        "stream_append_hourly": stream_append_hourly,
        "stream_hourly_sql": stream_hourly_sql,
        "stream_append_flat": stream_append_flat,
        "stream_quarantine": stream_quarantine,
        "stream_one_pass_rows": stream_one_pass_rows,
        "stream_one_pass_quarantine": stream_one_pass_quarantine,
        "published_hours": published_hours,
        "replay_runs_flat": replay_runs_flat,
        "replay_runs_hourly": replay_runs_hourly,
        "replay_runs_quarantine": replay_runs_quarantine,
    }
