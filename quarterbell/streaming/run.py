"""Start, watch and preview streaming queries.

Rows are written by Spark's own file sink, whose log makes each micro-batch
appear exactly once, across restarts and lost executors. The progress reports
of the running query are read by polling; nothing calls back into Python.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from quarterbell.plans import JOBS, KIND, Messages, groups_of
from quarterbell.schema import JobOptions, table_schema
from quarterbell.sinks import create_table, spread

# Fixed value: the interval between two checkpoints of the table jobs.
TRIGGER = "90 seconds"


def append_stream(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partitions: tuple[str, ...] = (),
    table: str | None = None,
    available_now: bool = False,
    interval: str = TRIGGER,
) -> StreamingQuery:
    """Append a stream to a parquet folder, or to ``table`` whose files are kept there."""
    writer = (
        rows.writeStream.outputMode("append")
        .format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .partitionBy(*partitions)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start() if table is None else writer.toTable(table)


def start_job(
    name: str,
    messages: Messages,
    folder: str,
    options: JobOptions = JobOptions(),
    available_now: bool = False,
    table: str | None = None,
) -> tuple[StreamingQuery, StreamingQuery]:
    """Run one of the three jobs below ``folder``: its rows and its quarantine.

    With ``table`` the rows are also a table of the catalog, made if missing.
    The quarantine is a query of its own: it stays stateless, has its own
    checkpoint and never holds back the watermark of the rows.
    """
    job = JOBS[name]
    rows = job.rows(messages, options)
    if options.gather:
        rows = few_files(rows, files_of(rows.sparkSession, options)) if job.stateful else spread(rows, job.partitions)
    if table is not None:
        create_table(groups_of(messages)[0].sparkSession, table, job.partitions, f"{folder}/rows")
    main = append_stream(
        rows, f"{folder}/rows", f"{folder}/checkpoints/rows", job.partitions, table, available_now,
    )
    side = append_stream(
        job.rejected(messages, options), f"{folder}/quarantine", f"{folder}/checkpoints/quarantine",
        available_now=available_now,
    )
    return main, side


def start_one_pass(
    name: str,
    messages: Messages,
    folder: str,
    options: JobOptions = JobOptions(),
    available_now: bool = False,
    table: str | None = None,
) -> StreamingQuery:
    """Run a stateless job as one query, which reads each message once and writes rows and quarantine below ``folder/all``.

    One checkpoint and one log cover both kinds, so after any crash they agree
    on what was read. ``both_kinds`` reads them back; ``table`` is a table over the rows.
    """
    job = JOBS[name]
    if job.one_pass is None:
        raise ValueError(f"the {name} job keeps state; its quarantine is a query of its own")
    partitions = (KIND, *job.partitions)
    records = job.one_pass(messages, options)
    records = spread(records, partitions) if options.gather else records
    if table is not None:
        create_table(groups_of(messages)[0].sparkSession, table, job.partitions, f"{folder}/all/{KIND}=rows")
    return append_stream(records, f"{folder}/all", f"{folder}/checkpoints/all", partitions, available_now=available_now)


def both_kinds(spark: SparkSession, name: str, folder: str) -> tuple[DataFrame, DataFrame]:
    """The rows and the quarantine of ``start_one_pass``, as far as batches are finished."""
    job = JOBS[name]
    # positions have the type of their source; partition values stay texts
    written = spark.read.parquet(f"{folder}/all").schema
    schema = T.StructType([f for f in written if f.name not in (KIND, *job.partitions)] + table_schema((KIND, *job.partitions)).fields[4:])
    written = spark.read.schema(schema).parquet(f"{folder}/all")
    rows = written.where(F.col(KIND) == "rows").select(*[f.name for f in table_schema(job.partitions)])
    return rows, written.where(F.col(KIND) == "quarantine").select("source_partition", "seq", "raw", "reason")


def few_files(rows: DataFrame, files: int) -> DataFrame:
    """Finished rows of a stateful stream, in so many tasks at most that write files.

    Behind the state each micro-batch would otherwise write one file for each
    shuffle partition. The rows are few, one per key and closed window, and are
    dealt evenly, whatever partition they belong to.
    """
    return rows.repartition(files)


def files_of(spark: SparkSession, options: JobOptions) -> int:
    """Tasks that write a micro-batch of the stateful job: as given, else an eighth of the shuffle partitions, 8 at least.

    Shuffle partitions are sized by the cores of the cluster, so that writing keeps up with the state.
    """
    return options.files_per_batch or max(8, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8)


def watermark_of(query: StreamingQuery, delay: str, groups: int = 1) -> Column | None:
    """The watermark after the newest finished micro-batch, as an instant; None before the first.

    A progress report names the watermark its batch began with. The one it
    leaves behind is the newest event time it saw minus ``delay``. Of several
    groups a report shows the times of one alone: there the watermark that the
    newest batch began with is taken, which no group is behind.
    """
    times = [p.eventTime for p in query.recentProgress if "watermark" in p.eventTime]
    if not times:
        return None
    began = F.lit(max(t["watermark"] for t in times)).cast("timestamp")
    seen = [t["max"] for t in times if "max" in t]
    if not seen or groups > 1:
        return began
    return F.greatest(began, F.lit(max(seen)).cast("timestamp") - F.expr(f"INTERVAL {delay}"))


class LateRows:
    """A running count of the late rows that the state of a query dropped.

    A query keeps only its newest reports; ``poll`` adds those not yet seen, so
    the count is complete if it is called at least once within as many
    micro-batches as the query keeps reports of. If reports were lost in
    between, ``complete`` is False. Rows reach the state after the map-side
    reduction, so several late readings of one key may count as one.
    """

    def __init__(self, query: StreamingQuery):
        self.query, self.total, self.complete = query, 0, True
        self.by_batch: dict[int, int] = {}  # of batches that ``forget`` has not named
        self._seen: tuple[int, int] | None = None  # the newest batch counted, and what was counted of it

    def poll(self) -> int:
        dropped = self.by_batch
        for report in self.query.recentProgress:
            rows = sum(op.numRowsDroppedByWatermark for op in report.stateOperators)
            dropped[report.batchId] = max(dropped.get(report.batchId, 0), rows)
        for batch in sorted(b for b in dropped if self._seen is None or b >= self._seen[0]):
            if self._seen is None or batch > self._seen[0]:
                if self._seen is not None and batch > self._seen[0] + 1:
                    self.complete = False
                self.total += dropped[batch]
                self._seen = batch, dropped[batch]
            elif batch == self._seen[0]:
                self.total += max(0, dropped[batch] - self._seen[1])
                self._seen = batch, max(dropped[batch], self._seen[1])
        return self.total


    def forget(self, before: int) -> None:
        """Keep no counts of single batches before one."""
        self.by_batch = {b: n for b, n in self.by_batch.items() if b >= before}


def dropped_late(query: StreamingQuery) -> int:
    """Late rows dropped by the state of a query that has reported seldom enough to keep all its reports.

    Beyond that the count would be cut short, so it is refused; ``LateRows`` keeps one.
    """
    kept = int(query._jsq.sparkSession().conf().get("spark.sql.streaming.numRecentProgressUpdates"))
    if len(query.recentProgress) >= kept - 1:  # the oldest report goes when the last place is filled
        raise RuntimeError("only the newest reports are kept; count with LateRows while the query runs")
    return LateRows(query).poll()


def commit_while_running(
    query: StreamingQuery,
    commit: Callable[[Column], object],
    delay: str,
    interval_seconds: int = 90,
    beside: StreamingQuery | None = None,
    late: LateRows | None = None,
    attempts: int = 5,
    groups: int = 1,
) -> None:
    """Call ``commit`` with the watermark at every interval until the query ends, and once after.

    A commit that fails is tried again at the next interval, as it may be
    repeated; after ``attempts`` failures in a row, or a failure of the query or
    of the one that runs beside it, both are stopped and the failure is raised.
    ``late`` is polled on the way; ``groups`` is the number of groups of sources that the query reads.
    """
    running, failures = True, 0
    try:
        while running:
            running = not query.awaitTermination(interval_seconds)
            if beside is not None and beside.exception() is not None:
                raise beside.exception()
            if late is not None:
                late.poll()
            watermark = watermark_of(query, delay, groups)
            if watermark is None:
                continue
            try:
                commit(watermark)
                failures = 0
            except Exception:
                failures += 1
                if failures >= attempts or not running:
                    raise
    except BaseException:
        for other in (query, beside):
            if other is not None:
                other.stop()
        raise


def preview_stream(messages: DataFrame, name: str, rows: int = 2) -> DataFrame:
    """The first rows of a stream as an in-memory table; the limit bounds what the driver holds."""
    query = (
        messages.limit(rows)
        .writeStream.outputMode("append")
        .format("memory")
        .queryName(name)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return messages.sparkSession.table(name)
