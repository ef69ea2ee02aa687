"""Partition commit: make a time partition known once its time has passed.

The decision is a DataFrame: partitions whose time plus a delay lies before
the watermark. The effect (catalog entry, ``_SUCCESS`` file) works on that
list, which has one row per table partition and never holds readings. A small
ledger remembers what was committed, so that repeating the step changes nothing
and a partition that received newer files is committed again.

Beside the ledger lies a list of the partitions seen in the log of the stream and the batch up to which it
was read. A step reads the log from there, so it costs what is new and not
what the table holds; only a folder without such a log is listed.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterbell.sinks.sinklog import files_since
from quarterbell.sinks.tables import has_stream_log

_STATEMENT_SIZE = 500
_MARKERS_AT_ONCE = 16
_PAGE = 10_000


@dataclass(frozen=True)
class CommitRule:
    """When a partition is due and what happens to it then.

    ``pattern`` puts the time of a partition together from its columns; it is
    due once the watermark has passed that time by more than ``delay_seconds``.
    """

    partitions: tuple[str, ...]
    pattern: str
    delay_seconds: int
    policies: tuple[str, ...]


# The rules of the hourly and the daily table.
HOURLY_COMMIT = CommitRule(("dt", "hr"), "$dt $hr:00:00", 15 * 60, ("metastore", "success-file"))
DAILY_COMMIT = CommitRule(("daytime",), "$daytime", 0, ("metastore",))


def partition_time(pattern: str) -> Column:
    """The instant a partition stands for, from a pattern such as ``$dt $hr:00:00``."""
    pieces = [
        F.col(piece[1:]) if piece.startswith("$") else F.lit(piece)
        for piece in re.split(r"(\$\w+)", pattern)
        if piece
    ]
    text = F.concat(*pieces)
    full = F.when(F.length(text) == 10, F.concat(text, F.lit(" 00:00:00"))).otherwise(text)
    return F.concat(full, F.lit("Z")).try_cast("timestamp")


def committable_partitions(parts: DataFrame, watermark: Column, rule: CommitRule = HOURLY_COMMIT) -> DataFrame:
    """The partitions whose time plus delay the watermark (an instant) has passed."""
    due = F.unix_millis(partition_time(rule.pattern)) + rule.delay_seconds * 1000
    return parts.where(F.unix_millis(watermark) > due)


def written_partitions(spark: SparkSession, path: str, partitions: tuple[str, ...]) -> DataFrame:
    """Partitions of a folder with the time of their newest file in milliseconds.

    Lists files and opens none, so the step costs one row per file however
    many readings they hold. Files of a batch that a stream has not finished
    are not seen, because its log is honoured.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .load(path)
    )
    return _newest_files(files.select("path", F.unix_millis("modificationTime").alias("written_at")), partitions)


def _newest_files(files: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Partitions of files with the time of the newest of each."""
    return with_partitions(files, partitions).groupBy(*partitions).agg(F.max("written_at").alias("written_at"))


def with_partitions(files: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Files with the partition that each one lies in."""
    return files.withColumns({name: F.regexp_extract("path", f"/{name}=([^/]*)/", 1) for name in partitions})


def seen_partitions(spark: SparkSession, path: str, seen: str, partitions: tuple[str, ...]) -> DataFrame:
    """The same of a folder that a stream writes to, from its log.

    ``seen`` keeps what was found before, and in a row without a partition the newest batch read. A step
    that dies after writing to it has lost nothing, one that dies before reads the same batches again.
    """
    schema = T.StructType([*ledger_schema(partitions).fields, T.StructField("batch", T.LongType())])
    known = read_or_empty(spark, seen, schema)
    batch = known.agg(F.max("batch")).head()[0]
    files, newest = files_since(spark, path, -1 if batch is None else batch)
    if files is not None:
        marker = spark.createDataFrame([(*[None] * len(partitions), None, newest)], schema)
        found = _newest_files(files, partitions).withColumn("batch", F.lit(newest).cast("long"))
        found.unionByName(marker).write.mode("append").parquet(seen)
        known = read_or_empty(spark, seen, schema)
    return known.where(F.col("written_at").isNotNull()).groupBy(*partitions).agg(F.max("written_at").alias("written_at"))


def ledger_schema(partitions: tuple[str, ...]) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in partitions]
    return T.StructType(fields + [T.StructField("written_at", T.LongType())])


def _ledger(spark: SparkSession, path: str, partitions: tuple[str, ...]) -> DataFrame:
    """The ledger written so far."""
    return read_or_empty(spark, path, ledger_schema(partitions))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A folder that does not exist yet is an empty one."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def pending_partitions(written: DataFrame, ledger: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Partitions never committed, or written to since."""
    done = ledger.groupBy(*partitions).agg(F.max("written_at").alias("committed_at"))
    return (
        written.join(done, list(partitions), "left")
        .where("committed_at IS NULL OR written_at > committed_at")
        .drop("committed_at")
    )


def carry_out(spark: SparkSession, table: str, path: str, parts: list, rule: CommitRule) -> None:
    """Apply the policies to a list of partitions; doing so again changes nothing."""
    specs = [{name: row[name] for name in rule.partitions} for row in parts]
    if "metastore" in rule.policies:
        for at in range(0, len(specs), _STATEMENT_SIZE):
            clauses = " ".join(
                "PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in spec.items()) + ")"
                for spec in specs[at:at + _STATEMENT_SIZE]
            )
            spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {clauses}")
    if "success-file" in rule.policies:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        conf = spark.sparkContext._jsc.hadoopConfiguration()

        def mark(spec: dict[str, str]) -> None:
            folder = "/".join([path] + [f"{k}={v}" for k, v in spec.items()])
            marker = hadoop(f"{folder}/_SUCCESS")
            marker.getFileSystem(conf).create(marker, True).close()

        with ThreadPoolExecutor(_MARKERS_AT_ONCE) as pool:
            list(pool.map(mark, specs))


def commit_pages(
    spark: SparkSession,
    table: str,
    path: str,
    ledger: str,
    watermark: Column,
    rule: CommitRule = HOURLY_COMMIT,
    log: str | None = None,
) -> Iterator[list]:
    """Commit what is due in pages, each given out when it is done: one row per partition, never readings.

    Only one page is on the driver at a time, however many partitions wild
    times make. The effects of a page come before its ledger entry, so a step
    that dies half-way is simply done again. ``log`` is the folder that the stream
    writes to, if ``path`` lies below it.
    """
    log = path if log is None else log
    if has_stream_log(spark, log):
        written = seen_partitions(spark, log, f"{ledger}-seen", rule.partitions)
    else:
        written = written_partitions(spark, path, rule.partitions)
    pending = pending_partitions(written, _ledger(spark, ledger, rule.partitions), rule.partitions)
    due = committable_partitions(pending, watermark, rule).sort(*rule.partitions).toLocalIterator()
    while page := list(itertools.islice(due, _PAGE)):
        carry_out(spark, table, path, page, rule)
        entries = spark.createDataFrame(page, ledger_schema(rule.partitions))
        entries.coalesce(1).write.mode("append").parquet(ledger)
        yield page


def commit_pending(
    spark: SparkSession,
    table: str,
    path: str,
    ledger: str,
    watermark: Column,
    rule: CommitRule = HOURLY_COMMIT,
    log: str | None = None,
) -> list:
    """Commit what is due and return it all; see ``commit_pages`` for many partitions."""
    return [row for page in commit_pages(spark, table, path, ledger, watermark, rule, log) for row in page]
