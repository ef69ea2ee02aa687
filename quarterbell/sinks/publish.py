"""Publish the partitions of a stream as few files, each partition swapped in whole.

A stream writes some files into a partition with every micro-batch, hundreds a
day. Once a partition is due (see ``commit``), its finished files are read, by
the log of the stream, and written again as few files of an even size into a
folder that nobody reads yet, a *generation*; then the catalog is told to look
there. Readers of the table see a partition whole or not at all, and never the
remains of a batch that died.

A partition that received newer files is due again and gets a new generation.
The order is write, swap, ledger: a step that dies in between is simply done
again. Old generations stay until ``drop_superseded`` removes those that have
been out of use long enough for every reader to be done.
"""

from __future__ import annotations

import itertools
import time
import uuid
from collections.abc import Iterator
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterbell.schema import table_schema
from quarterbell.sinks.commit import (
    HOURLY_COMMIT,
    CommitRule,
    committable_partitions,
    ledger_schema,
    pending_partitions,
    read_or_empty,
    seen_partitions,
    with_partitions,
)
from quarterbell.sinks.sinklog import files_since
from quarterbell.sinks.tables import append_files, create_table, point_partitions

#: Partitions that one generation holds at most, and that are on the driver at a time.
PAGE = 1_000


def _published_schema(partitions: tuple[str, ...]) -> T.StructType:
    more = [T.StructField("generation", T.StringType()), T.StructField("published_at", T.LongType())]
    return T.StructType([*ledger_schema(partitions).fields, *more])


def published(spark: SparkSession, folder: str, partitions: tuple[str, ...]) -> DataFrame:
    """The ledger: each time a partition was published, and the generation that holds it."""
    return read_or_empty(spark, f"{folder}/ledger", _published_schema(partitions))


def finished_files(spark: SparkSession, log: str, parts: DataFrame, partitions: tuple[str, ...]) -> list[str]:
    """Files of some partitions that the stream has finished, of a page at a time."""
    files, _ = files_since(spark, log, -1)
    if files is None:
        return []
    found = with_partitions(files, partitions).join(F.broadcast(parts.select(*partitions)), list(partitions), "left_semi")
    return [unquote(r.path) for r in found.select("path").distinct().toLocalIterator()]


def publish_pages(
    spark: SparkSession,
    table: str,
    path: str,
    folder: str,
    watermark: Column,
    rule: CommitRule = HOURLY_COMMIT,
    log: str | None = None,
) -> Iterator[list]:
    """Publish what is due, in pages of one generation each, given out when they are done.

    ``path`` is where the stream writes the rows, ``log`` the folder of its log if ``path`` lies below
    it, ``folder`` where the generations and their ledger go. ``table`` is made if it is missing.
    """
    log = path if log is None else log
    create_table(spark, table, rule.partitions, folder)
    written = seen_partitions(spark, log, f"{folder}/ledger-seen", rule.partitions)
    pending = pending_partitions(written, published(spark, folder, rule.partitions), rule.partitions)
    due = committable_partitions(pending, watermark, rule).select(*rule.partitions, "written_at")
    due = due.sort(*rule.partitions).toLocalIterator()
    while page := list(itertools.islice(due, PAGE)):
        parts = spark.createDataFrame(page, ledger_schema(rule.partitions))
        generation = f"generation-{uuid.uuid4().hex}"
        files = finished_files(spark, log, parts, rule.partitions)
        rows = spark.read.schema(table_schema(rule.partitions)).option("basePath", path).parquet(*files)
        append_files(rows, f"{folder}/{generation}", rule.partitions)
        point_partitions(spark, table, f"{folder}/{generation}", [{name: row[name] for name in rule.partitions} for row in page])
        now = F.lit(int(time.time() * 1000)).cast("long")
        entries = parts.withColumns({"generation": F.lit(generation), "published_at": now})
        entries.coalesce(1).write.mode("append").parquet(f"{folder}/ledger")
        yield page


def publish_pending(
    spark: SparkSession,
    table: str,
    path: str,
    folder: str,
    watermark: Column,
    rule: CommitRule = HOURLY_COMMIT,
    log: str | None = None,
) -> list:
    """Publish what is due and return it all; see ``publish_pages`` for many partitions."""
    return [row for page in publish_pages(spark, table, path, folder, watermark, rule, log) for row in page]


def drop_superseded(spark: SparkSession, folder: str, partitions: tuple[str, ...], older_than_seconds: int = 86_400) -> int:
    """Remove what has been out of use for so long, and return how many folders went.

    That is a partition of a generation once a later one holds it, and a whole
    generation that no ledger entry names, left by a step that died.
    """
    limit = int((time.time() - older_than_seconds) * 1000)
    ledger = published(spark, folder, partitions)
    later = F.lead("published_at").over(Window.partitionBy(*partitions).orderBy("published_at", "generation"))
    out_of_use = ledger.withColumn("replaced_at", later).where(F.col("replaced_at") <= limit)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    root = hadoop(folder)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    removed = 0
    for row in out_of_use.select("generation", *partitions).toLocalIterator():
        old = hadoop("/".join([folder, row.generation] + [f"{name}={row[name]}" for name in partitions]))
        removed += bool(system.delete(old, True))
    if not system.exists(root):
        return removed
    named = {r.generation for r in ledger.select("generation").distinct().toLocalIterator()}
    for status in system.listStatus(root):
        name = status.getPath().getName()
        if name.startswith("generation-") and name not in named and status.getModificationTime() <= limit:
            removed += bool(system.delete(status.getPath(), True))
    return removed
