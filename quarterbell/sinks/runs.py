"""Replays that add up: each named run has its rows once, however often it is repeated.

Every attempt of a run writes into folders of its own. One ledger entry, made
when all of it is written, says which attempt of the run counts; that is the
moment at which its rows and its quarantine take the place of those of the attempt before.
An attempt that dies leaves folders that nobody reads.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbell.schema import table_schema
from quarterbell.sinks.commit import read_or_empty, written_partitions
from quarterbell.sinks.tables import create_table, point_partitions

_REJECTED = "source_partition INT, seq BIGINT, raw STRING, reason STRING"
_LEDGER = "run STRING, attempt STRING, number BIGINT"
_NAME = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")
_PAGE = 1_000


def new_attempt(run: str) -> str:
    """The name of a new attempt of a run."""
    if not _NAME.fullmatch(run):
        raise ValueError(f"a run is named by letters, digits, dots, dashes and underscores, not {run!r}")
    return uuid.uuid4().hex


def attempt_folder(folder: str, run: str, attempt: str, kind: str = "rows") -> str:
    """Where an attempt writes its rows or, with ``kind="quarantine"``, its quarantine."""
    return f"{folder}/runs/{kind}/run={run}/attempt={attempt}"


def register_attempt(spark: SparkSession, folder: str, run: str, attempt: str) -> None:
    """From now on the attempt is what its run has written."""
    before = _ledger(spark, folder).where(F.col("run") == run).agg(F.max("number")).head()[0]
    entry = spark.createDataFrame([(run, attempt, 1 if before is None else before + 1)], _LEDGER)
    entry.coalesce(1).write.mode("append").parquet(f"{folder}/run-ledger")


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    return read_or_empty(spark, f"{folder}/run-ledger", spark.createDataFrame([], _LEDGER).schema)


def attempts_that_count(spark: SparkSession, folder: str) -> dict[str, str]:
    """For each run its newest finished attempt: one entry for each name that a user gave."""
    newest = _ledger(spark, folder).groupBy("run").agg(F.max(F.struct("number", "attempt")).alias("newest"))
    return {r.run: r.newest.attempt for r in newest.sort("run").toLocalIterator()}


def read_runs(spark: SparkSession, folder: str, partitions: tuple[str, ...] = (), kind: str = "rows") -> DataFrame:
    """The rows (or, with ``kind="quarantine"``, the quarantined records) of all runs together."""
    folders = [attempt_folder(folder, run, attempt, kind) for run, attempt in attempts_that_count(spark, folder).items()]
    if not folders:
        return spark.createDataFrame([], table_schema(partitions) if kind == "rows" else _REJECTED)
    reader = spark.read.option("basePath", f"{folder}/runs/{kind}")
    reader = reader.schema(table_schema(partitions)) if kind == "rows" else reader
    return reader.parquet(*folders).drop("run", "attempt")


def point_run(spark: SparkSession, table: str, folder: str, run: str, partitions: tuple[str, ...]) -> None:
    """Make the attempt that counts the partitions of its run in a table by ``run`` and the partitions of the job.

    Partitions that only an earlier attempt had are dropped from the table. Doing so again changes nothing.
    """
    rows = attempt_folder(folder, run, attempts_that_count(spark, folder)[run])
    create_table(spark, table, ("run", *partitions), f"{folder}/runs")
    if not partitions:
        point_partitions(spark, table, rows, [{"run": run}], ())
        return
    written = written_partitions(spark, rows, partitions).select(*partitions)
    page: list[dict[str, str]] = []
    for row in written.sort(*partitions).toLocalIterator():
        page.append({"run": run, **row.asDict()})
        if len(page) == _PAGE:
            point_partitions(spark, table, rows, page, partitions)
            page = []
    point_partitions(spark, table, rows, page, partitions)
    listed = spark.sql(f"SHOW PARTITIONS {table} PARTITION (run='{run}')")
    names = [F.regexp_extract("partition", f"(?:^|/){name}=([^/]*)", 1).alias(name) for name in partitions]
    for row in listed.select(*names).join(written, list(partitions), "left_anti").toLocalIterator():
        spec = ", ".join(f"{k}='{v}'" for k, v in {"run": run, **row.asDict()}.items())
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
