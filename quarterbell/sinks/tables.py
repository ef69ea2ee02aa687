"""Parquet tables of readings: definition, append and read-back."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from quarterbell.schema import table_schema

_STATEMENTS_AT_ONCE = 16


def use_database(spark: SparkSession, name: str) -> None:
    """Create the database if it is missing and make it current."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.catalog.setCurrentDatabase(name)


def list_tables(spark: SparkSession) -> list[str]:
    """Names of the tables and views of the current database."""
    return [table.name for table in spark.catalog.listTables()]


def create_table(
    spark: SparkSession,
    name: str,
    partitions: tuple[str, ...] = (),
    location: str | None = None,
) -> None:
    """``CREATE TABLE IF NOT EXISTS`` with the four columns and text partitions."""
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in table_schema(partitions))
    ddl = f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet"
    if partitions:
        ddl += f" PARTITIONED BY ({', '.join(partitions)})"
    if location is not None:
        ddl += f" LOCATION '{location}'"
    spark.sql(ddl)


def spread(rows: DataFrame, partitions: tuple[str, ...]) -> DataFrame:
    """Bring the rows of a table partition together in tasks of an even size.

    ``REBALANCE`` hashes by the partition columns, after which the adaptive
    planner merges small partitions and splits large ones (a third of all rows
    may belong to one hour), so neither small files nor a giant task result.
    """
    return rows.hint("rebalance", *partitions)


def append_files(
    rows: DataFrame,
    path: str,
    partitions: tuple[str, ...] = (),
    rebalance: bool = True,
    mode: str = "append",
) -> None:
    """Append a batch to a parquet folder, or with ``mode="overwrite"`` put it in place of the partitions it touches.

    Input already ordered by time touches few partitions per task; then
    ``rebalance=False`` writes it without a shuffle, as is always done for a
    table without partitions.
    """
    rows = spread(rows, partitions) if rebalance and partitions else rows
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def append_table(
    rows: DataFrame,
    name: str,
    partitions: tuple[str, ...] = (),
    rebalance: bool = True,
) -> None:
    """Append a batch to a table of the catalog; columns are matched by name."""
    rows = spread(rows, partitions) if rebalance and partitions else rows
    rows.write.mode("append").format("parquet").partitionBy(*partitions).saveAsTable(name)


def read_files(spark: SparkSession, path: str, partitions: tuple[str, ...] = ()) -> DataFrame:
    """Read a folder back. The schema is given: inference would turn ``hr`` 00 into 0."""
    return spark.read.schema(table_schema(partitions)).parquet(path)


def point_partitions(
    spark: SparkSession,
    table: str,
    root: str,
    specs: list[dict[str, str]],
    below: tuple[str, ...] | None = None,
) -> None:
    """Let partitions of a table be read from their folders below ``root``; doing so again changes nothing.

    ``below`` are the partition columns that make the folders (default: all of a spec).
    """
    if not specs:
        return
    texts = []
    for spec in specs:
        folder = "/".join([root] + [f"{name}={spec[name]}" for name in (spec if below is None else below)])
        texts.append(("PARTITION (" + ", ".join(f"{k}='{v}'" for k, v in spec.items()) + ")", f"LOCATION '{folder}'"))
    every = " ".join(f"{spec} {place}" for spec, place in texts)
    try:
        spark.sql(f"ALTER TABLE {table} ADD {every}")
    except AnalysisException as error:
        if error.getCondition() != "PARTITIONS_ALREADY_EXIST":
            raise
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {every}")
        # those that were there have kept their place; a statement takes one, so many run at a time
        with ThreadPoolExecutor(_STATEMENTS_AT_ONCE) as pool:
            list(pool.map(lambda text: spark.sql(f"ALTER TABLE {table} {text[0]} SET {text[1]}"), texts))
    spark.catalog.refreshTable(table)


def has_stream_log(spark: SparkSession, path: str) -> bool:
    """Whether a stream writes to the folder."""
    log = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_spark_metadata")
    return log.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(log)
