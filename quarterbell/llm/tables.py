"""Reading tables, and cutting lineage through the shared folder."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbell.session import new_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(rows: DataFrame, name: str) -> DataFrame:
    """The rows, written to the folder that all executors share and read again."""
    spark = rows.sparkSession
    path = new_folder(spark, name)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Spark drops the shuffles of a query once its rows are written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, kept)


def document_key(doc_id: Column, text: Column) -> Column:
    """An order key and identity of a document: its id; without an id one of its text, after all ids below 2^62."""
    return F.coalesce(doc_id.cast("long"), F.lit(2**62) + F.shiftrightunsigned(F.xxhash64(text), 2))
