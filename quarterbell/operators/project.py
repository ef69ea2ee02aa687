"""Readings to table columns, and the partition columns of the tables."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterbell.functions import day_of, hour_of, run_date
from quarterbell.schema import VALUE_TYPE


def table_columns(readings: DataFrame, *keep: str | Column) -> DataFrame:
    """Rename and type the four table columns, followed by ``keep``.

    A value beyond DECIMAL(30,8) becomes null instead of stopping the job.
    """
    return readings.select(
        "measurepointid",
        "measuretag",
        F.col("value").try_cast(VALUE_TYPE).alias("value1"),
        "sampletime",
        *keep,
    )


def with_run_date(rows: DataFrame, run_millis: int | None = None) -> DataFrame:
    """One ``daytime`` for the whole run: the day it started, by default now."""
    if run_millis is None:
        run_millis = int(time.time() * 1000)
    return rows.withColumn("daytime", run_date(run_millis))


def with_day(rows: DataFrame) -> DataFrame:
    """``daytime`` from the printed sample time of each row."""
    return rows.withColumn("daytime", F.substring_index("sampletime", " ", 1))


def with_hour(rows: DataFrame, column: str = "ts") -> DataFrame:
    """``dt`` and ``hr`` from an instant."""
    instant = F.col(column)
    return rows.withColumn("dt", day_of(instant)).withColumn("hr", hour_of(instant))
