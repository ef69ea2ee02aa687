import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quarterbell.session import configure


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    home = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[*]")
        .appName("quarterbell-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(home / "warehouse"))
        .config("spark.checkpoint.dir", str(home / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(params=["UTC", "America/New_York", "Asia/Shanghai"])
def any_zone(request, spark):
    spark.conf.set("spark.sql.session.timeZone", request.param)
    yield request.param
    spark.conf.set("spark.sql.session.timeZone", "UTC")


READING = "seq BIGINT, source_partition INT, measurepointid STRING, measuretag STRING, value DOUBLE, sampletime STRING"


@pytest.fixture
def make_readings(spark):
    """Rows of (key, value, time), numbered in the order given."""

    def make(rows, source_partition=0):
        numbered = [
            (at, source_partition, key, "t", float(value), time)
            for at, (key, value, time) in enumerate(rows)
        ]
        return spark.createDataFrame(numbered, READING)

    return make


def hours_due(rows):
    """The hourly partitions due by the newest of the rows, worked out in plain Python."""
    from datetime import datetime, timedelta

    found = rows.select("dt", "hr", "sampletime").collect()
    watermark = datetime.fromisoformat(max(r.sampletime for r in found)) - timedelta(minutes=3)
    due = lambda r: datetime.fromisoformat(f"{r.dt} {r.hr}:00:00") + timedelta(minutes=15) < watermark
    return {f"dt={r.dt}/hr={r.hr}" for r in found if due(r)}
