"""Every registered query against its SQL, on the whole of the smallest tables."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver
from checks import oracles
from checks import queries as registered

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def test_each_query_has_its_sql():
    assert registered.queries().keys() == oracles.oracle_sql().keys()
    assert registered.queries().keys() <= driver.queries().keys() and driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", list(registered.queries()))
def test_query_equals_sql(spark, database, name):
    frame = driver.queries()[name](spark, SF)
    columns = sorted(frame.columns)
    found = Counter(tuple(row[c] for c in columns) for row in frame.collect())
    cursor = database.execute(driver.oracle_sql()[name])
    given = [d[0] for d in cursor.description]
    assert sorted(given) == columns
    order = [given.index(c) for c in columns]
    expected = Counter(tuple(row[i] for i in order) for row in cursor.fetchall())
    assert found == expected and found


# Those that touch wall-clock times outside a plain projection.
@pytest.mark.parametrize("name", [
    "time_neat_messages", "time_neat_on_time", "late_audit", "hourly_sql", "window_assign",
    "committable_partitions", "table_decode_nulls", "latest_per_window", "stream_time_neat", "time_neat_ties",
    "stream_hourly_sql", "committed_daily",
])
def test_no_result_depends_on_the_session_zone(spark, database, name):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        test_query_equals_sql(spark, database, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_entry(spark):
    assert driver.entry(spark).columns == ["measurepointid", "measuretag", "value1", "sampletime"]
