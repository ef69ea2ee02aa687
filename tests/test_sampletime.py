from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from quarterbell.functions import (
    SENTINEL_MILLIS,
    day_of,
    event_time,
    hour_of,
    is_present,
    is_valid_sample_time,
    run_date,
    table_time,
    time_text,
)
from quarterbell.operators import with_run_date

VALID = {
    "2024-02-29 00:00:00": "2024-02-29 00:00:00",
    "2000-02-29 00:00:00": "2000-02-29 00:00:00",
    "0004-02-29 00:00:00": "0004-02-29 00:00:00",
    "0001-01-01 00:00:00": "0001-01-01 00:00:00",
    "9999-12-31 23:59:59": "9999-12-31 23:59:59",
    "2024-01-01 9:05:00": "2024-01-01 09:05:00",
    "2024-01-01   09:05:00": "2024-01-01 09:05:00",
    "2024-01-01\t09:05:00": "2024-01-01 09:05:00",
    "2024-03-10 02:30:00": "2024-03-10 02:30:00",
    "2024-11-03 01:30:00": "2024-11-03 01:30:00",
}
INVALID = [
    "2023-02-29 00:00:00",
    "1900-02-29 00:00:00",
    "1600-02-29 00:00:00",
    "0000-01-01 00:00:00",
    "2024-01-01 24:00:00",
    "2024-01-01 00:00:00.5",
    "2024-1-1 00:00:00",
    "2024-01-01 00:00:00\n",
    "2024-04-31 00:00:00",
    " 2024-01-01 00:00:00",
    "2024-01-01T00:00:00",
    "",
    "abc",
]



def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "t STRING")


def test_valid_texts_round_trip_in_every_zone(spark, any_zone):
    rows = texts(spark, VALID).select(
        "t", is_valid_sample_time(F.col("t")).alias("ok"), time_text(event_time(F.col("t"))).alias("printed"),
    ).collect()
    assert all(r.ok for r in rows)
    assert {r.t: r.printed for r in rows} == VALID


def test_invalid_texts_become_the_sentinel(spark, any_zone):
    rows = texts(spark, INVALID + [None]).select(
        "t", is_valid_sample_time(F.col("t")).alias("ok"), F.unix_millis(event_time(F.col("t"))).alias("ms"),
    ).collect()
    assert all(not r.ok for r in rows)
    assert {r.ok for r in rows if r.t is None} == {None}
    assert {r.ms for r in rows} == {SENTINEL_MILLIS}


def test_sentinel_prints_as_the_afternoon_of_the_first_day(spark, any_zone):
    printed = texts(spark, [""]).select(time_text(event_time(F.col("t")))).head()[0]
    assert printed == "1970-01-01 16:00:00"


def test_present(spark):
    rows = texts(spark, [None, "", " ", "x"]).select(is_present(F.col("t")).alias("p")).collect()
    assert [r.p for r in rows] == [False, False, True, True]


@pytest.mark.parametrize("text", ["2024-03-10 02:30:00", "0004-02-29 07:00:00", "1969-12-31 23:59:59", "9999-12-31 23:59:59"])
def test_partition_texts(spark, any_zone, text):
    row = texts(spark, [text]).select(day_of(event_time(F.col("t"))), hour_of(event_time(F.col("t")))).head()
    assert (row[0], row[1]) == (text[:10], text[11:13])


def test_table_time_is_null_where_unreadable(spark, any_zone):
    good = ["2024-03-10 02:30:00", "1600-02-29 00:00:00", "2024-01-01 00:00:00.5"]
    bad = [
        "2023-02-29 00:00:00", "2024-01-01 24:00:00", "12:30:00", "T12:30:00", "2024", "2024-01-01", "2024-1-1 00:00:00",
        "2024-01-01 00:00:00\n", "2024-01-01T00:00:00", "2024-01-01 00:00:00+08:00", "", None,
    ]
    rows = texts(spark, good + bad).select(time_text(table_time(F.col("t"))).alias("p")).collect()
    assert [r.p for r in rows] == [text[:19] for text in good] + [None] * len(bad)


def test_run_date_takes_milliseconds(spark, any_zone):
    assert spark.range(1).select(run_date(1610000000000)).head()[0] == "2021-01-07"


def test_a_run_without_a_start_is_dated_today(spark):
    before = datetime.now(timezone.utc).date()
    row = with_run_date(spark.range(1)).head()
    assert row.daytime in {str(before), str(datetime.now(timezone.utc).date())}
