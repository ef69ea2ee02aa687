import random
from datetime import datetime, timedelta

import pytest

from quarterbell.operators import late_readings, on_time_readings, with_event_time
from quarterbell.schema import seconds_of
from tests.conftest import READING


def brute_force(rows, length, delay):
    newest, late = {}, set()
    for seq, part, second in rows:
        end = second // length * length + length
        if part in newest and newest[part] - delay >= end:
            late.add((part, seq))
        newest[part] = max(newest.get(part, second), second)
    return late


@pytest.mark.parametrize("length, delay", [(900, 120), (900, 0), (900, 2000), (3600, 900)])
def test_against_brute_force(spark, length, delay):
    rng = random.Random(length + delay)
    rows, clock = [], 0
    for seq in range(4000):
        clock += rng.randrange(0, 30)
        part = 0 if rng.random() < 0.4 else rng.randrange(1, 5)
        second = clock - rng.choice([0, 0, 0, 60, 900, 1800, 7200]) + rng.randrange(0, 60)
        rows.append((seq, part, max(second, 0)))
    data = [
        (seq, part, "a", "t", 1.0, f"2024-01-{1 + s // 86400:02} {s // 3600 % 24:02}:{s // 60 % 60:02}:{s % 60:02}")
        for seq, part, s in rows
    ]
    stamped = with_event_time(spark.createDataFrame(data, READING).repartition(6))
    expected = brute_force(rows, length, delay)
    durations = f"{length} seconds", f"{delay} seconds"
    late = {(r.source_partition, r.seq) for r in late_readings(stamped, *durations).collect()}
    kept = {(r.source_partition, r.seq) for r in on_time_readings(stamped, *durations).collect()}
    assert expected and late == expected
    assert kept == {(part, seq) for seq, part, _ in rows} - expected


def test_wild_times_against_brute_force(spark):
    """Times spread over centuries fall into many blocks of windows."""
    rng = random.Random(11)
    base = datetime(2024, 1, 1)
    rows, clock = [], 0
    for seq in range(3000):
        clock += rng.randrange(0, 40000)
        jump = rng.choice([0, 0, 0, -900, -86400, -40 * 86400, -400 * 86400, -(10 ** 10)])
        rows.append((seq, seq % 3, clock + jump if rng.random() < 0.97 else clock - rng.randrange(6 * 10 ** 10)))
    data = [(seq, part, "a", "t", 1.0, str(base + timedelta(seconds=s))) for seq, part, s in rows]
    stamped = with_event_time(spark.createDataFrame(data, READING).repartition(6))
    expected = brute_force(rows, 900, 120)
    late = {(r.source_partition, r.seq) for r in late_readings(stamped).collect()}
    assert late == expected and len(rows) > len(expected) > 100


def test_the_reading_that_reaches_the_end_is_itself_on_time(spark):
    times = ["00:14:59", "00:16:59", "00:14:59", "00:17:00", "00:14:59", "00:15:00"]
    data = [(at, 0, "a", "t", 1.0, "2024-01-01 " + time) for at, time in enumerate(times)]
    stamped = with_event_time(spark.createDataFrame(data, READING))
    assert {r.seq for r in late_readings(stamped).collect()} == {4}


def test_columns_are_kept(spark):
    stamped = with_event_time(spark.createDataFrame([], READING))
    assert late_readings(stamped).columns == stamped.columns == on_time_readings(stamped).columns


@pytest.mark.parametrize("text, seconds", [("15 minutes", 900), ("1 minute", 60), ("2 hours", 7200), ("1 day", 86400), ("1 hour 30 minutes", 5400)])
def test_durations(text, seconds):
    assert seconds_of(text) == seconds
