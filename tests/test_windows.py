import random

import pytest
from pyspark.sql import functions as F

from quarterbell.operators import in_windows, newest_per_window, time_neat, with_event_time
from quarterbell.sources.messages import kafka_arrival

DAY = "2024-01-01 "


def neat(readings, **kwargs):
    return sorted((r.measurepointid, r.value, r.sampletime) for r in time_neat(with_event_time(readings), **kwargs).collect())


@pytest.mark.parametrize("time, snapped", [
    ("00:00:00", "00:00:00"),
    ("00:07:30", "00:00:00"),
    ("00:07:31", "00:15:00"),
    ("00:14:59", "00:15:00"),
    ("9:05:00", "09:00:00"),
    ("23:59:59", None),
])
def test_snap(make_readings, any_zone, time, snapped):
    expected = DAY + snapped if snapped else "2024-01-02 00:00:00"
    assert neat(make_readings([("a", 1, DAY + time)])) == [("a", 1.0, expected)]


@pytest.mark.parametrize("time, snapped", [
    ("0001-01-01 00:07:31", "0001-01-01 00:15:00"),
    ("1969-12-31 23:52:30", "1969-12-31 23:45:00"),
    ("1969-12-31 23:52:31", "1970-01-01 00:00:00"),
    ("9999-12-31 23:59:59", "10000-01-01 00:00:00"),
])
def test_snap_far_from_the_epoch(make_readings, any_zone, time, snapped):
    assert neat(make_readings([("a", 1, time)])) == [("a", 1.0, snapped)]


@pytest.mark.parametrize("bad", ["", None, "2024-02-30 00:00:00", "abc"])
def test_unusable_times_meet_in_the_sentinel_window_first_come(make_readings, bad):
    rows = make_readings([("a", 1, bad), ("a", 2, ""), ("a", 3, DAY + "00:01:00")])
    assert neat(rows) == [("a", 1.0, "1970-01-01 16:00:00"), ("a", 3.0, DAY + "00:00:00")]


def test_newest_wins_and_first_arrival_breaks_ties(make_readings):
    rows = make_readings([
        ("a", 1, DAY + "00:01:00"), ("a", 2, DAY + "00:14:00"), ("a", 3, DAY + "00:14:00"), ("a", 4, DAY + "00:02:00"),
    ]).repartition(4, "value")
    assert neat(rows) == [("a", 2.0, DAY + "00:15:00")]
    assert neat(rows, arrival_bound=1 << 53) == [("a", 2.0, DAY + "00:15:00")]


def test_two_windows_may_meet_at_one_edge(make_readings):
    rows = make_readings([("a", 1, DAY + "00:14:00"), ("a", 2, DAY + "00:16:00")])
    assert neat(rows) == [("a", 1.0, DAY + "00:15:00"), ("a", 2.0, DAY + "00:15:00")]


def test_null_keys_form_one_group(make_readings):
    rows = make_readings([(None, 1, DAY + "00:01:00"), (None, 2, DAY + "00:02:00")])
    assert [r.value for r in time_neat(with_event_time(rows)).collect()] == [2.0]


def test_other_window_lengths(make_readings):
    rows = make_readings([("a", 1, DAY + "00:29:00"), ("a", 2, DAY + "00:31:00")])
    assert neat(rows, length="1 hour") == [("a", 2.0, DAY + "01:00:00")]


@pytest.mark.parametrize("length, bound", [("120 days", None), ("15 minutes", 1 << 54), ("1 hour", 1 << 53)])
def test_windows_too_long_for_the_rank_are_refused(make_readings, length, bound):
    with pytest.raises(ValueError, match="too long"):
        neat(make_readings([("a", 1, DAY + "00:01:00")]), length=length, arrival_bound=bound)


def test_any_bigint_is_a_position(spark, make_readings):
    least, most = -(1 << 63), (1 << 63) - 1
    rows = make_readings([("a", 1, DAY + "00:14:59"), ("a", 2, DAY + "00:14:59"), ("a", 3, DAY + "00:14:58")])
    far = rows.withColumn("seq", F.when(F.col("value") == 1, most).when(F.col("value") == 2, least).otherwise(0))
    assert neat(far) == [("a", 2.0, DAY + "00:15:00")]


def test_kafka_arrival_orders_by_offset_then_partition(spark, make_readings):
    rows = make_readings([("a", v, DAY + "00:14:00") for v in (1, 2, 3)])
    placed = rows.withColumn("seq", F.when(F.col("value") == 1, 8).otherwise(7).cast("bigint")).withColumn(
        "source_partition", F.when(F.col("value") == 2, 5).otherwise(4))
    assert neat(placed, arrival=kafka_arrival()) == [("a", 3.0, DAY + "00:15:00")]


def test_a_position_outside_the_bound_stops_the_job(make_readings):
    rows = make_readings([("a", v, DAY + "00:14:00") for v in range(5)])
    with pytest.raises(Exception, match="arrival outside the given bound"):
        neat(rows, arrival_bound=4)


@pytest.mark.parametrize("bound", [None, 1 << 53])
def test_against_brute_force(spark, make_readings, bound):
    rng = random.Random(7)
    rows = []
    for at in range(3000):
        key = "hot" if rng.random() < 0.4 else f"k{rng.randrange(20)}"
        second = rng.randrange(0, 3 * 3600)
        time = "" if rng.random() < 0.05 else DAY + f"{second // 3600:02}:{second // 60 % 60:02}:{second % 60:02}"
        rows.append((key, at, time))
    best = {}
    for key, value, time in rows:
        second = 57600 - 1704067200 if not time else sum(
            int(part) * size for part, size in zip(time[11:].split(":"), (3600, 60, 1)))
        group = (key, second // 900)
        if group not in best or second > best[group][0]:
            best[group] = (second, float(value))
    got = {
        (r.measurepointid, r.start): (r.second, r.value)
        for r in newest_per_window(in_windows(with_event_time(make_readings(rows).repartition(5))), arrival_bound=bound).select(
            "measurepointid", "value",
            (F.unix_seconds("window.start") - 1704067200).alias("start"),
            (F.unix_seconds("event_time") - 1704067200).alias("second"),
        ).collect()
    }
    assert got == {(key, index * 900): found for (key, index), found in best.items()}


@pytest.mark.parametrize("length", ["15 minutes", "3 days"])
def test_ties_over_partitions_do_not_depend_on_the_order_of_rows(spark, make_readings, length):
    rows = make_readings([("a", v, DAY + "00:14:00") for v in (1, 2, 3)]).drop("source_partition").crossJoin(
        spark.createDataFrame([(3,), (1,), (-2,)], "source_partition INT")).withColumn("seq", F.lit(7).cast("bigint"))
    rows = rows.withColumn("value", F.col("source_partition").cast("double")).distinct()
    for ordered in (rows.coalesce(1).orderBy("value"), rows.coalesce(1).orderBy(F.desc("value"))):
        found = time_neat(with_event_time(ordered.coalesce(1)), length).collect()
        assert [r.value for r in found] == [-2.0]
        named = ordered.withColumn("source_partition", F.concat(F.lit("file"), F.col("source_partition")))
        assert [r.value for r in time_neat(with_event_time(named.coalesce(1)), length).collect()] == [-2.0]


def test_the_timestamp_of_the_record_comes_before_its_position(spark, make_readings):
    rows = make_readings([("a", v, DAY + "00:14:00") for v in (1, 2, 3)])
    stamped = rows.withColumn("arrived", F.lit(1704067200000) - F.col("seq"))
    assert neat(stamped) == [("a", 3.0, DAY + "00:15:00")]
    assert neat(stamped.withColumn("seq", F.lit(10**14))) == [("a", 3.0, DAY + "00:15:00")]


def test_parts_of_a_second_pair_value_and_time(spark):
    rows = spark.createDataFrame(
        [("a", "t", 1.0, 0, 0, 0.1), ("a", "t", 2.0, 1, 0, 0.9)],
        "measurepointid STRING, measuretag STRING, value DOUBLE, seq BIGINT, source_partition INT, at DOUBLE")
    stamped = rows.withColumn("event_time", F.timestamp_millis((F.col("at") * 1000).cast("bigint")))
    (found,) = newest_per_window(in_windows(stamped)).select("value", F.unix_millis("event_time").alias("ms")).collect()
    assert (found.value, found.ms) == (2.0, 900)
    with pytest.raises(Exception, match="whole seconds"):
        newest_per_window(in_windows(stamped), arrival_bound=10).collect()


def test_wild_timestamps_are_ranked_and_stop_nothing(spark):
    """Python's order of the same records: clamped timestamp, then position, then partition."""
    rng = random.Random(7)
    wild = [-(1 << 63), -5, -1, 0, 1, 1_700_000_000_000, 10**13 - 3, 10**13 - 2, 10**13, 1_700_000_000_000_000, (1 << 63) - 1, None]
    rows = []
    for key in range(60):
        for _ in range(rng.randint(1, 6)):
            second = rng.choice([10, 10, 20])
            rows.append((f"k{key}", rng.choice(wild), rng.randrange(10**12), rng.randrange(3), second))
    frame = spark.createDataFrame(
        [(k, "t", float(at), f"2024-01-01 00:00:{s}", arrived, seq, part) for at, (k, arrived, seq, part, s) in enumerate(rows)],
        "measurepointid STRING, measuretag STRING, value DOUBLE, sampletime STRING, arrived BIGINT, seq BIGINT, source_partition INT")

    def order(at):
        _, arrived, seq, part, second = rows[at]
        clamped = 10**13 if arrived is None else min(max(arrived, -1), 10**13 - 3)
        return -second, clamped, seq, part

    best = {}
    for at, row in enumerate(rows):
        if row[0] not in best or order(at) < order(best[row[0]]):
            best[row[0]] = at
    newest = newest_per_window(in_windows(with_event_time(frame))).repartition(3)
    assert {r.measurepointid: int(r.value) for r in newest.collect()} == best
    plan = newest_per_window(in_windows(with_event_time(frame)))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and plan.count("Exchange hashpartitioning") == 1
