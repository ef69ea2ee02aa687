"""Event-time windows: the newest reading of each key, snapped to the window.

The reduction is one ``groupBy`` with fixed-width aggregation buffers, so both
sides of its single shuffle are hash aggregates: a key that sends a third of
all readings is reduced to one row per task and window before anything moves,
and a stream keeps one small row of state per key and open window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterbell.functions import event_time, time_text
from quarterbell.schema import seconds_of

KEYS = ("measurepointid", "measuretag")
WINDOW = "15 minutes"


def with_event_time(readings: DataFrame) -> DataFrame:
    """Stamp each reading with the instant of its sample time, or the sentinel."""
    return readings.withColumn("event_time", event_time(F.col("sampletime")))


def with_watermark(stamped: DataFrame, delay: str = "2 minutes", column: str = "event_time") -> DataFrame:
    """Bounded out-of-orderness: the newest time seen minus ``delay``. No effect on a batch."""
    return stamped.withWatermark(column, delay)


def in_windows(stamped: DataFrame, length: str = WINDOW) -> DataFrame:
    """Assign the epoch-aligned tumbling window ``[start, end)``."""
    return stamped.withColumn("window", F.window("event_time", length))


# Digits of what orders arrivals, and what is added so that none is negative: any BIGINT is a
# position and any INT a partition; beside the timestamp of the record there is less room,
# and what lies outside it counts as the least or the greatest inside.
_STAMPED = {"arrived": (13, 0), "seq": (13, 0), "source_partition": (5, 0)}
_PLAIN = {"seq": (20, 1 << 63), "source_partition": (10, 1 << 31)}
_ALL_DIGITS = 38
_LONGEST_SECONDS = 10**7


def _millis_in_window() -> Column:
    return F.unix_millis("event_time") - F.unix_millis("window.start")


def _fits(length: str, digits: int) -> bool:
    return digits + len(str(seconds_of(length) * 1000 - 1)) <= _ALL_DIGITS


def _decimal(number: int) -> Column:
    return F.lit(str(number)).cast(T.DecimalType(38, 0))


def _packed_rank(parts: list[tuple[Column, int, int]]) -> Column:
    """One number that grows with event time and, for equal times, falls with the parts in their order.

    Milliseconds since the window start and all parts stand side by side in
    DECIMAL(38,0), a fixed-width buffer that hash aggregation can keep. The least code
    of a part stands for all that lie below its room, the greatest but one for all above it, and the greatest
    for null: a wild timestamp is ranked by the parts after it and stops nothing.
    """
    left = digits = sum(size for _, size, _ in parts)
    arrival = _decimal(0)
    for column, size, shift in parts:
        left -= size
        # one more for the code below the room
        number = column.cast(T.DecimalType(38, 0)) + _decimal(shift + 1)
        code = F.least(F.greatest(number, _decimal(0)), _decimal(10**size - 2))
        arrival = arrival + F.when(column.isNull(), _decimal(10**size - 1)).otherwise(code) * _decimal(10**left)
    return _millis_in_window().cast(T.DecimalType(38, 0)) * _decimal(10**digits) + (_decimal(10**digits - 1) - arrival)


def _bounded_rank(arrival: Column, bound: int) -> Column:
    """The same in a BIGINT, which is cheaper, for whole seconds and arrivals below the bound."""
    seconds = F.unix_seconds("event_time") - F.unix_seconds("window.start")
    inside = (arrival >= 0) & (arrival < bound)
    whole = F.unix_micros("event_time") % 1_000_000 == 0
    checked = (
        F.when(~inside, F.raise_error(F.lit("arrival outside the given bound")).cast("bigint"))
        .when(~whole, F.raise_error(F.lit("a bounded rank takes whole seconds only")).cast("bigint"))
        .otherwise(arrival)
    )
    return seconds * F.lit(bound) + (F.lit(bound - 1) - checked)


def _rank(windowed: DataFrame, arrival: Column | None, length: str) -> tuple[Column, bool]:
    """The order of readings by time and arrival, and whether the smallest rank is the winner's.

    Positions start anew in every source partition, so the partition always
    takes part; the timestamp of the record comes first where the source has it.
    A partition named by a text has no number, and very long windows leave no
    room beside their milliseconds: there a struct is compared, which needs a sort.
    """
    types = dict(windowed.dtypes)
    if arrival is not None:
        names, parts = [], [(arrival, 29, 0)]
    else:
        sizes = _STAMPED if "arrived" in types else _PLAIN
        names = [n for n in sizes if n in types]
        parts = [(F.col(n), *sizes[n]) for n in names]
    if types.get("source_partition") != "string" or arrival is not None:
        if _fits(length, sum(size for _, size, _ in parts)):
            return _packed_rank(parts), False
    columns = [column for column, _, _ in parts]
    return F.struct(-F.unix_millis("event_time"), *[c for column in columns for c in (column.isNull(), column)]), True


def newest_per_window(
    windowed: DataFrame,
    arrival: Column | None = None,
    arrival_bound: int | None = None,
    length: str = WINDOW,
) -> DataFrame:
    """The reading with the greatest event time (in milliseconds) per key and window.

    Of readings with the same time the one that arrived first wins. The order
    of arrival is that of ``arrived`` (the record's timestamp) if there is such
    a column, then ``seq``, then ``source_partition``, which is total: no result
    depends on the order of rows. Records stamped before 1970 (-1: without a timestamp) come
    first and those after 2286 last, each in the order of ``seq``. ``arrival`` gives another numeric order, null
    counting as last; with ``arrival_bound`` the order is ``arrival`` or ``seq``
    alone, which must then be unique over all partitions. ``length`` is that of the windows.
    """
    if seconds_of(length) > _LONGEST_SECONDS or seconds_of(length) * (arrival_bound or 0) >= 1 << 63:
        raise ValueError(f"windows of {length} are too long to rank arrivals in")
    if arrival_bound is not None:
        rank, smallest = _bounded_rank(F.col("seq") if arrival is None else arrival, arrival_bound), False
    else:
        rank, smallest = _rank(windowed, arrival, length)
    winner = F.min_by if smallest else F.max_by
    return windowed.groupBy(*KEYS, "window").agg(
        winner("value", rank).alias("value"), winner("event_time", rank).alias("event_time"),
    )


def snap_to_window(newest: DataFrame) -> DataFrame:
    """Move the time to the nearer edge of its window; the middle goes to the start."""
    after_start = F.unix_millis("event_time") - F.unix_millis("window.start")
    before_end = F.unix_millis("window.end") - F.unix_millis("event_time")
    edge = F.when(after_start <= before_end, F.col("window.start")).otherwise(F.col("window.end"))
    return newest.withColumn("sampletime", time_text(edge))


def time_neat(
    stamped: DataFrame,
    length: str = WINDOW,
    arrival: Column | None = None,
    arrival_bound: int | None = None,
) -> DataFrame:
    """Normalised readings: one per key and window, at a window edge.

    Neighbouring windows may snap to the same edge, so key and time together
    are not unique; that is the wanted result.
    """
    newest = newest_per_window(in_windows(stamped, length), arrival, arrival_bound, length)
    return snap_to_window(newest).select(*KEYS, "value", "sampletime")
