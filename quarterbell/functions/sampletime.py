"""Sample-time text: is it usable, which instant is it, how is it printed.

A sample time is a wall-clock text without a zone. It is read as UTC by an
explicit ``Z`` and printed through TIMESTAMP_NTZ, so that no result depends on
``spark.sql.session.timeZone`` and daylight saving never moves a reading.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text (matched in full), the stand-in time of
# readings without a usable one, and the text the table's time column accepts
# (yyyy-MM-dd HH:mm:ss with up to three decimals).
SAMPLE_TIME_PATTERN = r"((([0-9]{3}[1-9]|[0-9]{2}[1-9][0-9]{1}|[0-9]{1}[1-9][0-9]{2}|[1-9][0-9]{3})-(((0[13578]|1[02])-(0[1-9]|[12][0-9]|3[01]))|((0[469]|11)-(0[1-9]|[12][0-9]|30))|(02-(0[1-9]|[1][0-9]|2[0-8]))))|((([0-9]{2})(0[48]|[2468][048]|[13579][26])|((0[48]|[2468][048]|[3579][26])00))-02-29))\s+([0-1]?[0-9]|2[0-3]):([0-5][0-9]):([0-5][0-9])"
SENTINEL_MILLIS = 57600000
TABLE_TIME_PATTERN = r"[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,3})?"


def is_present(text: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(text, F.lit("")) != ""


def is_valid_sample_time(text: Column) -> Column:
    r"""Full match of the pattern; null stays null. ``\z`` admits no trailing newline."""
    return text.rlike("^" + SAMPLE_TIME_PATTERN + r"\z")


def _instant(text: Column) -> Column:
    return F.concat(text, F.lit("Z")).try_cast("timestamp")


def event_time(text: Column) -> Column:
    """The instant of a usable sample time, the sentinel for every other text.

    The pattern allows any run of whitespace between date and time; only such
    texts take the second, slower parse.
    """
    parsed = F.coalesce(_instant(text), _instant(F.regexp_replace(text, r"\s+", " ")))
    return F.coalesce(
        F.when(is_valid_sample_time(text), parsed),
        F.timestamp_millis(F.lit(SENTINEL_MILLIS)),
    )


def table_time(text: Column) -> Column:
    r"""``to_timestamp`` of the table: null where the text is no time of its format.

    A bare cast would accept more, even a time of day, to which it adds today's date.
    """
    return F.when(text.rlike("^" + TABLE_TIME_PATTERN + r"\z"), _instant(text))


def time_text(instant: Column) -> Column:
    """An instant as ``yyyy-MM-dd HH:mm:ss`` in UTC, whatever the session zone.

    Spark marks years beyond 9999, which the last window of that year may reach, with a plus.
    """
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.ltrim(F.timestamp_add("SECOND", F.unix_seconds(instant), epoch).cast("string"), F.lit("+"))


def day_of(instant: Column) -> Column:
    """Partition text ``yyyy-MM-dd`` in UTC; counts days, which costs less than printing the time."""
    epoch = F.lit("1970-01-01").cast("date")
    days = F.floor(F.unix_seconds(instant) / F.lit(86400)).cast("int")
    return F.date_add(epoch, days).cast("string")


def hour_of(instant: Column) -> Column:
    """Partition text ``HH`` in UTC."""
    hours = F.floor(F.pmod(F.unix_seconds(instant), F.lit(86400)) / F.lit(3600))
    return F.lpad(hours.cast("string"), 2, "0")


def run_date(run_millis: int) -> Column:
    """The day a run started, a constant folded once per plan."""
    return day_of(F.timestamp_millis(F.lit(run_millis)))
