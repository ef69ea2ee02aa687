"""Fixed schemas of messages, readings and tables, and the options of a job."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import timedelta
from typing import Mapping

from pyspark.sql import types as T

# The keys of one JSON message, in the order they are decoded.
MESSAGE_KEYS = ("MEASUREPOINTID", "MEASURETAG", "VALUE", "SAMPLETIME")

# Columns every source delivers: the text, where it came from, and its position there.
RAW_COLUMNS = ("raw", "source_partition", "seq")

READING_SCHEMA = T.StructType([
    T.StructField("measurepointid", T.StringType()),
    T.StructField("measuretag", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("sampletime", T.StringType()),
])

VALUE_TYPE = T.DecimalType(30, 8)

TABLE_SCHEMA = T.StructType([
    T.StructField("measurepointid", T.StringType()),
    T.StructField("measuretag", T.StringType()),
    T.StructField("value1", VALUE_TYPE),
    T.StructField("sampletime", T.StringType()),
])

DAILY_PARTITIONS = ("daytime",)
HOURLY_PARTITIONS = ("dt", "hr")


def table_schema(partitions: tuple[str, ...] = ()) -> T.StructType:
    """The schema of a sink table; partition columns are always text."""
    parts = [T.StructField(name, T.StringType()) for name in partitions]
    return T.StructType(TABLE_SCHEMA.fields + parts)


def seconds_of(duration: str) -> int:
    """Whole seconds of a duration such as ``15 minutes`` or ``1 hour 30 minutes``."""
    words = duration.split()
    parts = {unit.rstrip("s") + "s": int(number) for number, unit in zip(words[::2], words[1::2])}
    return int(timedelta(**parts).total_seconds())


@dataclass(frozen=True)
class JobOptions:
    """What one job needs to know; nothing is read from files or the environment.

    ``run_millis`` is the start of the run (default: when its plan is made) and
    names the daily partition when ``daytime`` is ``"run_date"``;
    ``"event_date"`` takes the day of the reading.
    ``bad_time`` keeps readings without a usable time under the sentinel time
    (``"sentinel"``) or leaves them to the quarantine (``"quarantine"``).
    ``drop_late`` makes a batch leave out late readings as a stream does.
    ``arrival_bound`` is an exclusive upper bound of ``seq`` known to the caller, who also
    knows that ``seq`` is unique over all source partitions.
    ``until_millis`` ends a batch over a topic at that record timestamp, for all its reads alike.
    ``files_per_batch`` is the number of files that a micro-batch of a stateful stream writes
    at most into each table partition (default: an eighth of the shuffle partitions, 8 at least).
    ``gather`` shuffles a batch, or each micro-batch of a stateless stream, into
    few files per table partition; without it input in time order is written as read.
    ``partition_groups`` are partitions of the topic whose readings keep pace; each group has its own watermark.
    ``max_records_per_task`` cuts a large topic partition into several tasks, so
    that one partition with a third of all messages does not become one task.
    """

    topic: str = "readings"
    bootstrap_servers: str = ""
    start: str = "earliest"
    group_id: str | None = None
    consumer: Mapping[str, str] = field(default_factory=dict)
    max_offsets_per_trigger: int | None = None
    max_records_per_task: int = 5_000_000
    min_partitions: int | None = None
    max_files_per_trigger: int | None = None
    window: str = "15 minutes"
    delay: str = "2 minutes"
    table_delay: str = "3 minutes"
    run_millis: int | None = None
    daytime: str = "run_date"
    bad_time: str = "sentinel"
    drop_late: bool = False
    arrival_bound: int | None = None
    gather: bool = True
    until_millis: int | None = None
    files_per_batch: int | None = None
    partition_groups: tuple[tuple[int, ...], ...] = ()

    def __post_init__(self):
        if self.daytime not in ("run_date", "event_date"):
            raise ValueError(f"daytime must be run_date or event_date, not {self.daytime!r}")
        if self.bad_time not in ("sentinel", "quarantine"):
            raise ValueError(f"bad_time must be sentinel or quarantine, not {self.bad_time!r}")
