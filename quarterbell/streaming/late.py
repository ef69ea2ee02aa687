"""The readings that the state of a stream dropped, found from the log of its checkpoint.

For each micro-batch the checkpoint keeps where its sources began and ended and
its watermark. The state drops a reading if the watermark of the batch before
had reached the end of its window, so a finished batch can be read again by
itself and its late readings picked out by a filter, without any state. Batches
that dropped nothing by their own report are not read.

Spark keeps the last hundred batches of the log by default, so a step is due at
least that often. A step that dies is done again: a batch replaces its own folder.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterbell.operators import in_windows, readings, with_event_time
from quarterbell.schema import READING_SCHEMA, JobOptions
from quarterbell.sinks.commit import read_or_empty
from quarterbell.sinks.sinklog import numbered_files
from quarterbell.sources import read_messages

# Positions have the widest type of all sources.
LATE_SCHEMA = T.StructType([
    *READING_SCHEMA.fields, T.StructField("source_partition", T.StringType()), T.StructField("seq", T.DecimalType(38, 0)),
])
_WITH_BATCH = T.StructType([*LATE_SCHEMA.fields, T.StructField("batch", T.LongType())])
_SEEN = T.StructType([T.StructField("batch", T.LongType()), T.StructField("lost", T.LongType())])
#: Spark's name for the first record of a partition of a topic.
_EARLIEST = -2


@dataclass(frozen=True)
class FinishedBatch:
    """A micro-batch that is done: the watermark before it, and for each source the position before and after it."""

    number: int
    closed_millis: int
    after: tuple[str | None, ...]
    upto: tuple[str | None, ...]


def _texts(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Lines of small files by their names."""
    if not files:
        return {}
    rows = spark.read.text(files, wholetext=True).select("_metadata.file_name", "value").collect()
    found = {r.file_name: r.value.splitlines() for r in rows}
    for name, lines in found.items():
        if lines[0] != "v1":
            raise ValueError(f"{name} of the checkpoint has the unknown version {lines[0]!r}")
    return found


def finished_batches(spark: SparkSession, checkpoint: str, since: int) -> tuple[list[FinishedBatch], int]:
    """The finished batches after ``since`` in their order, and how many of them the log has lost already."""
    done = sorted(n for n in numbered_files(spark, f"{checkpoint}/commits") if n > since)
    offsets = numbered_files(spark, f"{checkpoint}/offsets")
    wanted = sorted({m for n in done for m in (n - 1, n) if m in offsets})
    texts = _texts(spark, [offsets[n][1] for n in wanted])
    # a source that has delivered nothing yet has no position
    places = {n: tuple(None if p == "-" else p for p in texts[str(n)][2:]) for n in wanted}
    closed = {n: json.loads(texts[str(n)][1])["batchWatermarkMs"] for n in wanted}
    found = [
        FinishedBatch(n, closed.get(n - 1, 0), places.get(n - 1, (None,) * len(places[n])), places[n])
        for n in done if n in places and (n == 0 or n - 1 in places)
    ]
    return found, max(done, default=since) - since - len(found)


def _new_files(spark: SparkSession, log: str, after: str | None, upto: str | None) -> list[str]:
    """The files that a source of files took in between two positions; as many as one micro-batch reads."""
    first, last = (-1 if p is None else json.loads(p)["logOffset"] for p in (after, upto))
    if last <= first:
        return []
    names = numbered_files(spark, log)
    # single entries go some time after a compact one has them
    wanted = {n for n in range(first + 1, last + 1) if n in names}
    if any(n not in wanted for n in range(first + 1, last + 1)):
        wanted |= {min(n for n, (compact, _) in names.items() if compact and n >= first)}
        wanted |= {n for n in names if first < n <= last}
    lines = [line for text in _texts(spark, [names[n][1] for n in sorted(wanted)]).values() for line in text[1:]]
    entries = {e["path"]: e["batchId"] for e in map(json.loads, lines)}
    return sorted(re.sub(r"([*?\[\]{}\\])", r"\\\1", unquote(p)) for p, n in entries.items() if first < n <= last)


def _topic_range(options: JobOptions, after: str | None, upto: str) -> tuple[str, str]:
    """Starting and ending offsets; partitions that are new in a batch begin with their first record."""
    end = json.loads(upto)
    before = json.loads(after) if after is not None else {}
    given = json.loads(options.start) if after is None and options.start.startswith("{") else {}
    start = {
        topic: {p: before.get(topic, {}).get(p, given.get(topic, {}).get(p, _EARLIEST)) for p in places} for topic, places in end.items()
    }
    return json.dumps(start, sort_keys=True), json.dumps(end, sort_keys=True)


def batch_messages(
    spark: SparkSession,
    fmt: str,
    options: JobOptions,
    checkpoint: str,
    batch: FinishedBatch,
    **given: Column | None,
) -> list[DataFrame]:
    """The messages that a finished batch read, one frame for each source that delivered any."""
    found = []
    for source, (after, upto) in enumerate(zip(batch.after, batch.upto)):
        if upto is None or upto == after:
            continue
        if fmt == "kafka":
            if after is None and options.start == "latest":
                continue  # before the first batch nothing is closed
            start, end = _topic_range(options, after, upto)
            found.append(read_messages(spark, fmt, replace(options, start=start, until_millis=None), streaming=False, ending=end))
        elif files := _new_files(spark, f"{checkpoint}/sources/{source}", after, upto):
            found.append(read_messages(spark, fmt, options, files, streaming=False, **given))
    return found


def late_of_batch(messages: DataFrame, closed_millis: int, options: JobOptions = JobOptions()) -> DataFrame:
    """The readings whose window had been closed by a watermark."""
    windowed = in_windows(with_event_time(readings(messages, options.bad_time)), options.window)
    late = windowed.where(F.unix_millis("window.end") <= F.lit(closed_millis))
    return late.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in LATE_SCHEMA])


def collect_late(
    spark: SparkSession,
    fmt: str,
    folder: str,
    options: JobOptions = JobOptions(),
    dropped: Mapping[int, int] | None = None,
    **given: Column | None,
) -> tuple[list[int], int]:
    """Write the late readings of newly finished batches of the job below ``folder``.

    Returns the batches that were read again, and how many could not be, as
    their log had gone. ``dropped`` says what is known of batches from their
    reports; those with 0 are passed over, those not in it are read.
    """
    checkpoint, seen = f"{folder}/checkpoints/rows", f"{folder}/late-seen"
    newest = read_or_empty(spark, seen, _SEEN).agg(F.max("batch")).head()[0]
    batches, lost = finished_batches(spark, checkpoint, -1 if newest is None else newest)
    read = []
    for batch in batches:
        if (dropped or {}).get(batch.number) == 0:
            continue
        for source, messages in enumerate(batch_messages(spark, fmt, options, checkpoint, batch, **given)):
            late = late_of_batch(messages, batch.closed_millis, options)
            late.write.mode("overwrite").parquet(f"{folder}/late/batch={batch.number}/source={source}")
        read.append(batch.number)
    if batches or lost:
        last = max([b.number for b in batches], default=(-1 if newest is None else newest) + lost)
        spark.createDataFrame([(last, lost)], _SEEN).coalesce(1).write.mode("append").parquet(seen)
    return read, lost


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The late readings collected so far, with the batch that dropped each."""
    schema = T.StructType([*_WITH_BATCH.fields, T.StructField("source", T.IntegerType())])
    return read_or_empty(spark, f"{folder}/late", schema).select(*_WITH_BATCH.names)
