"""Message sources: a Kafka topic or files, batch or stream, behind one function.

Whatever the format, a source delivers ``raw`` (the text of one record),
``source_partition`` (where it came from) and ``seq`` (its position there);
Kafka also gives ``arrived``, the timestamp of the record in milliseconds.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarterbell.schema import JobOptions

# Marks in the metadata of columns: ``seq`` is no order, ``source_partition`` is a mere file.
NO_ORDER, NO_STREAM = "no_order", "no_stream"

_ARCHIVE_SCHEMA = "raw STRING, source_partition INT, seq BIGINT"

# Consumer settings that the Spark source decides itself and refuses to be given.
_DECIDED_BY_SPARK = {
    "auto.offset.reset",
    "enable.auto.commit",
    "interceptor.classes",
    "key.deserializer",
    "value.deserializer",
    "partition.assignment.strategy",
}


def spark_consumer_options(consumer: Mapping[str, str]) -> dict[str, str]:
    """Kafka consumer properties as options of the Spark source.

    The start position becomes ``startingOffsets``; deserializers and the
    assignor have no counterpart because Spark assigns offsets to tasks itself.
    """
    options = {f"kafka.{key}": value for key, value in consumer.items() if key not in _DECIDED_BY_SPARK}
    if "auto.offset.reset" in consumer:
        options["startingOffsets"] = consumer["auto.offset.reset"]
    return options


def _offsets_of(start: str, topic: str, partitions: Sequence[int]) -> str:
    """Start offsets as JSON, only those of some partitions; a word such as earliest as it is."""
    if not start.startswith("{"):
        return start
    offsets = json.loads(start).get(topic, {})
    return json.dumps({topic: {str(p): offsets[str(p)] for p in partitions if str(p) in offsets}})


def kafka_options(options: JobOptions, streaming: bool = True, partitions: Sequence[int] | None = None) -> dict[str, str]:
    """The options of ``format("kafka")`` for one job.

    ``start="group-offsets"`` resumes from the checkpoint of the query, where
    Spark keeps its positions; only the very first start reads ``earliest``.
    To take over the positions of a consumer group, give them as Spark's JSON
    of offsets. A batch reads to the offsets that are the latest when its plan
    is made, or, with ``until_millis``, to the first record stamped later; it can't start at the latest.
    With ``partitions`` only those of the topic are read.
    """
    result = spark_consumer_options(options.consumer)
    if options.bootstrap_servers:
        result["kafka.bootstrap.servers"] = options.bootstrap_servers
    if "kafka.bootstrap.servers" not in result:
        raise ValueError("no bootstrap servers given")
    if options.group_id is not None:
        result["kafka.group.id"] = options.group_id
    if partitions is None:
        result["subscribe"] = options.topic
    else:
        result["assign"] = json.dumps({options.topic: list(partitions)})
    start = "earliest" if options.start == "group-offsets" else options.start
    if not streaming:
        if start == "latest":
            raise ValueError("a batch that starts at the latest offset reads nothing; give earliest or offsets")
        if options.until_millis is None:
            result["endingOffsets"] = "latest"
        else:
            result["endingTimestamp"] = str(options.until_millis)
    result["startingOffsets"] = start if partitions is None else _offsets_of(start, options.topic, partitions)
    result["maxRecordsPerPartition"] = str(options.max_records_per_task)
    if options.min_partitions is not None:
        result["minPartitions"] = str(options.min_partitions)
    if streaming and options.max_offsets_per_trigger is not None:
        result["maxOffsetsPerTrigger"] = str(options.max_offsets_per_trigger)
    return result


def exact_range(given: Mapping[str, str], ending: str) -> dict[str, str]:
    """Options of a batch that reads just the partitions and records between its starting and the ending offsets."""
    rest = {k: v for k, v in given.items() if k not in ("endingTimestamp", "subscribe")}
    assigned = {topic: sorted(map(int, places)) for topic, places in json.loads(ending).items()}
    return {**rest, "assign": json.dumps(assigned), "endingOffsets": ending}


def kafka_arrival() -> Column:
    """Order of arrival over all partitions of a topic: offset, then partition."""
    wide = T.DecimalType(30, 0)
    ten_digits = F.lit("10000000000").cast(T.DecimalType(11, 0))
    return (F.col("seq").cast(T.DecimalType(19, 0)) * ten_digits + F.col("source_partition")).cast(wide)


def _line_position(streaming: bool) -> Column:
    """A position of each line in its file: start of the split, then the line within it.

    Streams cannot number lines: there it is null and marked as no order.
    """
    if streaming:
        return F.lit(None).cast(T.DecimalType(30, 0))
    ten_digits = F.lit("10000000000").cast(T.DecimalType(11, 0))
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    start_of_split = F.col("_metadata.file_block_start").cast(T.DecimalType(19, 0))
    return (start_of_split * ten_digits + within).cast(T.DecimalType(30, 0))


def _in_file_order(lines: DataFrame, stream: Column) -> DataFrame:
    """Lines numbered through the files of their stream: the number of the file, then the place in it.

    Only the list of files is ordered, one row for each file.
    """
    files = lines.select("path").distinct().withColumn("source_partition", stream)
    number = F.row_number().over(Window.partitionBy("source_partition").orderBy("path"))
    files = files.withColumn("file", number)
    # 8 digits of files before 20 of the split's start and the line in it
    spread = F.lit("1" + "0" * 29).cast(T.DecimalType(30, 0))
    return lines.join(files, "path").select(
        F.col("value").alias("raw"), "source_partition",
        (F.col("file").cast(T.DecimalType(8, 0)) * spread + F.col("at")).cast(T.DecimalType(38, 0)).alias("seq"),
    )


def read_messages(
    spark: SparkSession,
    fmt: str,
    options: JobOptions,
    path: str | list[str] | None = None,
    streaming: bool = True,
    position: Column | None = None,
    stream: Column | None = None,
    partitions: Sequence[int] | None = None,
    ending: str | None = None,
) -> DataFrame:
    """Read ``kafka``, ``parquet`` (archived messages), or ``text`` / ``json`` (one record per line).

    ``position`` gives the ``seq`` of a line of text, computed from its column
    ``value``; without it the place of the line in its file is used. A stream
    of text without it has no order, and jobs that need one refuse it.
    ``stream`` names the stream that a file of text is part of, computed from
    ``path``; files of one stream are in the order of their paths, and ``seq`` follows it.
    ``partitions`` are those of the topic to read, all if not given. ``ending`` are the offsets that
    a batch ends at, as Spark's JSON; it then reads what these and the starting offsets name.
    """
    reader = spark.readStream if streaming else spark.read
    if fmt == "kafka":
        given = kafka_options(options, streaming, partitions)
        if ending is not None:
            given = exact_range(given, ending)
        topic = reader.format("kafka").options(**given).load()
        return topic.select(
            F.col("value").cast("string").alias("raw"),
            F.col("partition").alias("source_partition"),
            F.col("offset").alias("seq"),
            F.unix_millis("timestamp").alias("arrived"),
        )
    if path is None:
        raise ValueError(f"format {fmt} needs a path")
    if streaming and options.max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", options.max_files_per_trigger)
    if fmt == "parquet":
        return reader.schema(_ARCHIVE_SCHEMA).parquet(*([path] if isinstance(path, str) else path))
    if fmt in ("text", "json"):
        lines = reader.text(path)
        if stream is None:
            unordered = streaming and position is None
            seq = (_line_position(streaming) if position is None else position).alias("seq", metadata={NO_ORDER: unordered})
            part = F.col("_metadata.file_path").alias("source_partition", metadata={NO_STREAM: True})
            return lines.select(F.col("value").alias("raw"), part, seq)
        if streaming:
            raise ValueError("files of a stream are ordered by Spark; name their stream in a batch only")
        return _in_file_order(lines.select(
            "value", F.col("_metadata.file_path").alias("path"), (_line_position(False) if position is None else position).alias("at")), stream)
    raise ValueError(f"unknown message format {fmt!r}")


def read_groups(
    spark: SparkSession,
    fmt: str,
    options: JobOptions,
    paths: Sequence[str] = (),
    streaming: bool = True,
    **given: Column | None,
) -> list[DataFrame]:
    """Messages of several groups of sources, each of which a job gives a watermark of its own.

    Groups are folders, or the ``partition_groups`` of a topic. The watermark
    of the job is the least of its groups, so that none of them makes another's
    readings late; a group that delivers nothing holds it back. Partitions of the topic in no group are not read.
    """
    if fmt != "kafka":
        if not paths:
            raise ValueError(f"format {fmt} needs paths")
        return [read_messages(spark, fmt, options, path, streaming, **given) for path in paths]
    groups = options.partition_groups
    listed = [p for group in groups for p in group]
    if not groups or not all(groups) or len(set(listed)) < len(listed):
        raise ValueError("partition_groups must be groups of partitions, each in one of them")
    return [read_messages(spark, fmt, options, streaming=streaming, partitions=group) for group in groups]
