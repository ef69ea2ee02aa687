"""The given ``events`` table seen as sensor readings and as JSON messages.

Damage is deterministic: the first rule of ``FIXTURES.md`` section 3 that
applies to ``seq`` changes the record. No record is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENTS_SCHEMA = (
    "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)

_RULES = (97, 101, 103, 107, 109, 113)


def events(spark: SparkSession, sf_dir: str, streaming: bool = False) -> DataFrame:
    if streaming:
        # A pattern, because a file stream takes no path of a single file.
        return spark.readStream.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parque[t]")
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{sf_dir}/events.parquet")


def _rule(seq: str) -> Column:
    """The rule that damages a record, null for most."""
    rule = F.when(F.col(seq) % _RULES[0] == 0, _RULES[0])
    for divisor in _RULES[1:]:
        rule = rule.when(F.col(seq) % divisor == 0, divisor)
    return rule


def _text(time: Column) -> Column:
    return F.substring(time.cast("string"), 1, 19)


def _sample_time(rule: Column) -> Column:
    moved_back = F.col("ts") - F.expr("INTERVAL '40' MINUTE")
    return (
        F.when(rule == 97, "")
        .when(rule == 101, "2023-02-29 00:00:00")
        .when(rule == 113, _text(moved_back))
        .otherwise(_text(F.col("ts")))
    )


def as_readings(table: DataFrame, dirty_times: bool = False) -> DataFrame:
    """Typed readings, with the time rules applied on request."""
    time = _sample_time(_rule("event_id")) if dirty_times else _text(F.col("ts"))
    return table.select(
        F.col("event_id").alias("seq"),
        (F.col("user_id") % 4).cast("int").alias("source_partition"),
        (F.col("user_id") % 10).cast("string").alias("measurepointid"),
        F.col("event_type").alias("measuretag"),
        "value",
        time.alias("sampletime"),
    )


def as_messages(table: DataFrame, dirty: bool = False) -> DataFrame:
    """JSON messages, with all rules applied on request."""
    rule = F.col("rule")
    value = F.col("value")

    def json(number: Column) -> Column:
        return F.to_json(F.struct(
            F.col("measurepointid").alias("MEASUREPOINTID"),
            F.col("measuretag").alias("MEASURETAG"),
            number.alias("VALUE"),
            F.col("sampletime").alias("SAMPLETIME"),
        ))

    if not dirty:
        return as_readings(table).select(json(value).alias("raw"), "source_partition", "seq")
    readings = as_readings(table, dirty_times=True)
    ruled = readings.withColumn("rule", _rule("seq"))
    whole = json(F.when(rule.isNull() | (rule != 103), value))
    raw = (
        F.when(rule == 107, F.substring(whole, 1, 10))
        .when(rule == 109, json(value.cast("string")))
        .otherwise(whole)
    )
    return ruled.select(raw.alias("raw"), "source_partition", "seq")


def as_wildly_stamped(messages: DataFrame) -> DataFrame:
    """Messages with record timestamps in reverse order of ``seq``, and every third without one (-1) or in microseconds."""
    millis = F.lit(1704067200000) - F.col("seq")
    stamp = F.when(F.col("seq") % 6 == 0, -1).when(F.col("seq") % 6 == 3, millis * 1000).otherwise(millis)
    return messages.withColumn("arrived", stamp)


def as_tied_messages(table: DataFrame) -> DataFrame:
    """Clean messages whose times are cut to the hour and whose ``seq`` starts anew in each source partition."""
    readings = as_readings(table)
    raw = F.to_json(F.struct(
        F.col("measurepointid").alias("MEASUREPOINTID"),
        F.col("measuretag").alias("MEASURETAG"),
        F.col("value").alias("VALUE"),
        F.concat(F.substring("sampletime", 1, 14), F.lit("00:00")).alias("SAMPLETIME"),
    ))
    return readings.select(
        raw.alias("raw"), (F.col("seq") % 4).cast("int").alias("source_partition"), F.floor(F.col("seq") / 4).cast("bigint").alias("seq"))
