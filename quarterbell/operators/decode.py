"""JSON text to typed readings, and the records that are no reading.

``json_tuple`` reads all four keys in one pass, stays inside whole-stage
codegen and, being a generator, keeps later filters from being pushed below it
(a filter pushed through ``from_json`` would parse every text again). Values
come out as text, so quoted and bare numbers decode alike.

The checks that need a second look at the text are guarded by conditions that
only failing records meet, so a clean record is parsed exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarterbell.functions import is_present, is_valid_sample_time, table_time
from quarterbell.schema import MESSAGE_KEYS

_FIELDS = ("measurepointid", "measuretag", "value_text", "sampletime")
_READING = ("source_partition", "seq", "measurepointid", "measuretag", "value", "sampletime")
_QUARANTINE = ("source_partition", "seq", "raw", "reason")


def _fields(messages: DataFrame) -> DataFrame:
    decoded = messages.select("*", F.json_tuple("raw", *MESSAGE_KEYS).alias(*_FIELDS))
    return decoded.withColumn("value", F.when(~_has_tail(), F.col("value_text").try_cast("double")))


def _has_tail() -> Column:
    """Text after a complete object, which the parser ignores.

    A text whose only closing brace is its last character has none. Others are
    put into an array before a number that only they have: if anything follows the object, the second
    element is not that number, or there are more. The parser itself follows all levels.
    """
    plain = F.expr("locate('}', raw) = length(raw)")
    mark = F.xxhash64("raw").cast("string")
    wrapped = F.concat(F.lit("["), F.col("raw"), F.lit(","), mark, F.lit("]"))
    alone = (F.json_array_length(wrapped) == 2) & (F.get_json_object(wrapped, "$[1]") == mark)
    return F.coalesce(~plain & ~F.coalesce(alone, F.lit(False)) & _is_object(), F.lit(False))


def _columns(messages: DataFrame, names: tuple[str, ...]) -> list[str]:
    """The names, and the record's timestamp where the source has one."""
    return [*names, *(["arrived"] if "arrived" in messages.columns else [])]


def _is_object() -> Column:
    return F.json_object_keys("raw").isNotNull()


def _has_value() -> Column:
    return F.col("value").isNotNull()


def _reason() -> Column:
    """Why a record without a numeric value is none."""
    return (
        F.when(~_is_object() | _has_tail(), "malformed")
        .when(~is_present(F.col("value_text")), "null_value")
        .otherwise("bad_value")
    )


def _judged(messages: DataFrame, bad_time: str) -> DataFrame:
    """All records decoded, with the reason why one is no reading (null: it is one)."""
    reason = F.when(~_has_value(), _reason())
    if bad_time == "quarantine":
        valid = F.coalesce(is_valid_sample_time(F.col("sampletime")), F.lit(False))
        reason = reason.when(~valid, "bad_time")
    return _fields(messages).withColumn("reason", reason)


def readings(messages: DataFrame, bad_time: str = "sentinel") -> DataFrame:
    """Strict decode: the records with a numeric value.

    With ``bad_time="quarantine"`` records without a usable time are left out
    as well; otherwise they stay and get the sentinel time later on.
    """
    good = _fields(messages).where(_has_value())
    if bad_time == "quarantine":
        good = good.where(is_valid_sample_time(F.col("sampletime")))
    return good.select(*_columns(messages, _READING))


def quarantine(messages: DataFrame, bad_time: str = "sentinel") -> DataFrame:
    """The records ``readings`` leaves out, each with its text and a reason."""
    return _judged(messages, bad_time).where("reason IS NOT NULL").select(*_QUARANTINE)


def all_records(messages: DataFrame, bad_time: str = "sentinel") -> DataFrame:
    """Readings and quarantined records in one pass: the columns of both, those of a reading with a null ``reason`` and ``raw``."""
    return _judged(messages, bad_time).select(*_columns(messages, _READING), _kept_text(), "reason")


def _kept_text() -> Column:
    return F.when(F.col("reason").isNotNull(), F.col("raw")).alias("raw")


def _empty_value() -> Column:
    return _is_object() & ~is_present(F.col("value_text")) & ~_has_tail()


def table_rows(messages: DataFrame, keep_null_time: bool = False) -> DataFrame:
    """Table decode: missing fields are null, ``ts`` is computed from the sample time.

    Records without a time can be placed in no hourly partition; they are left
    to ``table_quarantine`` unless ``keep_null_time`` asks for them.
    """
    # As the output of a generator ``ts`` is not worked out a second time for the null check.
    ts = F.explode(F.array(table_time(F.col("sampletime")))).alias("ts")
    rows = _fields(messages).where(_has_value() | _empty_value()).select(*_columns(messages, _READING), ts)
    return rows if keep_null_time else rows.where("ts IS NOT NULL")


def table_quarantine(messages: DataFrame) -> DataFrame:
    """The records ``table_rows`` leaves out: no JSON object, no number, no time."""
    return _judged_for_table(messages).where("reason IS NOT NULL").select(*_QUARANTINE)


def _judged_for_table(messages: DataFrame) -> DataFrame:
    reason = (
        F.when(~_has_value() & ~_empty_value(), _reason())
        .when(table_time(F.col("sampletime")).isNull(), "null_time")
    )
    return _fields(messages).withColumn("reason", reason)


def all_table_records(messages: DataFrame) -> DataFrame:
    """``table_rows`` and ``table_quarantine`` in one pass, as ``all_records``."""
    ts = F.explode(F.array(table_time(F.col("sampletime")))).alias("ts")
    return _judged_for_table(messages).select(*_columns(messages, _READING), _kept_text(), "reason", ts)
