"""Which readings came too late for their window, decided exactly and in bulk.

A reading is late if an earlier one of the same source partition had already
moved the watermark to or past the end of its window. The running maximum this
suggests would sort every source partition in one task. Windows make it far
cheaper: all that matters about a window is the first ``seq`` whose watermark
reached its end, and a reading is late exactly if its ``seq`` is greater.

So one hash aggregation per (source partition, window) gives the first and
last ``seq``, a running minimum over that summary, first by blocks of windows
and then inside each block, gives the closing ``seq`` of each window, and
windows that hold a late reading at all are joined back by a hash join that
builds on these windows. Readings are never sorted; a hot (source partition,
window) is pre-aggregated before its shuffle and, in the join, left to the
adaptive skew handling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from quarterbell.schema import seconds_of

WINDOW = "15 minutes"
DELAY = "2 minutes"
BLOCK = 4096


def _window_index(seconds: Column, length: str) -> Column:
    # Never null, and said so: a null check on the join key would work out every time twice.
    return F.coalesce(F.floor(seconds / F.lit(seconds_of(length))), F.lit(0).cast("bigint"))


def closing_positions(stamped: DataFrame, length: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """Per (source partition, window) holding a late reading: the ``seq`` that closed it.

    ``seq`` must be unique and follow arrival within a source partition.
    """
    seconds = F.unix_seconds("event_time")
    summary = stamped.groupBy(
        "source_partition",
        _window_index(seconds, length).alias("own"),
        _window_index(seconds - seconds_of(delay), length).alias("reached"),
    ).agg(F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"))
    unknown = F.lit(None).cast(stamped.schema["seq"].dataType)
    # A watermark inside window r has passed the end of every window before r.
    facts = summary.select(
        "source_partition",
        F.inline(F.array(
            F.struct(
                (F.col("reached") - 1).alias("window_index"),
                F.col("first_seq").alias("closed_by"),
                unknown.alias("last_seq"),
            ),
            F.struct(
                F.col("own").alias("window_index"),
                unknown.alias("closed_by"),
                "last_seq",
            ),
        )),
    ).withColumn("block", F.floor(F.col("window_index") / F.lit(BLOCK)))
    return (
        facts.join(_blocks_with_late(facts), ["source_partition", "block"])
        .withColumn("closed_by", F.least(
            F.min("closed_by").over(
                W.partitionBy("source_partition", "block")
                .orderBy(F.desc("window_index"))
                .rangeBetween(W.unboundedPreceding, W.currentRow)
            ),
            "closed_later",
        ))
        .where("last_seq > closed_by")
        # By block as well: that needs no shuffle here and leaves the one for the join
        # directly below it, where skewed partitions can be split.
        .groupBy("source_partition", "block", "window_index")
        .agg(F.min("closed_by").alias("closed_by"))
        .drop("block")
    )


def _blocks_with_late(facts: DataFrame) -> DataFrame:
    """Blocks of windows that may hold a late reading, and the first ``seq`` past the whole block.

    Going by blocks bounds the rows one task has to order: readings with wild
    times may name any window between the years 1 and 9999, which are 350
    million, but no more than 86,000 blocks of at most 4096 windows.
    """
    blocks = facts.groupBy("source_partition", "block").agg(
        F.min("closed_by").alias("closed_inside"),
        F.max("last_seq").alias("last_inside"),
    )
    later = (
        W.partitionBy("source_partition")
        .orderBy(F.desc("block"))
        .rowsBetween(W.unboundedPreceding, -1)
    )
    return (
        blocks.withColumn("closed_later", F.min("closed_inside").over(later))
        .where("last_inside > least(closed_inside, closed_later)")
        .select("source_partition", "block", "closed_later")
    )


def _join_closing(stamped: DataFrame, length: str, delay: str, how: str) -> DataFrame:
    closing = closing_positions(stamped, length, delay)
    rows = stamped.withColumn("window_index", _window_index(F.unix_seconds("event_time"), length))
    return rows.join(closing.hint("shuffle_hash"), ["source_partition", "window_index"], how)


def late_readings(stamped: DataFrame, length: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """The readings a stream without allowed lateness would drop."""
    late = _join_closing(stamped, length, delay, "inner").where("seq > closed_by")
    return late.select(*stamped.columns)


def on_time_readings(stamped: DataFrame, length: str = WINDOW, delay: str = DELAY) -> DataFrame:
    """The readings a stream would keep: a batch replay with the stream's late-data rule."""
    kept = _join_closing(stamped, length, delay, "left").where("closed_by IS NULL OR seq <= closed_by")
    return kept.select(*stamped.columns)
