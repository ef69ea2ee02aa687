"""Sharding by best-fit-decreasing bin packing.

Documents of one text form a group that no shard splits. Large groups are
packed one by one. Small groups are first bundled by ranges of their text's
hash, and the bundles are packed like groups: the number of items that the
driver packs is bounded by the shards, never by the documents. The items, by
size, each enter the shard with the least room that still fits them; free room
is kept in an ordered list searched by halving. The least capacity that needs
no further shard is found by halving as well.

Results in the odd cases: a null text has no bytes and groups with the empty
text (size 8, checksum 0); rows that repeat each other get a slot each; an
empty table gives no rows; other columns are not read. A group larger than a
fair share makes its shard larger than the others, as groups are indivisible.
"""

from __future__ import annotations

import bisect

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterbell.llm.tables import saved, table

SHARDS = 24
#: Bytes that a row takes besides its text.
ROW_BYTES = 8
#: Bundles of small groups for each shard.
BUNDLES_PER_SHARD = 256
#: A group is large from this part of a shard's fair share on.
LARGE_PART = 64
#: Slots are numbered in parallel in so many pieces of a shard.
PIECES = 4096


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The bin of each item; items of a size keep their order. A new bin is opened where none has room."""
    room: list[tuple[int, int]] = []  # ordered: free room, bin
    bins = [0] * len(sizes)
    opened = 0
    for item in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[item]
        at = bisect.bisect_left(room, (size, -1))
        if at < len(room):
            free, chosen = room.pop(at)
        else:
            free, chosen = max(capacity, size), opened
            opened += 1
        bins[item] = chosen
        bisect.insort(room, (free - size, chosen))
    return bins


def pack(sizes: list[int], shards: int) -> list[int]:
    """A bin below ``shards`` for each item, by the least capacity at which best fit decreasing opens no more."""
    if not sizes:
        return []
    low, high = max(max(sizes), -(-sum(sizes) // shards)), sum(sizes) + max(sizes)
    best = best_fit_decreasing(sizes, high)
    while low <= high:
        capacity = (low + high) // 2
        found = best_fit_decreasing(sizes, capacity)
        if max(found) < shards:
            best, high = found, capacity - 1
        else:
            low = capacity + 1
    return best


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, size, checksum and text hash of every document, written once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return saved(
        documents.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.unhex(F.sha2(F.encode(text, "UTF-8"), 256)).alias("text_hash"),
        ),
        "shard-sizes",
    )


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    spark = documents.sparkSession
    sized = measured(documents)
    total = sized.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    bundles = shards * BUNDLES_PER_SHARD
    bundle = F.pmod(F.xxhash64("text_hash"), F.lit(bundles)).cast("int")
    groups = sized.groupBy("text_hash").agg(F.sum("size").alias("bytes"))
    large_from = total // (shards * LARGE_PART) + 1
    # at most shards * LARGE_PART groups can be that large, and there are so many bundles
    large = groups.where(F.col("bytes") >= large_from)
    items = saved(
        large.select("text_hash", F.lit(None).cast("int").alias("bundle"), "bytes").unionByName(
            groups.where(F.col("bytes") < large_from).groupBy(bundle.alias("bundle")).agg(F.sum("bytes").alias("bytes"))
            .select(F.lit(None).cast("binary").alias("text_hash"), "bundle", "bytes")
        ),
        "shard-items",
    ).collect()
    items.sort(key=lambda r: (-r.bytes, -1 if r.bundle is None else r.bundle, bytes(r.text_hash or b"")))
    bins = pack([r.bytes for r in items], shards)
    # both of these have at most as many rows as the driver packed items
    large_shards = spark.createDataFrame(
        [(r.text_hash, b) for r, b in zip(items, bins) if r.bundle is None], "text_hash binary, large_shard int")
    bundle_shards = spark.createDataFrame(
        [(r.bundle, b) for r, b in zip(items, bins) if r.bundle is not None], "bundle int, bundle_shard int")
    placed = (
        sized.withColumn("bundle", bundle)
        .join(F.broadcast(large_shards), "text_hash", "left").join(F.broadcast(bundle_shards), "bundle", "left")
        .withColumn("shard", F.coalesce("large_shard", "bundle_shard"))
    )
    piece = F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(PIECES)).cast("int")
    placed = placed.withColumn("piece", piece).select("doc_id", "size", "text_crc32", "shard", "piece")
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("shard", "piece").agg(F.count("*").alias("rows"))
        .select("shard", "piece", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"))
    )
    slot = F.row_number().over(Window.partitionBy("shard", "piece").orderBy("doc_id", "text_crc32")) - 1
    return placed.withColumn("slot", slot).join(offsets, ["shard", "piece"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("slot") + F.col("rows_before")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"))
