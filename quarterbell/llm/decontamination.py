"""Benchmark decontamination by pigeonhole edit matching.

An item of n words is found in a document if some run of the document's words
is within n // 5 word edits of it (words as in license scans: lower case,
without punctuation). Cut into budget + 1 pieces, one piece must occur without
an edit: documents are searched for pieces by n-gram hashes, and around each
hit Myers' bit-parallel algorithm gives the distance of the item to the best
run of words.

The items are the small side. They are sent to tasks in blocks of at most
``MOST_ITEM_WORDS`` words, and documents are read once for each block; they
are never shuffled, and a piece that occurs everywhere only adds hits where it
occurs.

Results in the odd cases: null or empty texts and items without a word match
nothing; an item listed twice is found under both ids; repeated documents
give repeated results; empty tables give no rows; a null id stays null; extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types

from quarterbell.llm import tokens as T
from quarterbell.llm.tables import table

#: One edit is allowed for so many words of an item.
WORDS_PER_EDIT = 5
#: Words of the items that tasks hold at once.
MOST_ITEM_WORDS = 1_000_000
LEAKS = "_leaks"
_LEAK = types.ArrayType(types.StructType([
    types.StructField("item", types.IntegerType()), types.StructField("distance", types.IntegerType()), types.StructField("last_word", types.LongType())]))
_LEAK_ARROW = pa.list_(pa.struct([("item", pa.int32()), ("distance", pa.int32()), ("last_word", pa.int64())]))


def budget(n_words: int) -> int:
    return n_words // WORDS_PER_EDIT


def pieces(n_words: int) -> list[tuple[int, int]]:
    """(offset, length) of budget + 1 pieces of nearly one length; none of an item without words."""
    n = budget(n_words) + 1 if n_words else 0
    edges = [i * n_words // n for i in range(n + 1)] if n else []
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def myers(pattern: list, text: list) -> tuple[int, int]:
    """(distance, place of its last word) of the run of the text that is nearest to the pattern; the first such run."""
    n = len(pattern)
    of = {}
    for i, w in enumerate(pattern):
        of[w] = of.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score = full, 0, n
    best, at = n, -1
    for j, w in enumerate(text):
        same = of.get(w, 0)
        vertical = same | down
        horizontal = (((same & up) + up) ^ up) | same
        plus, minus = down | (full & ~(horizontal | up)), up & horizontal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = (plus << 1) & full, (minus << 1) & full
        up, down = minus | (full & ~(vertical | plus)), plus & vertical
        if score < best:
            best, at = score, j
    return best, at


class Index:
    """Pieces of items by length: sorted hashes, and the items and offsets of each."""

    def __init__(self, texts: list[str]):
        words = T.words_of(pa.array(texts, pa.string()), T.LETTERS, lower=True)
        hashes = words.hashes()
        self.items = [hashes[a:b].tolist() for a, b in zip(words.first[:-1], words.first[1:])]
        found: dict[int, list] = {}
        for item, (a, b) in enumerate(zip(words.first[:-1], words.first[1:])):
            for offset, n in pieces(b - a):
                found.setdefault(n, []).append((T.grams(hashes[a + offset:a + offset + n], n)[0], item, offset))
        self.by_length = {}
        for n, rows in found.items():
            rows.sort()
            keys = np.array([r[0] for r in rows], np.uint64)
            low = np.zeros(1 << 16, bool)
            low[(keys & np.uint64(0xFFFF)).astype(np.int64)] = True
            self.by_length[n] = keys, low, np.array([r[1] for r in rows]), np.array([r[2] for r in rows])

    def hits(self, hashes: np.ndarray, room: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(item, where its piece stands, where in all words its first word would) of each piece found."""
        items, places, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, (keys, low, item, offset) in self.by_length.items():
            found = T.grams(hashes, n)
            at = np.flatnonzero(low[(found & np.uint64(0xFFFF)).astype(np.int64)] & (room >= n))
            left, right = np.searchsorted(keys, found[at], "left"), np.searchsorted(keys, found[at], "right")
            count = right - left
            which = np.repeat(left, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            items.append(item[which])
            places.append(np.repeat(at, count))
            starts.append(places[-1] - offset[which])
        return np.concatenate(items), np.concatenate(places), np.concatenate(starts)

    def leaks(self, words: T.Words) -> list[list[dict]]:
        """For each document the items found in it, with the least distance."""
        hashes = words.hashes()
        items, places, starts = self.hits(hashes, words.room)
        out: list[list[dict]] = [[] for _ in words.first[1:]]
        docs = np.searchsorted(words.first, places, "right") - 1
        sizes = [len(i) for i in self.items]
        best: dict[tuple[int, int], tuple[int, int]] = {}
        order = np.lexsort((starts, items, docs))
        at = 0
        docs, items, starts = docs[order].tolist(), items[order].tolist(), starts[order].tolist()
        while at < len(docs):
            doc, item, first = docs[at], items[at], starts[at]
            n, k, last = sizes[item], budget(sizes[item]), first
            while at < len(docs) and (docs[at], items[at]) == (doc, item) and starts[at] <= last + n:
                last = starts[at]
                at += 1
            low, high = max(first - k, int(words.first[doc])), min(last + n + k, int(words.first[doc + 1]))
            distance, end = myers(self.items[item], hashes[low:high].tolist())
            if distance <= k:
                found = (distance, low + end - int(words.first[doc]))
                best[doc, item] = min(best.get((doc, item), found), found)
        for (doc, item), (distance, end) in sorted(best.items()):
            out[doc].append({"item": item, "distance": distance, "last_word": end})
        return out


def with_leaks(documents: DataFrame, texts: list[str]) -> DataFrame:
    """The documents with a column LEAKS: the numbers of the texts found in each, with distance and place."""
    index = documents.sparkSession.sparkContext.broadcast(Index(texts))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            found = index.value.leaks(T.words_of(batch.column("text").cast(pa.string()), T.LETTERS, lower=True))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, _LEAK_ARROW)], names=[*batch.schema.names, LEAKS])

    return documents.mapInArrow(search, types.StructType([*documents.schema.fields, types.StructField(LEAKS, _LEAK)]))


def item_blocks(benchmark: DataFrame, most_words: int = MOST_ITEM_WORDS) -> Iterator[list]:
    """The items, in blocks of about ``most_words`` words at most; only one block is on the driver at a time."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text IS NOT NULL")
    words = items.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0] // 2
    blocks = 1 + 2 * words // most_words if words > most_words else 1
    for block in range(blocks):
        yield items.where(F.pmod(F.xxhash64("text", "item_id"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()


def find_leaks(documents: DataFrame, benchmark: DataFrame, most_words: int = MOST_ITEM_WORDS) -> DataFrame:
    """doc_id, item_id, item_words, budget, distance and last_word: a row for each document and item found in it."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in item_blocks(benchmark, most_words):
        n_words = np.diff(T.words_of(pa.array([r.text for r in items], pa.string()), T.LETTERS, lower=True).first)
        known = documents.sparkSession.createDataFrame(
            [(i, r.item_id, int(n), budget(int(n))) for i, (r, n) in enumerate(zip(items, n_words))],
            "item int, item_id long, item_words int, budget int")
        found = (
            with_leaks(texts, [r.text for r in items]).select("doc_id", F.explode(LEAKS).alias("leak")).select("doc_id", "leak.*")
            .join(F.broadcast(known), "item").select("doc_id", "item_id", "item_words", "budget", "distance", "last_word")
        )
        out = found if out is None else out.unionByName(found)
    return out


def without_leaks(documents: DataFrame, benchmark: DataFrame, most_words: int = MOST_ITEM_WORDS) -> DataFrame:
    """The documents in which no item is found, as they are."""
    for items in item_blocks(benchmark, most_words):
        documents = with_leaks(documents, [r.text for r in items]).where(F.size(LEAKS) == 0).drop(LEAKS)
    return documents


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
