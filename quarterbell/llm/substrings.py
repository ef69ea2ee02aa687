"""Removal of repeated passages: seed, extend, keep maximal repeats.

1. *Seeds.* In every window of 20 words the 5-gram with the least hash is its
   anchor (winnowing). Equal windows have equal anchors, so documents meet on
   anchors: one row for some six words instead of one for each window.
2. *Extension.* Consecutive windows with one anchor form a stretch. Two
   stretches that meet on an anchor are compared as far as they reach on both
   sides by the hash of their whole content. Of equal stretches only the
   earliest stays; the others are repeats as a whole.
3. *Ends of repeats.* Where different stretches share an anchor, a repeat may
   end inside them: only there single windows are compared.
4. The union of repeated windows is removed from each document, so what goes
   are the maximal repeats of 20 words or more.

A third of all documents may share an anchor. Each piece of text (4 MB) sends
one row for equal stretches and settles the rest itself. An anchor that stands in
many different contexts is found beforehand, by a pass that counts: if some piece
has 64 contexts of it, and such pieces a 65,536th of all stretches, its stretches
are known to differ and are dealt by anchor and content. So no task orders more
rows of one key than a row for each piece (dealt by content), or 64 of each piece and
a 65,536th of all (dealt by anchor); they are sorted with spill, never
collected. Comparisons use 128 bits (anchor and content).

Results in the odd cases: a null or empty text has no words and the checksum
of the empty text; a text longer than a piece is a piece by itself, worked on whole; of equal
passages at one place in the order (ties) each row of the document gets the same result; repeated rows of one id and text are one document and each
get its result; rows of one id with different texts are told apart by the text's hash;
rows without an id come after all others; an empty table gives no
rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterbell.llm import tokens as T
from quarterbell.llm.tables import document_key, saved, table

#: Words of a window.
LENGTH = 20
#: Words of an anchor.
SEED = 5
#: Contexts of an anchor in one piece of text that make it crowded, and the share of all stretches above which it is dealt by content.
CROWD, SHARE = 64, 65536

# A run of windows in one number: hash of the text, first word, number of windows.
_COUNT_BITS, _TAG_BITS = 5, 27
_START_BITS = 63 - _COUNT_BITS - _TAG_BITS

_ROWS = pa.schema([("place", pa.int64()), ("content", pa.int64()), ("doc", pa.int64()), ("run", pa.int64()), ("settled", pa.bool_())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _tags(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("tag").to_numpy(zero_copy_only=False).astype(np.int64)


def _settle(place, content, doc, run) -> pa.RecordBatch:
    """Rows of one piece of text; of those with one place and content all but the earliest are settled as repeats."""
    order = np.lexsort((run, doc, content, place))
    place, content, doc, run = place[order], content[order], doc[order], run[order]
    once = np.ones(len(order), bool)  # a repeated row of the table is no earlier document
    once[1:] = (run[1:] != run[:-1]) | (doc[1:] != doc[:-1]) | (place[1:] != place[:-1])
    place, content, doc, run = place[once], content[once], doc[once], run[once]
    settled = np.zeros(len(place), bool)
    settled[1:] = (place[1:] == place[:-1]) & (content[1:] == content[:-1])
    # a settled row needs to meet no other: it goes anywhere
    place = np.where(settled, T.mix(place ^ T.mix(doc.view(np.uint64) + run.view(np.uint64))), place)
    return T.table_of(_ROWS, place=T.signed(place), content=T.signed(content), doc=doc, run=run, settled=settled)


def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each run of windows with one anchor."""
    reach = LENGTH - SEED + 1
    for batch in T.chunks(batches):
        words = T.words_of(batch.column("text"))
        if len(words) < LENGTH:
            continue
        hashes, room = words.hashes(), words.room
        least = T.grams(hashes, SEED)
        windows = T.grams(hashes, LENGTH)
        seeds, at, seen = least, np.arange(len(words)), 1
        while seen < reach:  # the leftmost least value of up to twice as many each time
            later = np.minimum(np.arange(len(words)) + min(seen, reach - seen), len(words) - 1)
            smaller = least[later] < least
            at, least = np.where(smaller, at[later], at), np.where(smaller, least[later], least)
            seen += min(seen, reach - seen)
        whole = room >= LENGTH
        begins = whole.copy()
        begins[1:] &= ~(whole[:-1] & (at[1:] == at[:-1]))
        first = np.flatnonzero(begins)
        if not len(first):
            continue
        ends = whole.copy()
        ends[:-1] &= ~whole[1:] | (at[1:] != at[:-1])
        last = np.flatnonzero(ends)
        count = last - first + 1
        owner = words.owner[first]
        run = (_tags(batch)[owner] << (_START_BITS + _COUNT_BITS)) | ((first - words.first[owner]) << _COUNT_BITS) | count
        # first and last window overlap: with their distance they stand for all words of the run
        content = T.mix(windows[first] * np.uint64(3) + T.mix(windows[last] + count.astype(np.uint64)))
        yield _settle(seeds[at[first]], content, batch.column("doc").to_numpy()[owner], run)


def crowds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """place, n: anchors with many different contexts in one piece of text, and without a place the number of all stretches."""
    for rows in stretches(batches):
        place = rows.column("place").filter(pc.invert(rows.column("settled"))).to_numpy()
        each, n = np.unique(place, return_counts=True)
        crowded = n >= CROWD
        yield pa.RecordBatch.from_pydict({
            "place": pa.array([None, *each[crowded].tolist()], pa.int64()), "n": pa.array([len(place), *n[crowded].tolist()], pa.int64())})


def windows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each window of the given runs of a document."""
    for batch in T.chunks(b.filter(b.column("runs").is_valid()) for b in batches):
        words = T.words_of(batch.column("text"))
        owner, runs = _runs(batch)
        start, count = _places(words, owner, runs)
        if not len(start):
            continue
        steps = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        at, doc = np.repeat(start, count) + steps, np.repeat(owner, count)
        place = T.grams(words.hashes(), LENGTH)[at]
        run = (_tags(batch)[doc] << (_START_BITS + _COUNT_BITS)) | ((at - words.first[doc]) << _COUNT_BITS) | 1
        yield _settle(place, np.zeros(len(at), np.uint64), batch.column("doc").to_numpy()[doc], run)


def _runs(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Document and run of each run that belongs to a document's text."""
    lists = batch.column("runs")
    runs = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    own = runs >> (_START_BITS + _COUNT_BITS) == _tags(batch)[owner]
    return owner[own], runs[own]


def _places(words: T.Words, owner: np.ndarray, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word and number of windows of each run."""
    return words.first[owner] + ((runs >> _COUNT_BITS) & ((1 << _START_BITS) - 1)), runs & ((1 << _COUNT_BITS) - 1)


def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each document."""
    for batch in T.chunks(batches):
        words = T.words_of(batch.column("text"))
        start, count = _places(words, *_runs(batch))
        covered = np.zeros(len(words) + 1, np.int64)
        np.add.at(covered, start, 1)
        np.add.at(covered, start + count + LENGTH - 1, -1)
        gone = np.cumsum(covered)[:-1] > 0
        removed = np.concatenate([[0], np.cumsum(gone)])
        n_removed = removed[words.first[1:]] - removed[words.first[:-1]]
        digests = []
        for text, n, (low, high) in zip(batch.column("text").to_pylist(), n_removed, zip(words.first[:-1], words.first[1:])):
            left = (text or "").encode().split()
            if n:
                left = [left[i] for i in np.flatnonzero(~gone[low:high])]
            digests.append(hashlib.sha256(b" ".join(left)).hexdigest())
        yield T.table_of(_KEPT, doc_id=batch.column("doc_id"), n_words=words.counts, n_removed=n_removed, kept_sha256=pa.array(digests, pa.string()))


_SCHEMA = "place long, content long, doc long, run long, settled boolean"


def _crowded(texts: DataFrame) -> DataFrame:
    """Anchors that are dealt by content: as each has its share of all stretches, there are no more than ``SHARE``."""
    counts = saved(texts.mapInArrow(crowds, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")), "crowded-anchors")
    every = counts.where("place IS NULL").agg(F.sum("n")).first()[0] or 0
    return counts.where(F.col("place").isNotNull() & (F.col("n") * F.lit(SHARE) >= F.lit(every))).select("place")


#: What is known of a stretch before it meets others: nothing, that it is a repeat, that its anchor has other contents.
OPEN, SETTLED, CROWDED = 0, 1, 2


def dealt(rows: DataFrame, crowded: DataFrame) -> DataFrame:
    """The rows with ``known``; those of crowded anchors get a place of their own for each content.

    Both passes over the result read the same columns of it, so that one exchange serves them.
    """
    marked = rows.join(F.broadcast(crowded.withColumn("crowded", F.lit(True))), "place", "left")
    known = F.when(F.col("settled"), SETTLED).when(F.col("crowded"), CROWDED).otherwise(OPEN)
    return marked.withColumn("known", known).select(
        F.when(F.col("known") == CROWDED, F.xxhash64("place", "content")).otherwise(F.col("place")).alias("place"), "content", "doc", "run", "known")


def _judged(rows: DataFrame) -> DataFrame:
    """Which runs are repeats, and which need a look at their windows: those whose anchor has another content too."""
    of_place = Window.partitionBy("place")
    before = F.lag(F.struct("content", "doc", "run")).over(of_place.orderBy("content", "doc", "run"))
    return (
        rows.withColumn("before", before)
        .withColumn("other", (F.col("known") == CROWDED) | (F.max("content").over(of_place) != F.min("content").over(of_place)))
        .withColumn("repeat", (F.col("known") == SETTLED) | F.coalesce(
            F.expr("before.content = content AND (before.doc <> doc OR before.run <> run)"), F.lit(False)))
        .where("repeat OR other")
        .select("doc", "run", "repeat")
    )


def without_repeats(documents: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the checksum of the kept words of every document."""
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        document_key(F.col("doc_id"), F.col("text")).alias("doc"),
        F.shiftrightunsigned(F.xxhash64("text"), 64 - _TAG_BITS).alias("tag"),
    )

    def with_runs(runs: DataFrame) -> DataFrame:
        """The same columns of documents each time, so that one exchange serves both passes over them."""
        lists = runs.groupBy("doc").agg(F.collect_list("run").alias("runs"))
        return texts.join(lists, "doc", "left").select("doc_id", "doc", "tag", "text", "runs")

    pieces = texts.select("doc", "tag", "text")
    judged = _judged(dealt(pieces.mapInArrow(stretches, _SCHEMA), _crowded(pieces)))
    windows = with_runs(judged.where("NOT repeat")).mapInArrow(windows_of, _SCHEMA)
    in_order = Window.partitionBy("place").orderBy("doc", "run")
    windows = (
        windows.withColumn("first_doc", F.first("doc").over(in_order)).withColumn("first_run", F.first("run").over(in_order))
        .where("settled OR first_doc <> doc OR first_run <> run")
    )
    repeats = judged.where("repeat").select("doc", "run").unionByName(windows.select("doc", "run"))
    return with_runs(repeats).mapInArrow(keep, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def op2_remove_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))
