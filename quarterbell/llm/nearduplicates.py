"""Near-duplicate documents: ProbMinHash, bands, and exact verification.

Two documents are linked if the sets of their five-word shingles have a
Jaccard similarity of 0.8 or more; a class is what links connect.

1. *Copies.* Equal texts are one node from the start.
2. *Sketches.* The shingles of a text arrive in 128 registers as Poisson
   processes, faster for shingles that occur more often (weight 1 + ln n). A
   register keeps the first arrival; a text stops once no arrival can be first
   any more. Registers of two texts agree with their probability Jaccard
   similarity, which is the Jaccard similarity if the weights are equal. A
   text in which a shingle occurs again gets a second sketch with weight 1 for
   each shingle; in any other text that sketch is the first.
3. *Bands.* Texts that agree in 4 registers in a row of any of their sketches
   meet. At a Jaccard similarity of 0.8 a pair misses the 32 bands of the
   sketches with weight 1 with a probability of 5e-8, whatever the weights do.
4. *Stars.* Where many meet, each is compared with the one that meets most
   others, so a bucket costs as many comparisons as it has texts.
5. *The rest, exactly.* Where texts of a bucket are still in different
   components, all pairs that can reach 0.8 are found by a set-similarity
   join of these texts (rarest shingles first; prefix, size and position
   filters) and compared. Nothing is capped or sampled.

Results in the odd cases: a text of one to four words is one shingle; null and
empty texts have none and are their own classes; very long texts are compared
whole; of equal rows of an id one stays. Rows of one id with different texts
are different documents: the text of least checksum has the id as its number,
each other one a number of its own above 2^62, which is also its class_id if it
comes first in its class. A document without id gets a number of its text's hash,
above 2^62. Where several documents could stay, the one of least number does. An
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarterbell.llm import tokens as T
from quarterbell.llm.components import components
from quarterbell.llm.tables import document_key, saved, table

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4


def shingles(words: T.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, times) of the distinct shingles of each document."""
    hashes, room, counts = words.hashes(), words.room, words.counts
    whole = np.flatnonzero(room >= SHINGLE)
    owners, values = [words.owner[whole]], [T.grams(hashes, SHINGLE)[whole]]
    for n in range(1, SHINGLE):
        short = np.flatnonzero(counts == n)
        owners.append(short)
        values.append(T.seeded(T.grams(hashes, n)[words.first[:-1][short]], n))
    owner, value = np.concatenate(owners), np.concatenate(values)
    order = np.lexsort((value, owner))
    owner, value = owner[order], value[order]
    new = np.ones(len(owner), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    at = np.flatnonzero(new)
    return owner[at], value[at], np.diff(np.append(at, len(owner)))


def sketches(owner: np.ndarray, value: np.ndarray, weight: np.ndarray, docs: int, registers: int) -> np.ndarray:
    """The first arrival in each register of each document: the shingle, or 0 in documents without shingles."""
    first = np.full(docs * registers, np.inf)
    kept = np.zeros(docs * registers, np.uint64)
    active = np.arange(len(owner))
    time = np.zeros(len(owner))
    rounds = 0
    while len(active):
        e = value[active]
        random = T.seeded(e, 2 * rounds)
        time[active] -= np.log1p(-(random >> np.uint64(11)).astype(np.float64) / 2**53) / weight[active]
        at = owner[active] * registers + (T.seeded(e, 2 * rounds + 1) % np.uint64(registers)).astype(np.int64)
        sooner = np.flatnonzero(time[active] < first[at])
        np.minimum.at(first, at[sooner], time[active[sooner]])
        won = sooner[time[active[sooner]] == first[at[sooner]]]
        kept[at[won]] = e[won]
        latest = first.reshape(docs, registers).max(axis=1)
        active = active[time[active] < latest[owner[active]]]
        rounds += 1
    return kept.reshape(docs, registers)


def _bands(kept: np.ndarray) -> np.ndarray:
    """The bands of sketches."""
    kept = kept.reshape(len(kept), BANDS, ROWS)
    band = T.seeded(np.arange(BANDS, dtype=np.uint64), 7)[None, :] + np.zeros((len(kept), 1), np.uint64)
    for k in range(ROWS):
        band = T.mix(band * np.uint64(5) + kept[:, :, k])
    return band


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches):
        words = T.words_of(batch.column("text"))
        owner, value, times = shingles(words)
        docs = batch.num_rows
        some, again = words.counts > 0, np.zeros(docs, bool)
        again[owner[times > 1]] = True
        band = np.zeros((docs, 2 * BANDS), np.uint64)
        band[:, :BANDS] = _bands(sketches(owner, value, 1 + np.log(times), docs, BANDS * ROWS))
        # equal weights give the same registers, so only texts with repeated shingles need the second
        of, number = again[owner], np.cumsum(again) - 1
        band[again, BANDS:] = _bands(sketches(number[owner[of]], value[of], np.ones(int(of.sum())), int(again.sum()), BANDS * ROWS))
        used = np.repeat(np.stack([some, again], axis=1), BANDS, axis=1)
        bands = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(used.sum(axis=1))]).astype(np.int32), T.signed(band[used]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("doc"), batch.column("copy"), bands], names=["doc_id", "doc", "copy", "bands"])


def _shingle_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches):
        owner, value, _ = shingles(T.words_of(batch.column("text")))
        edges = np.searchsorted(owner, np.arange(batch.num_rows + 1)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([batch.column("doc"), pa.ListArray.from_arrays(edges, T.signed(value))], names=["doc", "shingles"])


def _verified(pairs: DataFrame, lists: DataFrame) -> DataFrame:
    """The pairs (a, b) that are similar enough."""
    left = lists.select(F.col("doc").alias("a"), F.col("shingles").alias("of_a"))
    right = lists.select(F.col("doc").alias("b"), F.col("shingles").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    near_size = F.least(F.size("of_a"), F.size("of_b")) >= SIMILARITY * F.greatest(F.size("of_a"), F.size("of_b"))
    # 0.8 as a fraction: 5 * both >= 4 * either, in whole numbers
    return pairs.join(left, "a").join(right, "b").where(near_size & (9 * both >= 4 * (F.size("of_a") + F.size("of_b")))).select("a", "b")


def _undecided(meeting: DataFrame, classes: DataFrame) -> DataFrame:
    """doc, component of the texts that meet one of another component."""
    placed = meeting.join(classes, F.col("doc") == F.col("node"), "left").withColumn("component", F.coalesce("component", "doc"))
    placed = saved(placed.select("band", "doc", "component"), "near-placed")
    mixed = placed.groupBy("band").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("band")
    return placed.join(mixed, "band").select("doc", "component").distinct()


def _possible_pairs(undecided: DataFrame, lists: DataFrame) -> DataFrame:
    """Pairs of different components that can be similar enough, by prefix, size and position."""
    each = undecided.join(lists, "doc").select("doc", "component", F.size("shingles").alias("n"), F.explode("shingles").alias("shingle"))
    each = saved(each, "near-shingles-of-rest")
    frequency = each.groupBy("shingle").agg(F.count("*").alias("docs"))
    ranked = each.join(frequency, "shingle").withColumn(
        "place", F.row_number().over(Window.partitionBy("doc").orderBy("docs", "shingle")))
    # a pair that reaches 0.8 shares one of the first n - ceil(0.8 n) + 1
    prefix = saved(
        ranked.where((F.col("docs") > 1) & (F.col("place") <= F.col("n") - F.ceil(F.col("n") * 4 / 5) + 1))
        .select("shingle", "doc", "component", "n", "place"),
        "near-prefixes",
    )
    # the members of the component most frequent at a shingle need not meet each other
    most = prefix.groupBy("shingle", "component").agg(F.count("*").alias("c")).groupBy("shingle").agg(F.max_by("component", "c").alias("most"))
    x = prefix.join(most, "shingle").where("component <> most").select(
        "shingle", F.col("doc").alias("x"), F.col("component").alias("x_of"), F.col("n").alias("x_n"), F.col("place").alias("x_at"))
    y = prefix.select("shingle", F.col("doc").alias("y"), F.col("component").alias("y_of"), F.col("n").alias("y_n"), F.col("place").alias("y_at"))
    joined = x.join(y, "shingle").where(
        (F.col("x_of") != F.col("y_of"))
        & (5 * F.least("x_n", "y_n") >= 4 * F.greatest("x_n", "y_n"))
        & (9 * (1 + F.least(F.col("x_n") - F.col("x_at"), F.col("y_n") - F.col("y_at"))) >= 4 * (F.col("x_n") + F.col("y_n")))
    )
    return joined.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def has_repeats(rows: DataFrame) -> bool:
    """Whether a document has several rows."""
    return not rows.groupBy("doc").count().where("count > 1").isEmpty()


def _digest(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _several_texts(rows: DataFrame) -> DataFrame:
    """_near_id, _near_own: the ids that stand for different texts, and the text that keeps the id."""
    least = rows.groupBy(F.col("doc").alias("_near_id")).agg(F.min("copy").alias("_near_own"), F.max("copy").alias("most"))
    return saved(least.where("_near_own <> most").drop("most"), "near-several")


def _apart(rows: DataFrame, several: DataFrame, doc: str, copy: str) -> DataFrame:
    """The rows with a number of its own for each text of an id; but for one text of an id it lies after all ids below 2^62."""
    own = F.lit(2**62) + F.shiftrightunsigned(F.xxhash64(doc, copy), 2)
    rows = rows.join(several, F.col(doc) == F.col("_near_id"), "left")
    number = F.when(F.col("_near_own") != F.col(copy), own).otherwise(F.col(doc))
    return rows.withColumn(doc, number).drop("_near_id", "_near_own")


def near_duplicates(documents: DataFrame) -> DataFrame:
    """doc_id, doc (the number of the document), class_id and kept: a row for each row of the documents."""
    return _classes(documents)[0]


def _classes(documents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """What ``near_duplicates`` gives, and the ids that stand for several texts if there are any."""
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        document_key(F.col("doc_id"), F.col("text")).alias("doc"))
    rows = saved(
        texts.withColumn("copy", _digest(F.col("text")))
        .mapInArrow(_sketch, "doc_id long, doc long, copy binary, bands array<long>"),
        "near-sketches",
    )
    several: DataFrame | None = _several_texts(rows)
    if several.isEmpty():
        several = None
    else:
        rows = saved(_apart(rows, several, "doc", "copy"), "near-sketches-apart")
        texts = _apart(texts.withColumn("copy", _digest(F.col("text"))), several, "doc", "copy")
    with_words = rows.where(F.size("bands") > 0)
    firsts = with_words.groupBy("copy").agg(F.min("doc").alias("first"))
    copies = saved(with_words.select("doc", "copy").join(firsts, "copy").select("doc", "first").distinct(), "near-copies")
    nodes = with_words.join(copies.where("doc = first").select("doc").distinct(), "doc", "left_semi")
    bands = nodes.select("doc", F.explode("bands").alias("band")).distinct()
    full = bands.groupBy("band").agg(F.count("*").alias("texts")).where("texts > 1")
    meeting = saved(bands.join(full, "band"), "near-bands")
    central = meeting.groupBy("doc").agg(F.sum("texts").alias("met"))
    met = meeting.select("band", "doc").join(central, "doc")
    centres = met.groupBy("band").agg(F.max_by("doc", "met").alias("centre"))
    stars = saved(
        meeting.select("band", "doc").join(centres, "band").where("doc <> centre")
        .select(F.least("doc", "centre").alias("a"), F.greatest("doc", "centre").alias("b")).distinct(),
        "near-stars",
    )
    meeting = meeting.select("band", "doc")
    lists = saved(
        texts.select("doc", "text").join(meeting.select("doc").distinct(), "doc", "left_semi").mapInArrow(_shingle_lists, "doc long, shingles array<long>"),
        "near-shingles",
    )
    if has_repeats(rows):
        lists = saved(lists.dropDuplicates(["doc"]), "near-shingles-once")
    links = saved(_verified(stars, lists), "near-links")
    classes = components(links)
    more = _verified(_possible_pairs(_undecided(meeting, classes), lists), lists)
    known = classes.where("node <> component").select(F.col("node").alias("a"), F.col("component").alias("b"))
    same = copies.where("doc <> first").select(F.col("doc").alias("a"), F.col("first").alias("b"))
    classes = components(known.unionByName(more).unionByName(same))
    found = rows.select("doc_id", "doc").join(classes, F.col("doc") == F.col("node"), "left").select(
        "doc_id", "doc", F.coalesce("component", "doc").alias("class_id"), (F.coalesce("component", "doc") == F.col("doc")).alias("kept"))
    return found, several


def without_near_duplicates(documents: DataFrame) -> DataFrame:
    """One document of each class, that of the least number, as it is."""
    found, several = _classes(documents)
    found = saved(found, "near-classes")
    out = documents.withColumn("_near_doc", document_key(F.col("doc_id"), F.col("text").cast("string")))
    if several is not None:
        out = _apart(out.withColumn("_near_copy", _digest(F.col("text").cast("string"))), several, "_near_doc", "_near_copy")
    gone = found.where("NOT kept").select(F.col("doc").alias("_near_doc")).distinct()
    out = out.join(gone, "_near_doc", "left_anti")
    if has_repeats(found):
        out = out.dropDuplicates(["_near_doc"])
    return out.select(*documents.columns)


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "kept")
