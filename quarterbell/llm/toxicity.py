"""Toxicity by class-conditional Kneser-Ney models.

Two models of the characters of a word, one of toxic and one of ordinary
texts, share their lower orders: a byte after two others and more is predicted
from the class's own interpolated Kneser-Ney counts, and rare expressions back
off to counts of both classes together. There both models agree and a word says nothing.
The log-likelihood ratios of a document's words (their mean, the largest of a
distinct word, and what suspicious words exceed, by the root of the distinct
words) and a logistic curve fitted on labelled texts that the counts have not
seen give a score between 0 and 1. A short passage has no ratio of its own.

Labels are learned from at most ``most_per_class`` texts of each class, those
with the least hash, so the model has a size bound and can be sent to every
task. Scoring reads every document once and shuffles nothing.

Results in the odd cases: null and empty texts are scored as texts without
words (ratios 0); a row of ``labels`` without id or label is not used, and if
an id is labelled twice, toxic wins; without two texts of each class (one to
count and one to fit on) every score is 0; a null id counts as held out = false; repeated rows give repeated
results; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types

from quarterbell.llm import tokens as T
from quarterbell.llm.tables import table

#: Bytes of the longest expression; the first ``SHARED`` orders use counts of both classes.
ORDER, SHARED = 6, 2
#: Labelled texts of each class that are learned from, at most.
MOST_PER_CLASS = 10_000
#: Of ten sampled texts so many are counted; the curve is fitted on the others.
COUNTED_TENTHS = 7
#: Ratios from which a word is suspicious; what exceeds them is summed.
SUSPICIOUS = (2.0, 3.0, 4.0)
#: A document is toxic from this score on.
REJECT_FROM = 0.7
DISCOUNT = 0.9

_BEGIN, _END = 1, 2  # bytes that no word has
SCORE = "_toxicity_score"


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 3 == 1, F.lit(False))


class Spelling:
    """The bytes of distinct words between marks, and the expressions that end at each."""

    def __init__(self, words: T.Words, which: np.ndarray):
        size = (words.end - words.start)[which] + 2
        stop = np.cumsum(size)
        self.begin = stop - size
        flat = np.arange(stop[-1] if len(stop) else 0)
        self.word = np.repeat(np.arange(len(which)), size)
        self.place = flat - self.begin[self.word]
        self.bytes = np.full(len(flat), _END, np.uint64)
        self.bytes[self.begin] = _BEGIN
        inner = (self.place > 0) & (self.place < size[self.word] - 1)
        source = words.start[which][self.word] + self.place - 1
        self.bytes[inner] = words.data[source[inner]]

    def ending(self, n: int, at: np.ndarray) -> np.ndarray:
        """Keys of the expressions of n bytes that end at the given places."""
        key = np.full(len(at), n << 56, np.uint64)
        for k in range(n):
            key |= self.bytes[at - k] << np.uint64(8 * k)
        return key


def _once(words: T.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the different words of each document: the document, which word; and one place of each different word."""
    hashes, owner = words.hashes(), words.owner
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    new = np.ones(len(order), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    _, which, word = np.unique(hashes[at], return_index=True, return_inverse=True)
    return owner[at], word, order[at[which]]


def _expressions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many toxic and ordinary texts words with each expression occur."""
    for batch in T.chunks(batches):
        words = T.words_of(batch.column("text"), T.LETTERS, lower=True)
        if not len(words):
            continue
        owner, word, which = _once(words)
        toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.float64)[owner]
        spelling = Spelling(words, which)
        weight = np.stack([np.bincount(word, w, len(which)) for w in (toxic, 1 - toxic)])
        keys, counts = [], []
        for n in range(1, ORDER + 1):
            at = np.flatnonzero(spelling.place >= max(1, n - 1))
            key, of = np.unique(spelling.ending(n, at), return_inverse=True)
            keys.append(key)
            counts.append(np.stack([np.bincount(of, w[spelling.word[at]], len(key)) for w in weight]))
        key, count = np.concatenate(keys), np.concatenate(counts, axis=1).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"key": T.signed(key), "toxic": count[0], "ordinary": count[1]})


def _order(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(56)).astype(np.int64)


def _context(keys: np.ndarray, n: int) -> np.ndarray:
    """The expression without its last byte."""
    return ((keys & np.uint64((1 << 56) - 1)) >> np.uint64(8)) | np.uint64((n - 1) << 56)


def _shorter(keys: np.ndarray, n: int) -> np.ndarray:
    """The expression without its first byte."""
    return (keys & np.uint64((1 << (8 * (n - 1))) - 1)) | np.uint64((n - 1) << 56)


def _sums(keys: np.ndarray, at: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return np.bincount(np.searchsorted(keys, at), weights, len(keys))


class Ratios:
    """Log-likelihood ratios of expressions; of those not seen, by their context."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        """counts: of each key in toxic and in ordinary texts."""
        order = np.argsort(keys)
        keys, counts = keys[order], counts[:, order].astype(np.float64)
        orders = _order(keys)
        tables = {n: (keys[orders == n], counts[:, orders == n]) for n in range(1, ORDER + 1)}
        self.seen, self.ratio, self.contexts, self.left = {}, {}, {}, {}
        below = None
        for n in range(1, ORDER + 1):
            own, raw = tables[n]
            used = raw.copy()
            if n < ORDER:  # in how many contexts it is seen; as often as it is seen if nothing can precede it
                longer, of_longer = tables[n + 1]
                begins = (own >> np.uint64(8 * (n - 1))) & np.uint64(0xFF) == _BEGIN
                for c in (0, 1):
                    if len(longer):
                        used[c] = np.where(begins, raw[c], _sums(own, _shorter(longer, n + 1), (of_longer[c] > 0).astype(float)))
            if n <= SHARED:
                used = np.broadcast_to(used.sum(axis=0), used.shape)
            context, of = np.unique(_context(own, n), return_inverse=True)
            chance, rest = np.zeros(used.shape), np.ones((2, len(context)))
            lower = np.full(used.shape, 1 / 256) if n == 1 else below[:, np.searchsorted(tables[n - 1][0], _shorter(own, n))]
            for c in (0, 1):
                total = np.bincount(of, used[c], len(context))
                kinds = np.bincount(of, used[c] > 0, len(context))
                rest[c] = np.where(total > 0, DISCOUNT * kinds / np.maximum(total, 1), 1)
                part = np.where(total[of] > 0, np.maximum(used[c] - DISCOUNT, 0) / np.maximum(total[of], 1), 0)
                chance[c] = part + rest[c][of] * lower[c]
            below = chance
            if n > SHARED:
                self.seen[n], self.ratio[n] = own, np.log(chance[0] / chance[1]).astype(np.float32)
                self.contexts[n], self.left[n] = context, np.log(rest[0] / rest[1]).astype(np.float32)

    def of_words(self, words: T.Words, which: np.ndarray) -> np.ndarray:
        """The ratio of each of the given words."""
        spelling = Spelling(words, which)
        open_at = np.flatnonzero(spelling.place > 0)
        value = np.zeros(len(spelling.bytes))
        for n in range(ORDER, SHARED, -1):
            at = open_at[spelling.place[open_at] >= n - 1]
            rest = open_at[spelling.place[open_at] < n - 1]
            if not len(at) or not len(self.seen[n]):
                continue
            key = spelling.ending(n, at)
            found = np.minimum(np.searchsorted(self.seen[n], key), len(self.seen[n]) - 1)
            hit = self.seen[n][found] == key
            value[at[hit]] += self.ratio[n][found[hit]]
            missed, context = at[~hit], _context(key[~hit], n)
            found = np.minimum(np.searchsorted(self.contexts[n], context), len(self.contexts[n]) - 1)
            known = self.contexts[n][found] == context
            value[missed[known]] += self.left[n][found[known]]
            open_at = np.concatenate([missed, rest])
        return np.bincount(spelling.word, value, len(which))


#: Features of a document.
N_FEATURES = 3 + len(SUSPICIOUS)


def _features(ratios: Ratios, words: T.Words) -> np.ndarray:
    """For each document: the mean and the largest ratio of its words, what exceeds each level, and its length."""
    docs = len(words.first) - 1
    out = np.zeros((docs, N_FEATURES))
    if not len(words):
        return out
    owner, word, which = _once(words)
    ratio = ratios.of_words(words, which)[word]
    n = np.bincount(owner, minlength=docs)
    out[:, 0] = np.bincount(owner, ratio, docs) / np.maximum(n, 1)
    most = np.full(docs, -np.inf)
    np.maximum.at(most, owner, ratio)
    out[:, 1] = np.where(n > 0, most, 0)
    for k, level in enumerate(SUSPICIOUS):
        out[:, 2 + k] = np.bincount(owner, np.maximum(ratio - level, 0), docs) / np.sqrt(n + 1)
    out[:, -1] = np.log1p(n)
    return out


def _featured(model) -> "callable":
    def featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            found = _features(model.value, T.words_of(batch.column("text"), T.LETTERS, lower=True))
            yield pa.RecordBatch.from_pydict({"toxic": batch.column("toxic"), **{f"x{k}": found[:, k] for k in range(N_FEATURES)}})

    return featured


class Curve:
    """A logistic curve over standardised features, fitted with a small ridge by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._with_one(x)
        self.beta = np.zeros(z.shape[1])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(z @ self.beta, -30, 30)))
            slope = z.T @ (weight * (y - p)) - ridge * np.r_[self.beta[:-1], 0]
            bend = (z * (weight * p * (1 - p) + 1e-9)[:, None]).T @ z + ridge * np.diag(np.r_[np.ones(len(self.beta) - 1), 1e-9])
            step = np.linalg.solve(bend, slope)
            self.beta += step
            if np.abs(step).max() < 1e-8:
                break

    def _with_one(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([(x - self.mean) / self.scale, np.ones(len(x))])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._with_one(x) @ self.beta, -30, 30)))


def learn(documents: DataFrame, labels: DataFrame, most_per_class: int = MOST_PER_CLASS):
    """(ratios, curve) in a broadcast, or None if a class has no text."""
    spark = documents.sparkSession
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .withColumn("by", F.xxhash64("doc_id"))
    )
    shares = {r.toxic: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(shares) < 2:
        return None
    sample = known.where("toxic = 1").orderBy("by").limit(most_per_class).unionByName(
        known.where("toxic = 0").orderBy("by").limit(most_per_class))
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # the sample has a bounded number of ids
    texts = texts.join(F.broadcast(sample), "doc_id")
    tenth = F.pmod("by", F.lit(10))
    # the first text of a class is always counted, and the last never
    ends = texts.groupBy("toxic").agg(F.min(F.struct(tenth, "by"))["by"].alias("first"), F.max(F.struct(tenth, "by"))["by"].alias("last")).collect()
    first, last = [r["first"] for r in ends], [r["last"] for r in ends]
    texts = texts.withColumn("counted", F.col("by").isin(first) | ((tenth < COUNTED_TENTHS) & ~F.col("by").isin(last)))
    counts = (
        texts.where("counted").select("text", "toxic").mapInArrow(_expressions, "key long, toxic long, ordinary long")
        .groupBy("key").agg(F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")).toArrow()
    )
    if not counts.num_rows:
        return None
    ratios = Ratios(
        counts["key"].to_numpy().view(np.uint64), np.stack([counts["toxic"].to_numpy(), counts["ordinary"].to_numpy()]))
    shared = spark.sparkContext.broadcast(ratios)
    fit = texts.where("NOT counted").select("text", "toxic").mapInArrow(
        _featured(shared), "toxic int, " + ", ".join(f"x{k} double" for k in range(N_FEATURES))).toArrow()
    y = fit["toxic"].to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None
    x = np.column_stack([fit[f"x{k}"].to_numpy() for k in range(N_FEATURES)])
    order = np.lexsort((*x.T, y))  # the same sums whatever the order of arrival
    x, y = x[order], y[order]
    weight = np.where(y == 1, shares[1] / y.sum(), shares[0] / (len(y) - y.sum()))
    return shared, Curve(x, y, weight * len(y) / weight.sum())


def with_score(documents: DataFrame, model) -> DataFrame:
    """The documents with a column SCORE."""
    if model is None:
        return documents.withColumn(SCORE, F.lit(0.0))
    ratios, curve = model

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            found = curve(_features(ratios.value, T.words_of(batch.column("text").cast(pa.string()), T.LETTERS, lower=True)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], names=[*batch.schema.names, SCORE])

    return documents.mapInArrow(score, types.StructType([*documents.schema.fields, types.StructField(SCORE, types.DoubleType())]))


def score_toxicity(documents: DataFrame, labels: DataFrame, most_per_class: int = MOST_PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = learn(documents, labels, most_per_class)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return with_score(texts, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(SCORE).alias("score"),
        (F.col(SCORE) >= REJECT_FROM).cast("int").alias("predicted"),
    )


def without_toxic(documents: DataFrame, labels: DataFrame, most_per_class: int = MOST_PER_CLASS) -> DataFrame:
    """The documents that are not rejected, as they are."""
    model = learn(documents, labels, most_per_class)
    return with_score(documents, model).where(F.col(SCORE) < REJECT_FROM).select(*documents.columns)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
