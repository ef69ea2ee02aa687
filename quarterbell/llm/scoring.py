"""Language-model scores by cross-entropy difference.

A target model of good texts and a background model of all texts are word
bigram models of the same make: one vocabulary, one set of pairs, absolute
discounting and add-one unigrams. A document's score is its loss per token
under the target model less that under the background model; the lower, the
more it resembles the target.

Words and pairs are counted over all documents, and all seen ``LEAST`` times or
more are in the models; a pair seen less often backs off to its word, and words seen
less often are one number together. After any context the chances of all words of the vocabulary and
of that one number sum to one. Target texts are all those labelled good.

1. Documents are dealt into pieces of bounded text, one row each.
2. A piece sends its distinct words and pairs, sorted, in parts to the buckets of their ranges, as blobs with counts.
3. A bucket adds the counts up and answers each part in its order: the counts
   of what the models keep, and for one piece of each key that it stands for it.
4. For the pairs a piece stands for, it sends what discounting takes from
   their first words; buckets add that up and answer in the same way.
5. A piece puts the answers beside its own keys and scores its documents.

Nothing of the models' size is held by the driver or a task, and an answer needs no key.

Results in the odd cases: a document without words has 0 tokens and null
losses; unlabelled and null-labelled documents are background only; if an id
is labelled twice, the higher counts; without target texts both
models are uniform over what the target has not seen; a very long text is a piece of its own; repeated rows give repeated results; an empty table
gives no rows; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbell.llm import tokens as T
from quarterbell.llm.suffixes import _pack, _unpack
from quarterbell.llm.tables import saved, shuffles_dropped, table

DISCOUNT = 0.75
#: Least count of a word or a pair in the models.
LEAST = 2
#: Text of a piece; a longer text is a piece of its own.
PIECE_BYTES = 8 << 20
#: Text for each bucket of keys: some 1.5 million entries.
BUCKET_BYTES = 12 << 20
#: Keys that are no words: documents that have words (the context of their first word), and all tokens.
START, TOKENS = 1, 2

_PIECES_SQL = "piece long, doc_id array<long>, text array<string>, target array<int>"
_PARTS = pa.schema([("bucket", pa.int64()), ("piece", pa.int64()), ("n", pa.int64()), ("part", pa.binary())])
_PARTS_SQL = "bucket long, piece long, n long, part binary"
_TOTALS = ("words", "kept_n", "kept_target", "all_n", "all_target")
_ANSWERS = pa.schema([*_PARTS, *[(c, pa.int64()) for c in _TOTALS]])
_ANSWERS_SQL = _PARTS_SQL + "".join(f", {c} long" for c in _TOTALS)
_SCORES_SQL = "doc_id long, n_tokens long, target_loss double, background_loss double, difference double"


def _in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    piece = TaskContext.get().partitionId() << 32
    for batch in T.chunks(batches, most=PIECE_BYTES):
        edges = pa.array([0, batch.num_rows], pa.int32())
        lists = [pa.ListArray.from_arrays(edges, batch.column(c)) for c in ("doc_id", "text", "target")]
        yield pa.RecordBatch.from_arrays([pa.array([piece], pa.int64()), *lists], names=["piece", "doc_id", "text", "target"])
        piece += 1


class _Keys:
    """The distinct keys of a piece in order, and for each of its words the place of its own, its pair's and its context's."""

    def __init__(self, texts: pa.Array):
        self.words = T.words_of(texts, T.LETTERS, lower=True)
        now = self.words.hashes()
        before = np.empty_like(now)
        before[1:] = now[:-1]
        firsts = self.words.first[:-1][self.words.counts > 0]
        before[firsts] = START
        pair = T.mix(T.seeded(before, 3) + now)
        self.keys, places = np.unique(np.concatenate([now, pair, np.array([START, TOKENS], np.uint64)]), return_inverse=True)
        n = len(now)
        self.word, self.pair, (self.start, self.tokens) = places[:n], places[n:2 * n], places[2 * n:]
        self.context = np.empty_like(self.word)
        self.context[1:] = self.word[:-1]
        self.context[firsts] = self.start

    def contexts(self, n: np.ndarray) -> np.ndarray:
        """Places of the contexts that the models keep (n: the counts), in order."""
        some = np.zeros(len(self.keys), bool)
        some[self.context] = True
        return np.flatnonzero(some & (n > 0))


def _parts(buckets: int, piece: int, keys: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
    """Sorted keys and what belongs to them, a row for each bucket."""
    bucket = ((keys >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    edges = np.append(np.flatnonzero(np.diff(bucket, prepend=-1)), len(keys))
    rows = [(int(bucket[a]), piece, int(b - a), _pack(keys[a:b], *[c[a:b] for c in columns])) for a, b in zip(edges[:-1], edges[1:])]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARTS)], schema=_PARTS)


def _count(buckets: int):
    """How often each word and pair of a piece occurs in all its texts and in those of the target."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                of = _Keys(row.column("text").flatten())
                if not len(of.words):
                    continue
                target = row.column("target").flatten().to_numpy(zero_copy_only=False)
                of_word, some, size = target[of.words.owner], of.words.counts > 0, len(of.keys)
                n, t = np.zeros(size, np.int64), np.zeros(size, np.int64)
                for places in (of.word, of.pair):
                    n += np.bincount(places, minlength=size)
                    t += np.bincount(places, of_word, size).astype(np.int64)
                n[of.start], t[of.start] = some.sum(), target[some].sum()
                n[of.tokens], t[of.tokens] = len(of_word), of_word.sum()
                is_word = np.zeros(size, np.int64)
                is_word[of.word] = 1
                yield _parts(buckets, row.column("piece")[0].as_py(), of.keys, 2 * n + is_word, t)

    return run


def _runs(parts: pa.Table, columns: int):
    """Parts of a bucket together: (columns, order of the keys, where each key begins, which key each entry has)."""
    found = _unpack(parts["part"].to_pylist(), parts["n"].to_numpy(), columns)
    keys = found[0].view(np.uint64)
    order = np.argsort(keys, kind="stable")
    sorted_keys = keys[order]
    first = np.ones(len(order), bool)
    first[1:] = sorted_keys[1:] != sorted_keys[:-1]
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(first) - 1
    return found, order, np.flatnonzero(first), which


def _answers(parts: pa.Table, totals: list[int], *columns: np.ndarray) -> pa.Table:
    """To each part what belongs to its keys, in its order."""
    edges = np.concatenate([[0], np.cumsum(parts["n"].to_numpy())])
    blobs = [_pack(*[c[a:b] for c in columns]) for a, b in zip(edges[:-1], edges[1:])]
    sums = [pa.array([x] + [0] * (len(blobs) - 1), pa.int64()) for x in totals]
    return pa.table([parts["bucket"], parts["piece"], parts["n"], pa.array(blobs, pa.binary()), *sums], schema=_ANSWERS)


def _add_counts(parts: pa.Table) -> pa.Table:
    """Counts in all pieces of what the models keep (else 0), and whether the piece stands for the key; and the models' sums."""
    (key, marked, target), order, first, which = _runs(parts, 3)
    n, is_word = marked >> 1, (marked & 1)[order[first]] == 1
    n, target = (np.add.reduceat(c[order], first) for c in (n, target))
    key = key[order[first]]
    special = (key == START) | (key == TOKENS)
    kept = (n >= LEAST) | special
    words, tokens = kept & is_word & ~special, key == TOKENS
    totals = [int(words.sum()), int(n[words].sum()), int(target[words].sum()), int(n[tokens].sum()), int(target[tokens].sum())]
    stands = np.zeros(len(order), np.int64)
    stands[order[first]] = kept & ~special
    n, target = np.where(kept, n, 0), np.where(kept, target, 0)
    return _answers(parts, totals, n[which], target[which], stands)


def _add_taken(parts: pa.Table) -> pa.Table:
    """What discounting takes from each context, summed over the pieces that stand for its pairs."""
    (_, *taken), order, first, which = _runs(parts, 3)
    sums = [np.add.reduceat(c.view(np.float64)[order], first)[which].view(np.int64) for c in taken]
    return _answers(parts, [0] * len(_TOTALS), *sums)


def _answered(answers: pa.Table, columns: int) -> list[np.ndarray]:
    """The answers to all parts of a piece, in the order of its keys."""
    answers = answers.sort_by("bucket")
    return _unpack(answers["part"].to_pylist(), answers["n"].to_numpy(), columns)


def _texts(pieces: pa.Table) -> pa.Array:
    return pieces["text"].combine_chunks().flatten()


def _take(buckets: int):
    def run(pieces: pa.Table, answers: pa.Table) -> pa.Table:
        if not pieces.num_rows or not answers.num_rows:
            return _PARTS.empty_table()
        of = _Keys(_texts(pieces))
        n, target, stands = _answered(answers, 3)
        context = np.full(len(of.keys), -1)
        context[of.pair] = of.context
        mine = np.flatnonzero((context >= 0) & (stands == 1))
        sums = [np.bincount(context[mine], np.maximum(c[mine] - DISCOUNT, 0), len(of.keys)) for c in (n, target)]
        wanted = of.contexts(n)
        return pa.Table.from_batches([_parts(buckets, pieces["piece"][0].as_py(), of.keys[wanted], *[s[wanted] for s in sums])])

    return run


def _score(totals: dict[str, int]):
    def run(pieces: pa.Table, answers: pa.Table) -> pa.Table:
        of = _Keys(_texts(pieces))
        tokens, ids = of.words.counts, pieces["doc_id"].combine_chunks().flatten()
        means = [np.zeros(len(tokens))] * 2
        if len(of.words):
            counts = _answered(answers.filter(pc.invert(answers["taken"])), 3)[:2]
            wanted = of.contexts(counts[0])
            means = []
            for count, taken, all_, kept in zip(
                    counts, _answered(answers.filter(answers["taken"]), 2), (totals["all_n"], totals["all_target"]), (totals["kept_n"], totals["kept_target"])):
                left = np.zeros(len(of.keys))
                left[wanted] = taken.view(np.float64)
                is_word = counts[0][of.word] > 0
                chance = (np.where(is_word, count[of.word], all_ - kept) + 1) / (all_ + totals["words"] + 1)
                context = np.maximum(np.where(counts[0][of.context] > 0, count[of.context], 1), 1)
                loss = -np.log(np.maximum(count[of.pair] - DISCOUNT, 0) / context + (1 - left[of.context] / context) * chance)
                sums = np.concatenate([[0.0], np.cumsum(loss)])
                means.append((sums[of.words.first[1:]] - sums[of.words.first[:-1]]) / np.maximum(tokens, 1))
        background, target = means
        column = lambda x: pa.array(x, pa.float64(), mask=tokens == 0)
        return pa.Table.from_arrays(
            [ids, pa.array(tokens, pa.int64()), column(target), column(background), column(target - background)],
            names=["doc_id", "n_tokens", "target_loss", "background_loss", "difference"])

    return run


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss and difference of every document."""
    good = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1")
        .select("doc_id", F.lit(1).alias("target"))
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # a shuffle at every size: labels grow with the documents, and Spark splits partitions of hot ids
    flagged = texts.join(good.hint("merge"), "doc_id", "left").select("doc_id", "text", F.coalesce("target", F.lit(0)).alias("target"))
    with shuffles_dropped(documents.sparkSession):
        pieces = saved(flagged.mapInArrow(_in_pieces, _PIECES_SQL), "lm-pieces")
        size = pieces.agg(F.coalesce(F.sum(F.aggregate("text", F.lit(0).cast("long"), lambda n, t: n + F.coalesce(F.octet_length(t), F.lit(0)))), F.lit(0))).first()[0]
        buckets = max(1, -(-size // BUCKET_BYTES))
        answers = saved(
            pieces.mapInArrow(_count(buckets), _PARTS_SQL).groupBy("bucket").applyInArrow(_add_counts, _ANSWERS_SQL), "lm-counts")
        totals = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _TOTALS]).first().asDict()
        by_piece = pieces.groupBy("piece")
        taken = saved(
            by_piece.cogroup(answers.groupBy("piece")).applyInArrow(_take(buckets), _PARTS_SQL).groupBy("bucket").applyInArrow(_add_taken, _ANSWERS_SQL),
            "lm-taken")
    both = [a.select("piece", "bucket", "n", "part", F.lit(is_taken).alias("taken")) for a, is_taken in ((answers, False), (taken, True))]
    return by_piece.cogroup(both[0].unionByName(both[1]).groupBy("piece")).applyInArrow(_score(totals), _SCORES_SQL)


def op8_language_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
