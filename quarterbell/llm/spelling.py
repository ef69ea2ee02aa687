"""Spelling variants by k-d trees over letter counts.

1. *Words.* Runs of letters are counted over all texts; a piece of text sends
   one row for each of its words.
2. *Trees.* A word is the vector of its letters' counts. One edit changes the
   counts by two at most in L1 distance between words of one length, and by one between neighbouring
   lengths. For each length with many words a k-d tree, whose splits come from
   a sample of the vocabulary, cuts the space of counts into cells. A word lives in
   one cell and visits those cells of its own and of the neighbouring lengths whose box
   is within that distance: a box that differs in three letters is pruned.
3. *Search.* Cells are cut into tiles of bounded size by counts of their
   residents and visitors. In a tile the tree goes on: residents are split down to a few, and visitors
   follow as long as the box is near. What remains is compared letter by letter.
4. *Forms.* A tile reports one row for each visitor: how many near words it has
   there and the best of them. Roots are found by doubling: each round, a word
   takes the root of its root. A form is at least twice as frequent as its word, so
   chains are no longer than the binary logarithm of the greatest count.

No list of pairs is made. The sample only places the splits: cells of an unlucky
split are larger, and tiles keep them bounded.

Results in the odd cases: null and empty texts have no words; a document without
an id has the empty text for its id; very long words are words like others; of near words with
equal counts the smallest in code-point order is the form; repeated rows count each time; without words there
are no rows; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbell.llm import tokens as T
from quarterbell.llm.tables import saved, table

#: Least code points and occurrences of a word; one word in so many (with its document) loses a letter.
LEAST_LENGTH, LEAST_COUNT, ALTERED = 5, 3, 97
#: How many times as frequent as a word its form is at least.
FORM_FACTOR = 2
#: Distinct words a task holds before it sends them.
HELD = 400_000
#: Words of a cell, by the sample; residents and visitors of a tile, on average at most; words that a tile compares one by one.
CELL, TILE, FEW = 1 << 15, 1 << 16, 16
#: Words of the vocabulary from which splits are made, at most on average.
SAMPLE = 200_000
#: Letters compared at once.
BLOCK = 1 << 22

_RUN = re.compile(f"[a-zÀ-ÿ]{{{LEAST_LENGTH},}}")
#: Letter counts are those of a to z, then of U+00C0 to U+00FF.
_LETTER = np.array([c - 97 if 97 <= c <= 122 else c - 0xC0 + 26 if c >= 0xC0 else 0 for c in range(256)])
_LETTERS = 26 + 64
_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()), ("form_n", pa.int64())])


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[str] = Counter()

    def out():
        batch = pa.RecordBatch.from_pydict({"word": pa.array(counts.keys(), pa.string()), "n": pa.array(counts.values(), pa.int64())})
        counts.clear()
        return batch

    for batch in T.chunks(batches):
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            if not text:
                continue
            # bytes.lower changes A-Z alone
            runs = Counter(_RUN.findall(text.encode().lower().decode()))
            begin = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
            for run, n in runs.items():
                h = zlib.crc32(run.encode(), begin)
                if h % ALTERED == 0:
                    at = h % len(run)
                    run = run[:at] + run[at + 1:]
                    if len(run) < LEAST_LENGTH:
                        continue
                counts[run] += n
        if len(counts) > HELD:
            yield out()
    if counts:
        yield out()


def words_of(documents: DataFrame) -> DataFrame:
    """word, n and length of every word."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = texts.mapInArrow(_count_words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where(F.col("n") >= LEAST_COUNT).withColumn("length", F.length("word").cast("long"))


def _codes(words: list[str]) -> np.ndarray:
    """The letters of words of one length."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def _counts(codes: np.ndarray) -> np.ndarray:
    """How often each letter occurs in each word."""
    at = np.arange(len(codes))[:, None] * _LETTERS + _LETTER[codes]
    return np.bincount(at.ravel(), minlength=len(codes) * _LETTERS).reshape(-1, _LETTERS).astype(np.int32)


def _split(x: np.ndarray) -> tuple[int, int] | None:
    """Letter and count at which words part best: those with at most the count go left."""
    sums, squares = x.sum(axis=0, dtype=np.int64), np.einsum("ij,ij->j", x, x, dtype=np.int64)
    letter = int((len(x) * squares - sums * sums).argmax())
    values = np.sort(x[:, letter])
    if values[0] == values[-1]:
        return None
    at = values[(len(values) - 1) // 2]
    return letter, int(at if at < values[-1] else values[np.searchsorted(values, at) - 1])


def tree(x: np.ndarray, cells: float, first: int = 0):
    """A k-d tree of some vectors with about so many cells: (letter, count, left, right), or the number of a cell; and the next number."""
    split = _split(x) if cells > 1 and len(x) > 1 else None
    if split is None:
        return first, first + 1
    left = x[:, split[0]] <= split[1]
    share = left.mean()
    low, first = tree(x[left], cells * share, first)
    high, first = tree(x[~left], cells * (1 - share), first)
    return (*split, low, high), first


class _Boxes:
    """Visitors on their way down a k-d tree, with the distance of each to the present box (``apart`` at its root)."""

    def __init__(self, x: np.ndarray, radius: int, apart: np.ndarray | None = None):
        self.columns, self.radius = np.ascontiguousarray(x.T), radius
        self.apart = np.zeros(len(x), np.int32) if apart is None else apart
        self.at = np.flatnonzero(self.apart <= radius)
        self.apart = self.apart[self.at]
        self.low, self.high = np.zeros(x.shape[1], np.int32), np.full(x.shape[1], np.iinfo(np.int32).max)

    def _half(self, letter: int, low: int, high: int) -> "_Boxes":
        x = self.columns[letter][self.at]
        before = np.maximum(self.low[letter] - x, 0) + np.maximum(x - self.high[letter], 0)
        apart = self.apart - before + np.maximum(low - x, 0) + np.maximum(x - high, 0)
        near = apart <= self.radius
        half = object.__new__(_Boxes)
        half.columns, half.radius, half.at, half.apart = self.columns, self.radius, self.at[near], apart[near]
        half.low, half.high = self.low.copy(), self.high.copy()
        half.low[letter], half.high[letter] = low, high
        return half

    def halves(self, letter: int, count: int) -> tuple["_Boxes", "_Boxes"]:
        return self._half(letter, self.low[letter], count), self._half(letter, count + 1, self.high[letter])


def cells_within(node, visitors: _Boxes) -> Iterator[tuple[int, np.ndarray]]:
    """Each cell of a tree, with the visitors within the distance of its box."""
    todo = [(node, visitors)]
    while todo:
        node, visitors = todo.pop()
        if not len(visitors.at):
            continue
        if isinstance(node, int):
            yield node, visitors.at
        else:
            letter, count, left, right = node
            low, high = visitors.halves(letter, count)
            todo += [(left, low), (right, high)]


def trees_of(words: DataFrame) -> dict[int, object]:
    """A tree for each length that has more words than a cell takes.

    Their size goes with the vocabulary divided by ``CELL``.
    """
    sizes = {r.length: r.n for r in words.groupBy("length").agg(F.count("*").alias("n")).where(F.col("n") > CELL).collect()}
    if not sizes:
        return {}
    share = -(-sum(sizes.values()) // SAMPLE)
    some = words.where(F.col("length").isin(list(sizes))).where(F.pmod(F.xxhash64("word"), F.lit(share)) == 0).select("word").toArrow()
    by_length: dict[int, list[str]] = {}
    for word in sorted(some["word"].to_pylist()):
        by_length.setdefault(len(word), []).append(word)
    return {n: tree(_counts(_codes(group)), sizes[n] / CELL)[0] for n, group in by_length.items()}


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    sizes = np.fromiter((len(w) for w in words), np.int64, len(words))
    for n in np.unique(sizes):
        yield int(n), np.flatnonzero(sizes == n)


def _file(trees):
    """The cell in which each word lives, and the cells it visits."""

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column("word").to_pylist()
            for length, rows in _by_length(words):
                x = _counts(_codes([words[i] for i in rows]))
                for step, radius, lives in ((0, 0, True), (-1, 1, False), (0, 2, False), (1, 1, False)):
                    for cell, at in cells_within(trees.value.get(length + step, 0), _Boxes(x, radius)):
                        if length + step >= LEAST_LENGTH and len(at):
                            some = batch.take(pa.array(rows[at]))
                            yield pa.RecordBatch.from_pydict({
                                "length": np.full(len(at), length + step), "cell": np.full(len(at), cell), "word": some.column("word"),
                                "n": some.column("n"), "lives": np.full(len(at), lives)})

    return file


def _near(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether each word of a becomes each of b by one edit; b's are as long or one longer."""
    n = a.shape[1]
    if b.shape[1] == n:
        return np.count_nonzero(a[:, None, :] != b[None, :, :], axis=2) == 1
    ahead, behind = a[:, None, :] != b[None, :, :-1], a[:, None, :] != b[None, :, 1:]
    first = np.where(ahead.any(axis=2), ahead.argmax(axis=2), n)
    last = np.where(behind.any(axis=2), n - 1 - behind[:, :, ::-1].argmax(axis=2), -1)
    return last < first


def _compare(visitors: np.ndarray, residents: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(visitor, resident) of the near pairs, block by block."""
    width = max(visitors.shape[1], residents.shape[1])
    wide = max(1, min(len(residents), BLOCK // width))
    tall = max(1, BLOCK // (width * wide))
    for i in range(0, len(visitors), tall):
        for j in range(0, len(residents), wide):
            a, b = visitors[i:i + tall], residents[j:j + wide]
            near = _near(a, b) if a.shape[1] <= b.shape[1] else _near(b, a).T
            v, r = np.nonzero(near)
            yield v + i, r + j


def _search(tile: pa.Table) -> pa.Table:
    """For each visitor of a tile: how many residents are near, and the most frequent of them."""
    words, n = np.array(tile["word"].to_pylist(), object), tile["n"].to_numpy()
    home, other = (np.flatnonzero(tile[c].to_numpy()) for c in ("resident", "visitor"))
    # by rank, the best form first
    home = home[sorted(range(len(home)), key=lambda i: (-n[home[i]], words[home[i]]))]
    out = []
    if len(home) and len(other):
        codes = _codes(list(words[home]))
        x = _counts(codes)
        used = x.any(axis=0)  # of other letters the box of all residents has none
        x = x[:, used]
        for length, rows in _by_length(list(words[other])):
            visitors = _codes(list(words[other[rows]]))
            count, best = np.zeros(len(rows), np.int64), np.full(len(rows), len(home))
            theirs = _counts(visitors)
            root = _Boxes(theirs[:, used], 2 if length == codes.shape[1] else 1, theirs[:, ~used].sum(axis=1, dtype=np.int32))
            todo = [(np.arange(len(home)), root)]
            while todo:
                there, boxes = todo.pop()
                if not len(boxes.at):
                    continue
                split = _split(x[there]) if len(there) > FEW else None
                if split is not None:
                    left = x[there, split[0]] <= split[1]
                    low, high = boxes.halves(*split)
                    todo += [(there[left], low), (there[~left], high)]
                    continue
                for v, r in _compare(visitors[boxes.at], codes[there]):
                    count += np.bincount(boxes.at[v], minlength=len(rows))
                    np.minimum.at(best, boxes.at[v], there[r])
            some = np.flatnonzero(count)
            out.append((words[other[rows[some]]], count[some], words[home[best[some]]], n[home[best[some]]]))
    if not out:
        return _FOUND.empty_table()
    return pa.table([pa.array(np.concatenate(c), f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, form and form_n (of the most frequent near word) of each word that has near words."""
    trees = words.sparkSession.sparkContext.broadcast(trees_of(words))
    filed = saved(words.select("word", "n").mapInArrow(_file(trees), "length long, cell long, word string, n long, lives boolean"), "spelling-cells")
    tiles = lambda c: F.ceil(F.count_if(c) / TILE).cast("int")
    crowds = (
        filed.groupBy("length", "cell").agg(tiles(F.col("lives")).alias("home_tiles"), tiles(~F.col("lives")).alias("other_tiles"))
        .where("home_tiles > 0 AND other_tiles > 0")
    )
    placed = filed.join(crowds, ["length", "cell"])
    part = lambda c: F.pmod(F.xxhash64("word"), F.col(c)).cast("int")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    shown = ("length", "cell", "word", "n")
    together = (
        placed.where("lives").select(*shown, part("home_tiles").alias("home"), upto("other_tiles").alias("other"), F.lit(True).alias("resident"))
        .unionByName(placed.where("NOT lives").select(
            *shown, upto("home_tiles").alias("home"), part("other_tiles").alias("other"), F.lit(False).alias("resident")))
        .withColumn("visitor", ~F.col("resident"))
    )
    found = together.groupBy("length", "cell", "home", "other").applyInArrow(_search, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", "best.form", (-F.col("best.n")).alias("form_n"))


def roots_of(forms: DataFrame) -> DataFrame:
    """word and the last of the forms that follow from it, of every word with a form."""
    roots = saved(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = roots.select(F.col("word").alias("of"), F.col("root").alias("last"))
        step = roots.join(onward, F.col("root") == F.col("of"), "left")
        roots = saved(step.select("word", F.coalesce("last", "root").alias("root"), F.col("last").isNotNull().alias("moved")), "spelling-roots")
        if roots.where("moved").isEmpty():
            return roots.select("word", "root")
        roots = roots.select("word", "root")


def spelling_variants(documents: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word."""
    words = saved(words_of(documents), "spelling-words")
    near = saved(
        words.select("word", "n").join(near_words(words), "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            *[F.when(F.col("form_n") >= FORM_FACTOR * F.col("n"), F.col(c)).alias(c) for c in ("form", "form_n")]),
        "spelling-near")
    roots = roots_of(near.where("form IS NOT NULL"))
    return near.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))
