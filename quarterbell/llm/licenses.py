"""License scans: an exact set-similarity join of text blocks and license templates.

A template is a phrase with a label and the part of its distinct words that a
block must hold. For a template of n words every 2n words in a row are a block,
wherever they start.

1. Count in how many documents each word of the templates occurs, over all
   documents, and order the words by that, rarest first.
2. *Prefix filter*: a block that holds ``need`` of a template's words holds one
   of its first ``size - need + 1``, and lies within 2n words around it. Only
   these surroundings are looked at.
3. *Length filter*: surroundings with fewer than ``need`` words of the vocabulary
   can't hold such a block. *Positional filter*: for the block whose first shared
   word in the order is the one met, all shared words come from there on, so as
   many different words that do must stand around it.
4. What is left is counted exactly: a block slides over the surroundings, one
   template word at a time, and counts of the words inside run along. Blocks that
   start at a template word are enough, as any other holds no more than the
   next of these. For base phrases the places where the words stand in a row
   are then read off the matching blocks.

The templates are the small side: their number and length are fixed by the
caller and checked, and every task gets them. Documents are never shuffled;
what is gathered is one number for each word of the templates.

Results in the odd cases: a null or empty text has no words, no places, empty
labels and score 0; very long texts are read whole, a slide costs what the
surroundings of the words met hold; several templates may match the same words, all of their
labels are given, and of equal containments the score is the one; repeated rows give repeated results; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbell.llm import tokens as T
from quarterbell.llm.tables import table

#: Words of all templates together; they are sent to every task.
MOST_TEMPLATE_WORDS = 100_000


@dataclass(frozen=True)
class Template:
    label: str
    phrase: str
    threshold: float
    #: The words must stand in a row; the places are reported.
    exact: bool = False


# Phrases whose consecutive places are reported.
BASE = (
    Template("gpl", "gnu general public license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("cc-by", "cc by", 1.0, True),
    Template("mit", "mit license", 1.0, True),
)

# Sentences of public license texts, of which a block holds four fifths of the words.
TEXTS = (
    Template("gpl", "this work is licensed under the gnu general public license version 3", 0.8),
    Template("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", 0.8),
    Template("apache", "licensed under the apache license version 2 0", 0.8),
    Template("apache", "you may not use this file except in compliance with the license you may obtain a copy of the license at", 0.8),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 0.8),
    Template("mit", "released under the mit license", 0.8),
    Template("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", 0.8),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 0.8),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", 0.8),
    Template("cc-by-nc", "licensed under cc by nc 4 0", 0.8),
    Template("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", 0.8),
    Template("proprietary", "no part of this publication may be reproduced or transmitted in any form without the prior written permission of the publisher", 0.8),
)

_ROWS = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
    ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("n_blocks", pa.int64()),
])


def _words(phrase: str) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", phrase)


def _coded(hashes: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the known words, and which each one is. ``known`` is sorted."""
    low = np.zeros(1 << 16, bool)
    low[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
    at = np.flatnonzero(low[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
    found = np.minimum(np.searchsorted(known, hashes[at]), len(known) - 1)
    same = known[found] == hashes[at]
    return at[same], found[same]


class Join:
    """The inverted index of the templates' prefixes, and the filters."""

    def __init__(self, templates: Iterable[Template], frequency: dict[str, int] | None = None):
        self.templates = tuple(templates)
        self.sequences = [_words(t.phrase) for t in self.templates]
        if sum(map(len, self.sequences)) > MOST_TEMPLATE_WORDS:
            raise ValueError(f"templates have more than {MOST_TEMPLATE_WORDS} words together; join them in parts")
        words = sorted({w for s in self.sequences for w in s}, key=lambda w: ((frequency or {}).get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(words)}
        hashed = T.words_of(pa.array(words, pa.string()), T.LETTERS).hashes()
        order = np.argsort(hashed)
        self.known, self.ranks = hashed[order], np.arange(len(words))[order]
        self.words = words
        self.sets = [sorted({self.rank[w] for w in s}) for s in self.sequences]
        self.need = [max(1, int(np.ceil(t.threshold * len(s) - 1e-9))) for t, s in zip(self.templates, self.sets)]
        self.prefix_of = defaultdict(list)  # word -> templates in whose prefix it stands
        for t, (own, need) in enumerate(zip(self.sets, self.need)):
            for w in own[:len(own) - need + 1]:
                self.prefix_of[w].append(t)
        self.is_prefix = np.zeros(len(words), bool)
        self.is_prefix[list(self.prefix_of)] = True

    def surroundings(self, t: int, hits: list[tuple[int, int]], at: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[int, int]]:
        """Ranges of the known words in which a block of a template can match, around the prefix words met (place, word)."""
        reach, need, own = 2 * len(self.sequences[t]), self.need[t], self.sets[t]
        places = np.array([p for p, _ in hits])
        lows, highs = np.searchsorted(at, places - reach + 1), np.searchsorted(at, places + reach)
        low = high = 0
        for (_, word), begin, end in zip(hits, lows.tolist(), highs.tolist()):
            if end - begin < need:
                continue
            around = set(ranks[begin:end].tolist())
            if sum(w >= word and w in around for w in own) < need:
                continue
            if begin > high or low == high:
                if high > low:
                    yield low, high
                low = begin
            high = end
        if high > low:
            yield low, high

    def scan(self, at: np.ndarray, ranks: np.ndarray) -> Iterator[tuple[int, int, int, bool]]:
        """(template, first word, shared words, whether all its words follow in a row) of the matching blocks of one document."""
        met = np.flatnonzero(self.is_prefix[ranks])
        hits = defaultdict(list)
        for place, w in zip(at[met].tolist(), ranks[met].tolist()):
            for t in self.prefix_of[w]:
                hits[t].append((place, w))
        for t in sorted(hits):
            members, n = set(self.sets[t]), len(self.sequences[t])
            wanted = [self.rank[w] for w in self.sequences[t]]
            for low, high in self.surroundings(t, hits[t], at, ranks):
                inside = [(p, w) for p, w in zip(at[low:high].tolist(), ranks[low:high].tolist()) if w in members]
                held, end = Counter(), 0
                for start, (place, word) in enumerate(inside):
                    while end < len(inside) and inside[end][0] < place + 2 * n:
                        held[inside[end][1]] += 1
                        end += 1
                    if len(held) >= self.need[t]:
                        yield t, place, len(held), inside[start:start + n] == [(place + k, w) for k, w in enumerate(wanted)]
                    held[word] -= 1
                    if not held[word]:
                        del held[word]


def _count(join: Join):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(join.known), np.int64)
        for batch in T.chunks(batches):
            words = T.words_of(batch.column("text"), T.LETTERS, lower=True)
            at, code = _coded(words.hashes(), join.known)
            pairs = np.unique(words.owner[at] * len(join.known) + code)
            total += np.bincount(pairs % len(join.known), minlength=len(join.known))
        yield pa.RecordBatch.from_pydict({"word": [join.words[r] for r in join.ranks], "n": total})

    return count


def _scan(join: Join):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            words = T.words_of(batch.column("text"), T.LETTERS, lower=True)
            at, code = _coded(words.hashes(), join.known)
            ranks = join.ranks[code]
            edges = np.searchsorted(at, words.first)
            hits = np.concatenate([[0], np.cumsum(join.is_prefix[ranks])])
            rows = []
            for d, (low, high) in enumerate(zip(edges[:-1], edges[1:])):
                places, base, labels, score, blocks = set(), set(), set(), 0.0, 0
                if hits[high] > hits[low]:
                    for t, place, shared, in_a_row in join.scan(at[low:high] - words.first[d], ranks[low:high]):
                        template = join.templates[t]
                        if template.exact and not in_a_row:
                            continue
                        blocks += 1
                        score = max(score, shared / len(join.sets[t]))
                        labels.add(template.label)
                        if template.exact:
                            places.add((place, t))
                            base.add(template.label)
                starts = [p for p, _ in places]
                rows.append((len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), score, blocks))
            columns = list(zip(*rows)) or [[]] * 7
            yield T.table_of(_ROWS, doc_id=batch.column("doc_id"), n_words=words.counts, **{n: pa.array(c, _ROWS.field(n).type) for n, c in zip(_ROWS.names[2:], columns)})

    return scan


def scan_licenses(documents: DataFrame, templates: Iterable[Template] = BASE + TEXTS) -> DataFrame:
    """A row for each document: its words, the places of base phrases, labels, the largest containment, matching blocks."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    plain = Join(templates)
    counts = texts.select("text").mapInArrow(_count(plain), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    join = Join(plain.templates, {r.word: r.n for r in counts.collect()})  # a row for each word of the templates
    return texts.mapInArrow(
        _scan(join), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_blocks long")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
