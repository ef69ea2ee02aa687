"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterbell.llm import spelling as S
from tests.llm.odd import ROWS, documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1:] for i in range(len(b)))


def brute_force(rows, least=3):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= least}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w in words:
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, n, len(near[w]), form[w], words.get(form[w]), root))
    return sorted(out)


def variants(frame):
    return sorted(tuple(r) for r in S.spelling_variants(frame).collect())


def planted(seed=4):
    """Words at all distances from each other, of a few letters, with falling counts: chains of forms."""
    rng = random.Random(seed)
    bases = ["".join(rng.choice("abé") for _ in range(n)) for n in (5, 6, 6, 7, 8, 40)] * 3
    words = []
    for base in bases:
        word, n = base, 120
        while n >= 2:
            words += [word] * n
            at = rng.randrange(len(word))
            word = rng.choice([word[:at] + word[at + 1:], word[:at] + "bac"[at % 3] + word[at:], word[:at] + "ÿ" + word[at + 1:]])
            n //= rng.choice([2, 2, 3])
    rng.shuffle(words)
    return [(i if i % 9 else None, " ".join(words[i::50]).replace("a", "A" if i % 3 else "a") + " É ÉÿĀx") for i in range(50)]


@pytest.mark.parametrize("sizes", [{}, {"CELL": 8, "TILE": 3, "SAMPLE": 60}])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(S, name, value)  # many cells, and tiles smaller than a cell
    rows = planted()
    expected = brute_force(rows)
    assert sum(r[2] for r in expected) > 50 and sum(r[5] != (r[3] or r[0]) for r in expected) > 3
    assert variants(spark.createDataFrame(rows, "doc_id long, text string")) == expected


def test_whole_table_against_brute_force(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert variants(frame) == brute_force([tuple(r) for r in frame.select("doc_id", "text").collect()])


def test_odd_rows(spark):
    assert variants(documents(spark)) == brute_force([r[:2] for r in ROWS])
    assert variants(documents(spark).where("false")) == []
    long = "y" * 30_000
    rows = [(i, f"{long}{'z' if i % 2 else ''}") for i in range(6)]
    assert variants(spark.createDataFrame(rows, "doc_id long, text string")) == brute_force(rows)


words = st.text(alphabet="abcé", min_size=5, max_size=8)


@settings(max_examples=150, deadline=None)
@given(st.lists(words, min_size=1, max_size=60, unique=True), words, st.integers(1, 12))
def test_cells_within_hold_all_near_words(vocabulary, word, cells):
    for length in {len(w) for w in vocabulary}:
        group = [w for w in vocabulary if len(w) == length]
        x = S._counts(S._codes(group))
        root, n = S.tree(x, cells)
        home = {}
        for cell, at in S.cells_within(root, S._Boxes(x, 0)):
            home |= {group[i]: cell for i in at}
        assert set(home) == set(group) and set(home.values()) <= set(range(n))
        gap = abs(length - len(word))
        if gap <= 1:
            visited = {c for c, at in S.cells_within(root, S._Boxes(S._counts(S._codes([word])), 2 - gap)) if len(at)}
            assert {home[w] for w in group if one_edit(w, word)} <= visited


@settings(max_examples=300, deadline=None)
@given(st.lists(words, min_size=1, max_size=6), st.lists(words, min_size=1, max_size=6))
def test_near_is_one_edit(some, others):
    for n in {len(w) for w in some}:
        for m in {len(w) for w in others} & {n - 1, n, n + 1}:
            a, b = [w for w in some if len(w) == n], [w for w in others if len(w) == m]
            found = {(a[i], b[j]) for v, r in S._compare(S._codes(a), S._codes(b)) for i, j in zip(v, r)}
            assert found == {(x, y) for x in a for y in b if one_edit(x, y)}


def test_a_box_three_letters_away_is_pruned():
    x = np.zeros((16, S._LETTERS), np.int32)
    for letter in range(4):
        x[:, letter] = (np.arange(16) >> letter) & 1
    root, n = S.tree(x, 16)
    visits = sum(len(at) for _, at in S.cells_within(root, S._Boxes(x, 2)))
    assert n == 16 and visits == 16 * (1 + 4 + 6)
