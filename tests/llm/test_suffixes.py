"""Removal of repeated bytes against brute force."""

import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterbell.llm import suffixes as S
from tests.llm.odd import ROWS, documents


def brute_force(rows):
    """(doc_id, bytes, removed, spans, checksum); rows without an id come last."""
    least = {}
    keyed = [(d if d is not None else 1 << 62, d, (t or "").encode()) for d, t in rows]
    for key, _, text in keyed:
        for i in range(len(text) - 49):
            window = text[i:i + 50]
            least[window] = min(least.get(window, key), key)
    out = []
    for key, doc, text in keyed:
        gone = np.zeros(len(text), bool)
        for i in range(len(text) - 49):
            if least[text[i:i + 50]] < key:
                gone[i:i + 50] = True
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(gone) else 0
        out.append((doc, len(text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def planted(seed=1):
    """Texts of shared passages of all lengths, runs of one letter, and short periods."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    passages = [" ".join(word() for _ in range(60)) for _ in range(6)]
    rows = []
    for _ in range(80):
        text = ""
        for _ in range(rng.randint(1, 5)):
            passage = rng.choice(passages)
            at = rng.randint(0, len(passage) - 60)
            text += passage[at:at + rng.randint(30, 150)] + " ".join(word() for _ in range(rng.randint(0, 8)))
        if rng.random() < 0.2:
            text = text[:100] + "-" * rng.randint(0, 130) + text[100:] + "ab" * rng.randint(0, 80)
        if rng.random() < 0.1:
            text += text
        rows.append((rng.randint(-5, 100), text))
    return rows + [(3, None), (4, ""), (5, "x" * 49), (6, "x" * 51), (7, "x" * 400), rows[0], (None, passages[0] + "z"), (-9, passages[0][:70])]


def removed(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in S.without_repeated_bytes(frame).collect()), key=str)


@pytest.mark.parametrize("bucket_bytes", [S.BUCKET_BYTES, 300])
def test_removes_what_brute_force_removes(spark, monkeypatch, bucket_bytes):
    monkeypatch.setattr(S, "BUCKET_BYTES", bucket_bytes)  # 300: anchors and equal suffixes lie at the borders of many buckets
    rows = planted()
    expected = brute_force(rows)
    assert sum(r[2] for r in expected) > 10_000
    assert removed(spark, rows) == expected


def test_an_anchor_that_spans_buckets_is_compared_across_them(spark, monkeypatch):
    anchor = "zq" + "x1y2z3w4" * 3
    rows = [(i, f"{i:03d}" * 12 + anchor + f"{i % 7:03d}" * 12) for i in range(200)]
    monkeypatch.setattr(S, "splitters_of", lambda texts: _every_key(texts))
    assert removed(spark, rows) == brute_force(rows)


def _every_key(texts):
    """A bucket of its own for each suffix."""
    batch = texts.select("doc", "text").toArrow().combine_chunks().to_batches()[0]
    _, _, lead, second = S._stretches(*S.bytes_of(batch.column("text")))
    return np.unique(np.stack([lead, second], 1), axis=0)


def test_odd_rows(spark):
    got = sorted((tuple(r) for r in S.without_repeated_bytes(documents(spark)).collect()), key=str)
    assert got == brute_force([r[:2] for r in ROWS])
    assert S.without_repeated_bytes(documents(spark).where("false")).collect() == []


def test_a_very_long_text_is_worked_on_whole(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh ") for _ in range(6_000_000))
    rows = [(1, long), (2, "q" + long[5_999_000:] + "q"), (3, long[4_194_250:4_194_350])]
    got = {r[0]: r[1:4] for r in removed(spark, rows)}
    assert got == {1: (6_000_000, 0, 0), 2: (1002, 1000, 1), 3: (100, 100, 1)}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=2, max_size=2), min_size=1, max_size=300), st.integers(1, 40))
def test_multikey_quicksort_orders_as_tuples(entries, small):
    columns = [np.array(c, np.uint64) for c in zip(*entries)]
    kept, S.SMALL = S.SMALL, small
    try:
        order = S.multikey_quicksort(columns)
    finally:
        S.SMALL = kept
    assert sorted(order) == list(range(len(entries)))
    assert [entries[i] for i in order] == sorted(entries)


def test_sliding_least():
    rng = np.random.default_rng(3)
    for n in (27, 28, 53, 54, 55, 200):
        keys = rng.integers(0, 50, n).astype(np.uint64)
        assert S._least(keys, 27).tolist() == [keys[i:i + 27].min() for i in range(n - 26)]
