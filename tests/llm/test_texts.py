"""Operators on whole texts against brute force, and on odd rows."""

import hashlib
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quarterbell.llm import decontamination, licenses, private, substrings
from quarterbell.llm import tokens as T
from quarterbell.llm.queries import queries
from tests.llm.odd import PASSAGE, ROWS, SCHEMA, documents, table

LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SF = "/root/testdata/sf0.001"


def letters(text):
    return LETTERS.findall((text or "").translate(LOWER))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.none() | st.text(alphabet="aZ9 \t\n\x0b\x1c é\U0001F600.-", max_size=40), max_size=6))
def test_words_are_cut_as_the_patterns_say(texts):
    array = pa.array(texts, pa.string())
    for table_, lower, wanted in (
        (T.SPACED, False, [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]),
        (T.LETTERS, True, [letters(t) for t in texts]),
    ):
        words = T.words_of(array, table_, lower)
        found = [[words.word(i).decode() for i in range(a, b)] for a, b in zip(words.first[:-1], words.first[1:])]
        assert found == wanted
        flat = [w for ws in wanted for w in ws]
        hashes = words.hashes()
        assert len({(w, h) for w, h in zip(flat, hashes.tolist())}) == len(set(flat)) == len(set(hashes.tolist()))


def license_facts(text):
    words, starts, labels = letters(text), [], set()
    for label, phrase in (("gpl", "gnu general public license"), ("apache", "apache license"), ("cc-by", "cc by"), ("mit", "mit license")):
        phrase = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(phrase)] == phrase:
                starts.append(i)
                labels.add(label)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def test_licenses_against_brute_force(spark):
    found = {r.doc_id: r for r in queries()["op1_license_scan"](spark, "/root/testdata/sf0.01").collect()}
    rows = table("documents", "sf0.01")
    assert len(found) == len(rows)
    for doc_id, text, *_ in rows:
        r = found[doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == license_facts(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_every_block_over_the_threshold_is_found(spark):
    template = licenses.Template("t", "alpha beta gamma delta epsilon zeta eta theta iota kappa", 0.8)
    rng = np.random.default_rng(5)
    vocabulary = template.phrase.split() + [f"x{i}" for i in range(5)]
    texts = [" ".join(rng.choice(vocabulary, 60, p=[.06] * 10 + [.08] * 5)) for _ in range(60)]
    found = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), [template]).collect()
    wanted = set(template.phrase.split())
    for r in found:
        words = texts[r.doc_id].split()
        every = [len(wanted & set(words[b:b + 20])) for b in range(60)]
        assert r.n_blocks == sum(every[b] >= 8 for b in range(60) if words[b] in wanted)
        assert r.score == pytest.approx(max([b / 10 for b in every if b >= 8], default=0))


def test_a_template_is_found_wherever_it_starts(spark):
    template = next(t for t in licenses.TEXTS if t.phrase.startswith("licensed under the apache"))
    spread = " between ".join(template.phrase.split())
    rows = [(d, " ".join([f"x{i}" for i in range(d)] + [spread, "after"])) for d in range(40)]
    found = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"), [template]).collect()
    assert {(r.labels, r.score) for r in found} == {("apache", 1.0)} and len(found) == 40


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("a b c d e f x y".split()), max_size=40), st.sampled_from([0.4, 0.6, 0.8, 1.0]), st.permutations(list("abcdef")))
def test_filters_lose_no_block(words, threshold, order):
    template = licenses.Template("t", "a b c d e f", threshold)
    join = licenses.Join([template, licenses.Template("u", "x y", 1.0)], {w: n for n, w in enumerate(order)})
    known = [(i, join.rank[w]) for i, w in enumerate(words)]
    at, ranks = (np.array([k[j] for k in known], np.int64) for j in (0, 1))
    found = {(place, shared) for t, place, shared, _ in join.scan(at, ranks) if t == 0}
    every = {i: len(set("abcdef") & set(words[i:i + 12])) for i, w in enumerate(words) if w in "abcdef"}
    assert found == {(i, n) for i, n in every.items() if n >= join.need[0]}


def kept_words(rows, length=substrings.LENGTH):
    """Brute force over (doc_id, text) without repeated rows."""
    rows, seen, out = sorted(set(rows)), {}, {}
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in rows}
    for d, _ in rows:
        for i in range(len(words[d]) - length + 1):
            seen.setdefault(tuple(words[d][i:i + length]), (d, i))
    for d, _ in rows:
        gone = [False] * len(words[d])
        for i in range(len(words[d]) - length + 1):
            if seen[tuple(words[d][i:i + length])] != (d, i):
                gone[i:i + length] = [True] * length
        left = [w for w, g in zip(words[d], gone) if not g]
        out[d] = len(words[d]), sum(gone), hashlib.sha256(" ".join(left).encode()).hexdigest()
    return out


def test_repeats_against_brute_force(spark):
    found = {r.doc_id: tuple(r)[1:] for r in queries()["op2_remove_repeats"](spark, SF).collect()}
    assert found == kept_words([(d, t) for d, t, *_ in table("documents")])


def test_repeats_inside_and_across_documents_of_few_words(spark, monkeypatch):
    monkeypatch.setattr(T, "CHUNK_BYTES", 200)
    rng = np.random.default_rng(1)
    base = [f"v{i}" for i in range(40)]
    rows = []
    for d in range(60):
        a, b = sorted(rng.integers(0, 120, 2))
        rows.append((int(d), " ".join((base * 3)[a:b + 25])))
    found = {r.doc_id: tuple(r)[1:] for r in substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)).collect()}
    assert found == kept_words(rows)


def test_repeats_of_odd_rows(spark):
    found = substrings.without_repeats(documents(spark)).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, set()).add(tuple(r)[1:])
    wanted = kept_words([(d, t) for d, t, *_ in ROWS if d is not None])
    assert len(found) == len(ROWS) and {d: {v} for d, v in wanted.items()} == {d: v for d, v in by.items() if d is not None}
    assert by[6].pop()[1] == len(PASSAGE.split())


def test_anchors_met_by_all_documents(spark):
    rows = [(i, f"{i} {PASSAGE} z{i}") for i in range(2000)]
    found = substrings.without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(16))
    assert {(r.doc_id > 0, r.n_removed) for r in found.collect()} == {(False, 0), (True, 60)}


def test_an_anchor_in_many_contexts_is_dealt_by_content(spark):
    """One phrase with the least hash of many stands in 4,000 contexts, some of which repeat; no task orders them all."""
    phrases = [" ".join(f"p{i}q{k}" for k in range(substrings.SEED)) for i in range(20_000)]
    phrase = phrases[int(np.argmin(T.grams(T.words_of(pa.array([" ".join(phrases)])).hashes(), substrings.SEED)[::substrings.SEED]))]
    around = lambda i, side: " ".join(f"{side}{i}w{k}" for k in range(22))
    rows = [(i, f"{around(i, 'a')} {phrase} {around(i, 'b')}") for i in range(4_000)]
    rows += [(10_000 + i, f"x{i} {around(i * 7, 'a')} {phrase} {around(i * 7 + i % 2, 'b')} y{i}") for i in range(200)]
    rows += [(20_000 + i, f"{around(i, 'c')} {phrase} z") for i in range(10)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r.doc_id: tuple(r)[1:] for r in substrings.without_repeats(frame).collect()}
    assert found == kept_words(rows) and sum(v[1] > 0 for v in found.values()) == 200
    texts = frame.selectExpr("doc_id AS doc", "CAST(0 AS long) AS tag", "text")
    stretches = texts.mapInArrow(substrings.stretches, substrings._SCHEMA)
    most = lambda f: f.groupBy("place").count().agg({"count": "max"}).first()[0]
    crowded = substrings._crowded(texts)
    assert most(stretches) > 4_000 and crowded.count() >= 1
    assert most(substrings.dealt(stretches, crowded)) <= substrings.CROWD


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    found = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m)) <= 19 and private.luhn(digits(m))]
    found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m)) <= 15]
    return sorted(found)


@settings(max_examples=500, deadline=None)
@given(st.text(alphabet="ab.@_+-01234 9()é", max_size=60))
def test_base_spans_are_those_of_the_patterns(text):
    assert private.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("text", ["1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+" * 100_000, "a@" * 100_000, "+1 " * 50_000])
def test_long_runs_take_no_time(text):
    assert private.Marked(text).base == private.base_spans(text)


def test_private_data_against_patterns(spark):
    found = {r.doc_id: r for r in queries()["op3_private_data"](spark, "/root/testdata/sf0.01").collect()}
    for doc_id, text, *_ in table("documents", "sf0.01"):
        spans, r = plain_spans(text or ""), found[doc_id]
        listed = [f"{private.KINDS[k]}:{a}:{b}" for a, k, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert set(listed) <= set(filter(None, r.spans.split(",")))


def test_what_is_found_once_is_found_where_it_is_repeated(spark):
    texts = [f"call +1 (212) 555-{i:04d} or mail u{i}.x@mail{i % 9}.example.com today, item {i} of 20" for i in range(300)]
    graphs = [private.Marked(t) for t in texts]
    field = private.Field(graphs)
    repeated = "ask +1 (988) 555-2485 first, many words later 555-2485 again"
    alone = "many words later 555-2485 again, page 12 of 20"
    added = lambda t: private._added(g := private.Marked(t), field.marginals([g]))
    assert [(private.KINDS[k], repeated[a:b]) for a, k, b in added(repeated)] == [("phone", "555-2485")]
    assert added("page 12 of 20 in 1984") == [] and alone


class Graph:
    """Marked words without a text: features, ties of neighbours and of distant words."""

    def __init__(self, features, chain, skip):
        self.spans, self.features, self.labels, self.chain, self.skip = [(0, 1)] * len(features), features, [0] * len(features), chain, skip


def test_marginals_against_enumeration():
    """Loopy message passing is exact on a tree; round a loop it is close for ties of moderate weight."""
    import itertools

    rng = np.random.default_rng(3)
    kinds = len(private.KINDS) + 1
    field = private.Field.__new__(private.Field)
    field.word = rng.normal(0, 0.4, (private.FEATURES, kinds))
    field.chain, skip = rng.normal(0, 0.5, (kinds, kinds)), rng.normal(0, 0.4, (kinds, kinds))
    field.skip = (skip + skip.T) / 2
    for chain, skip, within in (
        ([(0, 1), (1, 2)], [(2, 4)], 2e-3), ([], [(0, 1), (0, 2), (0, 3), (0, 4)], 2e-3), ([], [], 1e-9),
        ([(0, 1), (1, 2), (3, 4)], [(0, 2), (2, 3)], 0.06),
    ):
        features = rng.integers(0, private.FEATURES, (5, 8)).tolist()
        found = field.marginals([Graph(features, chain, skip), Graph(features[:2], [(0, 1)], [])])[:5]
        own = field.word[np.array(features)].sum(axis=1)
        exact = np.zeros((5, kinds))
        for labels in itertools.product(range(kinds), repeat=5):
            score = sum(own[i, y] for i, y in enumerate(labels))
            score += sum(field.chain[labels[a], labels[b]] for a, b in chain) + sum(field.skip[labels[a], labels[b]] for a, b in skip)
            for i, y in enumerate(labels):
                exact[i, y] += np.exp(score)
        exact /= exact.sum(axis=1, keepdims=True)
        assert np.abs(found - exact).max() < within, (chain, skip, np.abs(found - exact).max())


def edits(pattern, text):
    """The least word edits of the pattern to any run of the text, and where the first such run ends."""
    before = list(range(len(pattern) + 1))
    best, at = len(pattern), -1
    for j, w in enumerate(text):
        now = [0]
        for i, p in enumerate(pattern, 1):
            now.append(min(before[i] + 1, now[-1] + 1, before[i - 1] + (p != w)))
        before = now
        if now[-1] < best:
            best, at = now[-1], j
    return best, at


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=1, max_size=90), st.lists(st.integers(0, 3), max_size=120))
def test_myers_gives_the_edit_distance(pattern, text):
    assert decontamination.myers(pattern, text) == edits(pattern, text)


@given(st.integers(0, 300))
def test_pieces_cover_an_item_and_outnumber_its_edits(n):
    found = decontamination.pieces(n)
    assert sum(size for _, size in found) == n and len(found) == (decontamination.budget(n) + 1 if n else 0)
    assert all(size > 0 for _, size in found)


@pytest.mark.parametrize("most_words", [decontamination.MOST_ITEM_WORDS, 40])
def test_leaks_against_brute_force(spark, most_words):
    rng = np.random.default_rng(3)
    items = [(i, " ".join(f"t{w}" for w in rng.integers(0, 30, n))) for i, n in enumerate([1, 2, 4, 5, 9, 12, 20, 33])] + [(8, None), (9, ""), (None, "q1 q2 q3")]
    rows = []
    for d in range(80):
        words = [f"t{w}" for w in rng.integers(0, 30, rng.integers(0, 60))]
        item = items[d % 8][1].split()
        for _ in range(rng.integers(0, 5)):
            item[rng.integers(0, len(item))] = f"t{rng.integers(0, 40)}"
        rows.append((d, " ".join(words[:10] + item + words[10:]).upper()))
    rows.append((None, "Q1, q2; Q3"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    wanted = set()
    for d, text in rows:
        for i, item in items:
            pattern = letters(item)
            distance, at = edits(pattern, letters(text))
            if pattern and distance <= len(pattern) // 5:
                wanted.add((d, i, distance, at))
    found = decontamination.find_leaks(docs, benchmark, most_words).collect()
    assert {(r.doc_id, r.item_id, r.distance, r.last_word) for r in found} == wanted
    left = {r.doc_id for r in decontamination.without_leaks(docs, benchmark, most_words).collect()}
    assert left == {d for d, _ in rows} - {d for d, *_ in wanted}


def test_odd_rows_and_empty_tables(spark):
    odd, none = documents(spark), spark.createDataFrame([], SCHEMA)
    scans = {(r.doc_id, r.n_words): r for r in licenses.scan_licenses(odd).collect()}
    assert scans[(10, len(letters(ROWS[-1][1])))].base_labels == "mit" and scans[(1, 0)].labels == "" and scans[(1, 0)].score == 0
    spans = private.find_private(odd).collect()
    assert len(spans) == len(ROWS) and sorted(r.n_email for r in spans)[-2:] == [0, 1]
    benchmark = spark.createDataFrame([(1, PASSAGE), (2, None)], "item_id long, text string")
    assert {(r.doc_id, r.distance) for r in decontamination.find_leaks(odd, benchmark).collect()} == {(5, 0), (6, 0)}
    assert decontamination.without_leaks(odd, benchmark).columns == odd.columns
    assert decontamination.find_leaks(odd, benchmark.limit(0)).count() == 0
    for rows in (licenses.scan_licenses(none), private.find_private(none), substrings.without_repeats(none), decontamination.find_leaks(none, benchmark)):
        assert rows.count() == 0


