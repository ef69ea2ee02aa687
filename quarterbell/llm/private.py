"""Personal data by a skip-chain conditional random field.

Patterns find e-mail and IP addresses, card and phone numbers: the base spans.
They teach a conditional random field over marked words (words with a digit or
an @), whose labels are the four kinds and none. Its potentials:

* of a word: its shape, its digits, its checksum, its neighbours;
* of neighbouring marked words (a number may be several words);
* of distant words: each is tied to the next one in the document with the same
  letters and digits, and to the next with the same local part or the same last seven digits, so that what is
  found once is found wherever it is repeated or partly repeated.

The weights are fitted by pseudo-likelihood on a hashed sample of about
``TRAINING_TEXTS`` texts (a bounded number), with ties of distant words
preferring one label beforehand. Every document is then labelled as a whole by
loopy message passing; a word that is no base span is added where a label has
a probability of ``SURE`` or more. Ties of a document are as many as its words, so a word
repeated everywhere costs no more than others. Nothing is shuffled.

Results in the odd cases: null and empty texts have no spans and the checksum
of the empty string; without a text to learn from only base spans are given;
repeated rows give repeated results; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbell.llm import tokens as T
from quarterbell.llm.tables import table

#: Kinds in the order in which they are reported; label 0 is none of them.
KINDS = ("email", "ip", "card", "phone")
#: Texts that the field is fitted on, about.
TRAINING_TEXTS = 4000
#: Least probability of an added label.
SURE = 0.9
#: Numbers of hashed features of a word.
FEATURES = 2048
ROUNDS, DAMPING = 20, 0.5

# What the kinds look like. Runs are taken whole, so that no long run is tried twice.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_MARK = re.compile(r"[0-9@]")
_SPACE = re.compile(r"[\x20\x09-\x0D]")
_EDGES = "\"'`()[]{}<>,;:!?.|*#$%&=/\\"
_ROWS = pa.schema([
    ("doc_id", pa.int64()), *[(f"n_{kind}", pa.int64()) for kind in KINDS], ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())])


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, by start and kind."""
    found = []
    done, at = 0, text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at)
        start = at
        if domain:
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < at:
                done = domain.end()
                found.append((start, 0, done))
        at = text.find("@", max(at + 1, done))
    if re.search("[0-9]", text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
                found.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 14 and 14 <= len(digits := _digits(m.group())) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_digits(m.group())) <= 15:
                    found.append((m.start(), 3, m.end()))
    return sorted(found)


def _shape(word: str) -> str:
    """Runs of letters as a, of digits as 9 with their number up to 5."""
    return re.sub(r"9+", lambda m: f"9{min(len(m.group()), 5)}", re.sub(r"[^\W\d_]+", "a", re.sub(r"[0-9]", "9", word[:64])))


def _hashed(*features: str) -> list[int]:
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % FEATURES for f in features]


class Marked:
    """The marked words of one text: where they are, their features, labels and ties."""

    def __init__(self, text: str):
        self.spans: list[tuple[int, int]] = []
        self.base = base_spans(text)
        words, done = [], 0
        for mark in _MARK.finditer(text):
            if mark.start() < done:
                continue
            start = mark.start()
            while start > done and not _SPACE.match(text[start - 1]):
                start -= 1
            end = _SPACE.search(text, mark.end())
            done = end.start() if end else len(text)
            word = text[start:done]
            low = len(word) - len(word.lstrip(_EDGES))
            self.spans.append((start + low, start + low + max(1, len(word.strip(_EDGES)))))
            words.append((word, start, done))
        shapes = [_shape(word) for word, _, _ in words]
        #: marked words with only spaces between them
        self.chain = [(i, i + 1) for i in range(len(words) - 1) if not text[words[i][2]:words[i + 1][1]].strip(" ")]
        after, before = dict(self.chain), {b: a for a, b in self.chain}
        self.features, self.labels, self.skip = [], [], []
        last: dict[tuple[str, str], int] = {}
        at = 0
        for i, (word, _, _) in enumerate(words):
            digits = _digits(word)
            known = 14 <= len(digits) <= 19
            self.features.append(_hashed(
                "one", f"shape {shapes[i]}", f"digits {min(len(digits), 20)}", f"at {word.count('@')}", f"dots {min(word.count('.'), 4)}",
                f"sum {known and luhn(digits)}", f"before {shapes[before[i]] if i in before else '-'}", f"after {shapes[after[i]] if i in after else '-'}"))
            start, end = self.spans[i]
            while at < len(self.base) and self.base[at][2] <= start:
                at += 1
            cover = next((s for s in self.base[at:at + 8] if s[0] < end and s[2] > start), None)
            self.labels.append(1 + cover[1] if cover else 0)
            core = word.strip(_EDGES).lower()
            names = {("same", core)}
            if "@" in core[1:]:
                names.add(("local", core.split("@")[0]))
            if len(digits) >= 7:
                names.add(("end", digits[-7:]))
            for name in sorted(names):
                if name in last:
                    self.skip.append((last[name], i))
                last[name] = i


def _joined(graphs: list[Marked]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels, neighbour ties and distant ties of many documents, numbered through."""
    begin = np.cumsum([0] + [len(g.spans) for g in graphs])
    ties = lambda name: np.array([(a + b, c + b) for g, b in zip(graphs, begin) for a, c in getattr(g, name)], np.int64).reshape(-1, 2)
    features = np.array([f for g in graphs for f in g.features], np.int64).reshape(-1, 8)
    return features, np.array([y for g in graphs for y in g.labels], np.int64), ties("chain"), ties("skip")


class Field:
    """Weights of features, and of the labels of tied words."""

    def __init__(self, graphs: list[Marked], steps: int = 300):
        n = len(KINDS) + 1
        features, labels, chain, skip = _joined(graphs)
        self.word, self.chain = np.zeros((FEATURES, n)), np.zeros((n, n))
        prior = 1.5 * np.eye(n)
        self.skip = prior.copy()
        wanted = np.eye(n)[labels]
        moments = [[np.zeros_like(w), np.zeros_like(w)] for w in (self.word, self.chain, self.skip)]
        for step in range(1, steps + 1):  # gradient steps on the pseudo-likelihood
            score = self.word[features].sum(axis=1)
            np.add.at(score, chain[:, 0], self.chain[:, labels[chain[:, 1]]].T)
            np.add.at(score, chain[:, 1], self.chain[labels[chain[:, 0]]])
            np.add.at(score, skip[:, 0], self.skip[labels[skip[:, 1]]])
            np.add.at(score, skip[:, 1], self.skip[labels[skip[:, 0]]])
            chance = np.exp(score - score.max(axis=1, keepdims=True))
            error = wanted - chance / chance.sum(axis=1, keepdims=True)
            word, one, two = np.zeros_like(self.word), np.zeros((n, n)), np.zeros((n, n))
            np.add.at(word, features.ravel(), np.repeat(error, features.shape[1], axis=0))
            np.add.at(one.T, labels[chain[:, 1]], error[chain[:, 0]])
            np.add.at(one, labels[chain[:, 0]], error[chain[:, 1]])
            np.add.at(two, labels[skip[:, 1]], error[skip[:, 0]])
            np.add.at(two, labels[skip[:, 0]], error[skip[:, 1]])
            two = (two + two.T) / 2
            gradients = (word - 0.1 * self.word, one - self.chain, two - 10 * (self.skip - prior))
            for weight, gradient, moment in zip((self.word, self.chain, self.skip), gradients, moments):
                gradient = gradient / len(labels)
                moment[0] = 0.9 * moment[0] + 0.1 * gradient
                moment[1] = 0.999 * moment[1] + 0.001 * gradient ** 2
                weight += 0.1 * (moment[0] / (1 - 0.9 ** step)) / (np.sqrt(moment[1] / (1 - 0.999 ** step)) + 1e-8)

    def marginals(self, graphs: list[Marked]) -> np.ndarray:
        """The probability of each label of each word, by sum-product messages over all ties."""
        features, _, chain, skip = _joined(graphs)
        own = self.word[features].sum(axis=1)
        source = np.concatenate([chain[:, 0], skip[:, 0], chain[:, 1], skip[:, 1]])
        target = np.concatenate([chain[:, 1], skip[:, 1], chain[:, 0], skip[:, 0]])
        half = len(source) // 2
        back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
        kinds = np.concatenate([np.zeros(len(chain), int), np.ones(len(skip), int), np.full(len(chain), 2), np.ones(len(skip), int)])
        tie = np.stack([self.chain, self.skip, self.chain.T])[kinds]
        messages = np.zeros((2 * half, own.shape[1]))
        for _ in range(ROUNDS if half else 0):
            total = own.copy()
            np.add.at(total, target, messages)
            inner = (total[source] - messages[back])[:, :, None] + tie
            top = inner.max(axis=1, keepdims=True)
            new = np.log(np.exp(inner - top).sum(axis=1)) + top[:, 0]
            new -= new.max(axis=1, keepdims=True)
            change = np.abs(new - messages).max()
            messages = DAMPING * messages + (1 - DAMPING) * new
            if change < 1e-3:
                break
        total = own.copy()
        np.add.at(total, target, messages)
        chance = np.exp(total - total.max(axis=1, keepdims=True))
        return chance / chance.sum(axis=1, keepdims=True)


def _added(graph: Marked, chance: np.ndarray) -> list[tuple[int, int, int]]:
    """Spans of sure labels outside the base spans; neighbours of one label are one span."""
    label = chance.argmax(axis=1)
    sure = (label > 0) & (chance.max(axis=1) >= SURE)
    neighbours = set(graph.chain)
    out: list[tuple[int, int, int]] = []
    before = -2
    covered = [(s, e) for s, _, e in graph.base]
    at = 0
    for i in np.flatnonzero(sure).tolist():
        start, end = graph.spans[i]
        while at < len(covered) and covered[at][1] <= start:
            at += 1
        if any(s < end and e > start for s, e in covered[at:at + 8]):
            continue
        if before == i - 1 and (before, i) in neighbours and out and out[-1][1] == label[i] - 1:
            out[-1] = (out[-1][0], out[-1][1], end)
        else:
            out.append((start, int(label[i]) - 1, end))
        before = i
    return out


def _listed(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def learn(documents: DataFrame, texts: int = TRAINING_TEXTS):
    """The field in a broadcast, or None if no sampled text has a marked word."""
    total = documents.count()
    share = min(1.0, texts / max(total, 1))
    by = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000))
    sample = documents.where(F.col("text").isNotNull() & (by < int(share * 1_000_000))).select("text").collect()
    graphs = [g for g in (Marked(t) for t in sorted(r.text for r in sample)) if g.spans]
    return documents.sparkSession.sparkContext.broadcast(Field(graphs)) if graphs else None


def find_private(documents: DataFrame, training_texts: int = TRAINING_TEXTS) -> DataFrame:
    """doc_id, counts and checksum of the base spans, all spans, and the number of added ones, for every document."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    field = learn(texts, training_texts)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            values = batch.column("text").to_pylist()
            graphs = {i: g for i, t in enumerate(values) if t and _MARK.search(t) for g in [Marked(t)]}
            added: dict[int, list] = {}
            some = [i for i, g in graphs.items() if g.spans]
            if field is not None and some:
                chance = field.value.marginals([graphs[i] for i in some])
                begin = 0
                for i in some:
                    n = len(graphs[i].spans)
                    added[i] = _added(graphs[i], chance[begin:begin + n])
                    begin += n
            rows = []
            for i in range(len(values)):
                base, more = graphs[i].base if i in graphs else [], added.get(i, [])
                kinds = [k for _, k, _ in base]
                rows.append((*(kinds.count(k) for k in range(len(KINDS))), hashlib.sha256(_listed(base).encode()).hexdigest(), _listed(sorted(base + more)), len(more)))
            columns = list(zip(*rows))
            yield T.table_of(_ROWS, doc_id=batch.column("doc_id"), **{n: pa.array(c, _ROWS.field(n).type) for n, c in zip(_ROWS.names[1:], columns)})

    return texts.mapInArrow(find, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def op3_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_private(table(spark, sf_dir, "documents"))
