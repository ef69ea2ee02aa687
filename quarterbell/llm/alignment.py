"""Alignment of two tokenizers' tokens, as a monoid of fragments.

A text's bytes are tiled by the tokens of A and by those of B. Where tokens of both
begin, a group begins. A fragment stands for a byte range of a document:

    open    tokens that begin in the range, none of A where one of B does
    cut     an open prefix, closed groups, an open suffix

Fragments of neighbouring ranges compose: the left suffix and the right prefix
become one closed group. Composition is associative, so ranges can be worked
on anywhere and reduced as a tree.

1. Texts of up to ``CHUNK_BYTES`` are one range each; many are aligned at once as arrays.
2. Longer texts are cut between words, where no token of either crosses (a single space
   between two letters or digits), and dealt over the tasks. Each part's tokens are cut at the multiples of ``CHUNK_BYTES``, wherever
   these fall, into fragments. Fragments of one byte range compose, then neighbouring ranges, ``FAN`` at a time.
3. A link is a pair of tokens whose byte ranges overlap. Each piece of text sends
   one row for each of its pairs of ids; counts come back to the pieces by a join.

Tokenizers are read from a folder that every executor has; ``folder`` names it. A is
run from its vocabulary as ranks, which gives the same tokens (tests compare).

Results in the odd cases: null and empty texts, and those that the tokens do not
give back byte by byte (B has no token for U+2581, for instance), have no tokens:
zeros and an empty ``groups_sha256``; an id may be null or repeat, each row has its own
result; a long stretch without a place to cut is tokenized in one task; counts
tie: all pairs of the highest count are best; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbell.llm import tokens as T
from quarterbell.llm.tables import saved, table

TOKENIZERS = "/opt/tokenizers"
#: Bytes of a range; longer texts are cut.
CHUNK_BYTES = 64 << 10
#: Neighbouring ranges composed at once.
FAN = 16
#: Text whose pairs are sent together, and text tokenized at once.
PIECE_BYTES, BATCH_BYTES = 12 << 20, 1 << 20

# How the byte-level vocabulary cuts texts before merging.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
_CUT = re.compile(r"(?<=[^\W_]) (?=[^\W_])")


class _Side:
    """Bytes and decimals of the tokens of one tokenizer."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)[:-1]])
        self.data = np.frombuffer(b"".join(tokens) + b"\0", np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        size = self.size[ids]
        ends = np.cumsum(size)
        return self.data[np.repeat(self.begin[ids] - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def _byte_letters() -> dict[str, int]:
    """The byte of each letter of a byte-level vocabulary: printable ones stand for themselves, others for 256 and on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizers:
    """A and B of a folder."""

    def __init__(self, folder: str):
        import sentencepiece
        import tiktoken

        with open(f"{folder}/byte_bpe_50k.json", encoding="utf-8") as file:
            model = json.load(file)
        special = {t["content"] for t in model["added_tokens"]}
        letters = _byte_letters()
        ranks = {bytes(letters[c] for c in token): i for token, i in model["model"]["vocab"].items() if token not in special}
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            tokens[i] = token
        self._a = tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.a = _Side(tokens)
        self._b = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/piece_bpe_32k.model")
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self.b = _Side([
            bytes([int(_BYTE_PIECE.fullmatch(p)[1], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)])

    def encode(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Tokens of A of a space and the text, and of B of the text (which adds the space)."""
        return [self._a.encode_ordinary(" " + text) for text in texts], self._b.encode(texts, num_threads=1)


_loaded: dict[str, Tokenizers] = {}


def tokenizers(folder: str = TOKENIZERS) -> Tokenizers:
    if folder not in _loaded:
        _loaded[folder] = Tokenizers(folder)
    return _loaded[folder]


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    total = np.concatenate([[0], np.cumsum(values)])
    return total[ends] - total[ends - sizes]


@dataclass
class Units:
    """What closed stretches of tokens come to: one row for each stretch.

    ``pair`` and ``times`` list the pairs of ids of each stretch in order, ``pairs`` of them.
    """

    groups: np.ndarray
    links: np.ndarray
    texts: list[bytes]
    pairs: np.ndarray
    pair: np.ndarray
    times: np.ndarray


#: Decimals of the ids below 65,536 from the left, with nothing (0) and how many after them.
_ID = np.arange(1 << 16)
_DIGITS = 1 + sum((_ID >= 10**k).astype(np.uint8) for k in range(1, 5))
_DECIMALS = np.stack([np.where(k < _DIGITS, 48 + _ID // 10 ** np.maximum(_DIGITS.astype(int) - 1 - k, 0) % 10, 0) for k in range(6)], 1).astype(np.uint8)


def _decimals(ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The decimals of all ids, each with what comes after it (0: nothing), and where each ends."""
    wide = _DECIMALS[ids]
    digits = _DIGITS[ids]
    wide[np.arange(len(ids)), digits] = after
    return wide[wide > 0], np.cumsum(digits.astype(np.int64) + (after > 0))


def align(tok: Tokenizers, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> Units:
    """Groups and links of stretches of tokens; n_a and n_b tokens each, over the same bytes."""
    count = len(n_a)
    size_a, size_b = tok.a.size[a], tok.b.size[b]
    start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    total = int(size_a.sum())
    is_a, is_b = np.zeros(total, bool), np.zeros(total, bool)
    is_a[start_a], is_b[start_b] = True, True
    group = np.cumsum(is_a & is_b) - 1
    group_a, group_b = group[start_a], group[start_b]
    of_a, of_b = np.repeat(np.arange(count), n_a), np.repeat(np.arange(count), n_b)
    first = np.ones(len(a), bool)
    first[1:] = group_a[1:] != group_a[:-1]
    groups = np.bincount(of_a[first], minlength=count)
    # tokens in the order of groups, A before B
    in_b = np.bincount(group_b, minlength=int(groups.sum()))
    at_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]
    at_b = np.arange(len(b)) + np.cumsum(np.bincount(group_a, minlength=len(in_b)))[group_b]
    ids, side = np.empty(len(a) + len(b), np.int64), np.empty(len(a) + len(b), np.int64)
    for at, token, where, name in ((at_a, a, group_a, 0), (at_b, b, group_b, 1)):
        ids[at], side[at] = token, 2 * where + name
    after = np.full(len(ids), ord(","), np.uint8)
    change = np.flatnonzero(side[1:] != side[:-1])
    after[change] = np.where(side[change] % 2 == 0, ord("|"), ord(";"))
    ends_of = np.cumsum(n_a + n_b)
    after[ends_of[n_a > 0] - 1] = 0
    text, ends = _decimals(ids, after)
    ends = np.concatenate([[0], ends]).astype(np.int64)[np.concatenate([[0], ends_of])]
    text = text.tobytes()
    # each stretch of bytes between neighbouring starts is one link
    starts = np.flatnonzero(is_a | is_b)
    token_a, token_b = (np.cumsum(x)[starts] - 1 for x in (is_a, is_b))
    of = of_a[token_a]
    key = np.sort((of.astype(np.uint64) << np.uint64(32)) | (b[token_b] * len(tok.a.size) + a[token_a]).astype(np.uint64))
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    at = np.flatnonzero(new)
    return Units(
        groups, np.bincount(of, minlength=count), [text[i:j] for i, j in zip(ends[:-1], ends[1:])],
        np.bincount((key[at] >> np.uint64(32)).astype(np.int64), minlength=count),
        (key[at] & np.uint64(0xFFFFFFFF)).astype(np.uint32), np.diff(at, append=len(key)).astype(np.uint32))


def _kept(sizes: np.ndarray, keep: np.ndarray) -> np.ndarray:
    return np.repeat(keep, sizes)


def _encoded(tok: Tokenizers, texts: list[str]):
    """Tokens of texts, how many of each, and which texts they give back."""
    (a, n_a), (b, n_b) = map(_flat, tok.encode(texts))
    whole = [b" " + text.encode() for text in texts]
    size = np.array([len(t) for t in whole], np.int64)
    same = (_sums(tok.a.size[a], n_a) == size) & (_sums(tok.b.size[b], n_b) == size)
    wanted = np.frombuffer(b"".join(t for t, s in zip(whole, same) if s), np.uint8)
    owner = np.repeat(np.flatnonzero(same), size[same])
    for side, ids, n in ((tok.a, a, n_a), (tok.b, b, n_b)):
        same[owner[side.bytes_of(ids[_kept(n, same)]) != wanted]] = False
        wanted, owner = wanted[same[owner]], owner[same[owner]]
    return a[_kept(n_a, same)], b[_kept(n_b, same)], np.where(same, n_a, 0), np.where(same, n_b, 0), same


# Fragments.


@dataclass(frozen=True)
class Fragment:
    """A byte range of a document; ``head`` is None while nothing is closed or cut.

    ``tail`` are the tokens (of A, of B) from the last place where both begin; in
    an open fragment all of them. ``closed`` are the groups between head and tail
    as text, with their numbers of groups and links and their pairs.
    """

    tail: tuple[np.ndarray, np.ndarray]
    head: tuple[np.ndarray, np.ndarray] | None = None
    closed: bytes = b""
    groups: int = 0
    links: int = 0
    pair: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    times: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))
    n_a: int = 0
    n_b: int = 0
    good: bool = True


def _added(left: tuple, right: tuple) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate([left[0], right[0]]), np.concatenate([left[1], right[1]])


def _merged(pairs: list[np.ndarray], times: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    pair, of = np.unique(np.concatenate(pairs), return_inverse=True)
    return pair, np.bincount(of, np.concatenate(times), len(pair)).astype(np.uint32)


def _seam(tok: Tokenizers, tokens: tuple[np.ndarray, np.ndarray]) -> Units:
    """The one group that two open ends make (none if there are no tokens)."""
    return align(tok, *tokens, np.array([len(tokens[0])]), np.array([len(tokens[1])]))


def compose(tok: Tokenizers, fragments: list[Fragment]) -> Fragment:
    """Neighbouring fragments as one; the order matters, where to put brackets doesn't."""
    totals = dict(n_a=sum(f.n_a for f in fragments), n_b=sum(f.n_b for f in fragments), good=all(f.good for f in fragments))
    if not totals["good"]:
        none = np.zeros(0, np.int64)
        return Fragment((none, none), **totals)
    head, tail = None, fragments[0].tail
    closed, groups, links, pairs, times = [], 0, 0, [], []
    for i, f in enumerate(fragments):
        if f.head is None:
            tail = _added(tail, f.tail) if i else tail
            continue
        before = _added(tail, f.head) if i else f.head
        if head is None:
            head = before
        elif len(before[0]) + len(before[1]):
            seam = _seam(tok, before)
            closed += seam.texts
            groups, links = groups + 1, links + int(seam.links[0])
            pairs.append(seam.pair)
            times.append(seam.times)
        if f.closed:
            closed.append(f.closed)
        groups, links, tail = groups + f.groups, links + f.links, f.tail
        pairs.append(f.pair)
        times.append(f.times)
    if head is None:
        return Fragment(tail, **totals)
    pair, time = _merged(pairs, times)
    return Fragment(tail, head, b";".join(closed), groups, links, pair, time, **totals)


def fragment(tok: Tokenizers, a: np.ndarray, b: np.ndarray, start_a: np.ndarray, start_b: np.ndarray) -> Fragment:
    """The fragment of a range, of the tokens that begin in it and where they do."""
    common = np.intersect1d(start_a, start_b, assume_unique=True)
    totals = dict(n_a=len(a), n_b=len(b))
    if not len(common):
        return Fragment((a, b), **totals)
    (low_a, high_a), (low_b, high_b) = (np.searchsorted(s, [common[0], common[-1]]) for s in (start_a, start_b))
    units = align(tok, a[low_a:high_a], b[low_b:high_b], np.array([high_a - low_a]), np.array([high_b - low_b]))
    return Fragment(
        (a[high_a:], b[high_b:]), (a[:low_a], b[:low_b]), units.texts[0], int(units.groups[0]), int(units.links[0]), units.pair, units.times, **totals)


def finished(tok: Tokenizers, whole: Fragment) -> tuple[int, int, int, int, str, np.ndarray, np.ndarray]:
    """n_a, n_b, n_groups, n_links, checksum, pairs and their numbers of a whole document's fragment."""
    if not whole.good or not whole.n_a:
        return 0, 0, 0, 0, "", whole.pair[:0], whole.times[:0]
    # a document begins and ends where tokens of both do: its head is empty and its tail one group
    last = _seam(tok, whole.tail)
    text = b";".join(filter(None, [whole.closed, last.texts[0]]))
    pair, times = _merged([whole.pair, last.pair], [whole.times, last.times])
    return whole.n_a, whole.n_b, whole.groups + 1, whole.links + int(last.links[0]), hashlib.sha256(text).hexdigest(), pair, times


# Spark.

_ALIGNED = pa.schema([
    ("piece", pa.int64()), ("doc_id", pa.list_(pa.int64())), *[(c, pa.list_(pa.int64())) for c in ("n_a", "n_b", "n_groups", "n_links", "n_pairs")],
    ("groups_sha256", pa.list_(pa.string())), ("pairs", pa.binary())])
_ALIGNED_SQL = (
    "piece long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, n_pairs array<long>, "
    "groups_sha256 array<string>, pairs binary")
_PARTS_SQL = "row long, doc_id long, part long, begin long, text string"
_FRAGMENTS = pa.schema([
    ("row", pa.int64()), ("doc_id", pa.int64()), ("range", pa.int64()), ("part", pa.int64()), ("cut", pa.bool_()), ("good", pa.bool_()),
    *[(c, pa.int64()) for c in ("n_a", "n_b", "groups", "links")], ("closed", pa.binary()),
    *[(c, pa.list_(pa.int64())) for c in ("head_a", "head_b", "tail_a", "tail_b")], ("pairs", pa.binary())])
_FRAGMENTS_SQL = (
    "row long, doc_id long, range long, part long, cut boolean, good boolean, n_a long, n_b long, groups long, links long, closed binary, "
    "head_a array<long>, head_b array<long>, tail_a array<long>, tail_b array<long>, pairs binary")


def _packed(pair: np.ndarray, times: np.ndarray) -> bytes:
    planes = np.concatenate([c.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.ravel() for c in (pair, times)])
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    n = len(planes) // 8
    return tuple(np.ascontiguousarray(planes[k * 4 * n:(k + 1) * 4 * n].reshape(4, n).T).view(np.uint32).ravel() for k in (0, 1))


def _piece(piece: int, doc_ids: list, results: list[tuple]) -> pa.RecordBatch:
    """A row of documents: (n_a, n_b, n_groups, n_links, checksum, pairs, their numbers) of each."""
    columns = list(zip(*results))
    sizes = [len(p) for p in columns[5]]
    lists = [columns[0], columns[1], columns[2], columns[3], sizes]
    return pa.RecordBatch.from_arrays(
        [pa.array([piece], pa.int64()), pa.array([doc_ids], pa.list_(pa.int64())), *[pa.array([list(map(int, c))], pa.list_(pa.int64())) for c in lists],
         pa.array([list(columns[4])], pa.list_(pa.string())), pa.array([_packed(np.concatenate(columns[5]), np.concatenate(columns[6]))], pa.binary())],
        schema=_ALIGNED)


def _results(tok: Tokenizers, texts: list[str]) -> list[tuple]:
    a, b, n_a, n_b, same = _encoded(tok, texts)
    units = align(tok, a, b, n_a, n_b)
    edges = np.concatenate([[0], np.cumsum(units.pairs)])
    return [
        (n_a[i], n_b[i], units.groups[i], units.links[i], hashlib.sha256(units.texts[i]).hexdigest() if n_a[i] else "",
         units.pair[edges[i]:edges[i + 1]], units.times[edges[i]:edges[i + 1]]) for i in range(len(texts))]


def _short_texts(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, piece = tokenizers(folder), TaskContext.get().partitionId() << 32
        for batch in T.chunks(batches, most=PIECE_BYTES):
            results = []
            for part in T.chunks([batch], most=BATCH_BYTES):
                texts = pc.fill_null(part.column("text"), "").to_pylist()
                some = [i for i, text in enumerate(texts) if text]
                found = dict(zip(some, _results(tok, [texts[i] for i in some]))) if some else {}
                none = (0, 0, 0, 0, "", np.zeros(0, np.uint32), np.zeros(0, np.uint32))
                results += [found.get(i, none) for i in range(len(texts))]
            yield _piece(piece, batch.column("doc_id").to_pylist(), results)
            piece += 1

    return run


def _cut_texts(chunk: int):
    """Parts of long texts that can be tokenized on their own; each begins with a space that is not in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text"))):
                places = [-1]
                while (found := _CUT.search(text, places[-1] + chunk)) is not None:
                    places.append(found.start())
                begin = 0
                for part, (low, high) in enumerate(zip(places, [*places[1:], len(text)])):
                    yield pa.RecordBatch.from_pydict({
                        "row": [row], "doc_id": pa.array([doc_id], pa.int64()), "part": [part], "begin": [begin], "text": [text[low + 1:high]]})
                    begin += len(text[low + 1:high].encode()) + 1

    return run


def _row(row: int, doc_id: int | None, of: int, part: int, f: Fragment) -> tuple:
    head = f.head or (np.zeros(0, np.int64),) * 2
    return (row, doc_id, of, part, f.head is not None, f.good, f.n_a, f.n_b, f.groups, f.links, f.closed,
            *[x.tolist() for x in (*head, *f.tail)], _packed(f.pair, f.times))


def _rows(rows: list[tuple]) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _FRAGMENTS)], schema=_FRAGMENTS)


def _fragments(folder: str, chunk: int):
    """The fragments of a part: one for each byte range of the document that it lies in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizers(folder)
        for batch in batches:
            for row, doc_id, part, begin, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "part", "begin", "text"))):
                a, b, _, _, same = _encoded(tok, [text])
                if not same[0]:
                    none = np.zeros(0, np.int64)
                    yield from _rows([_row(row, doc_id, begin // chunk, part, Fragment((none, none), good=False))]).to_batches()
                    continue
                start_a, start_b = (begin + np.cumsum(s) - s for s in (tok.a.size[a], tok.b.size[b]))
                rows = []
                for of in range(begin // chunk, int(max(start_a[-1], start_b[-1])) // chunk + 1):
                    (low_a, high_a), (low_b, high_b) = (
                        np.searchsorted(s, [of * chunk, (of + 1) * chunk]) for s in (start_a, start_b))
                    rows.append(_row(row, doc_id, of, part, fragment(
                        tok, a[low_a:high_a], b[low_b:high_b], start_a[low_a:high_a], start_b[low_b:high_b])))
                yield from _rows(rows).to_batches()

    return run


def _read(row: dict) -> Fragment:
    sides = {c: np.array(row[c], np.int64) for c in ("head_a", "head_b", "tail_a", "tail_b")}
    return Fragment(
        (sides["tail_a"], sides["tail_b"]), (sides["head_a"], sides["head_b"]) if row["cut"] else None, row["closed"], row["groups"], row["links"],
        *_unpacked(row["pairs"]), row["n_a"], row["n_b"], row["good"])


def _composed(folder: str):
    def run(fragments: pa.Table) -> pa.Table:
        rows = fragments.sort_by([("range", "ascending"), ("part", "ascending")]).to_pylist()
        whole = compose(tokenizers(folder), [_read(r) for r in rows])
        return _rows([_row(rows[0]["row"], rows[0]["doc_id"], rows[0]["step"], 0, whole)])

    return run


def _finished(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _piece(-1 - row["row"], [row["doc_id"]], [finished(tokenizers(folder), _read(row))])

    return run


def _aligned_long(texts: DataFrame, folder: str, chunk: int) -> DataFrame:
    """The rows of ``_short_texts`` for texts beyond a range, one piece each."""
    parts = texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(_cut_texts(chunk), _PARTS_SQL).repartition("row", "part")
    fragments = saved(parts.mapInArrow(_fragments(folder, chunk), _FRAGMENTS_SQL), "alignment-fragments")
    ranges, fan = (fragments.agg(F.max("range")).first()[0] or 0) + 1, 1
    while fan == 1 or ranges > 1:  # first the fragments of one range, then ranges side by side
        fragments = fragments.withColumn("step", F.floor(F.col("range") / fan)).groupBy("row", "step").applyInArrow(_composed(folder), _FRAGMENTS_SQL)
        ranges, fan = -(-ranges // fan), FAN
    return fragments.mapInArrow(_finished(folder), _ALIGNED_SQL)


def _pairs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of each piece, with their numbers."""
    for batch in batches:
        for piece, blob in zip(batch.column("piece").to_pylist(), batch.column("pairs").to_pylist()):
            pair, times = _unpacked(blob)
            pair, of = np.unique(pair, return_inverse=True)
            n = np.bincount(of, times, len(pair)).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"piece": np.full(len(pair), piece), "pair": pair.astype(np.int64), "n": n})


def _scored(pieces: pa.Table, found: pa.Table) -> pa.Table:
    """Each document of a piece, with its links' counts."""
    order = np.argsort(found["pair"].to_numpy())
    known, count, best = (found[c].to_numpy()[order] for c in ("pair", "count", "best"))
    out = []
    for piece in pieces.to_pylist():
        pair, times = _unpacked(piece["pairs"])
        at = np.searchsorted(known, pair)
        sizes, times = np.array(piece["n_pairs"], np.int64), times.astype(np.int64)
        sums = [_sums(x, sizes) for x in (times * best[at], times * count[at])] if len(pair) else [np.zeros(len(sizes), np.int64)] * 2
        out.append(pa.table({
            **{c: pa.array(piece[c], pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")},
            "n_best": sums[0], "count_sum": sums[1], "groups_sha256": pa.array(piece["groups_sha256"], pa.string())}))
    return pa.concat_tables(out) if out else pa.table(
        {c: pa.array([], pa.string() if c == "groups_sha256" else pa.int64()) for c in
         ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")})


def align_tokens(documents: DataFrame, folder: str = TOKENIZERS) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    long = F.coalesce(F.octet_length("text") > CHUNK_BYTES, F.lit(False))
    short = texts.where(~long).mapInArrow(_short_texts(folder), _ALIGNED_SQL)
    aligned = saved(short.unionByName(_aligned_long(texts.where(long), folder, CHUNK_BYTES)), "alignment-pieces")
    pairs = saved(aligned.select("piece", "pairs").mapInArrow(_pairs_of, "piece long, pair long, n long"), "alignment-pairs")
    counts = pairs.groupBy("pair").agg(F.sum("n").alias("count"))
    b = F.floor(F.col("pair") / len(tokenizers(folder).a.size))
    # one row for each id of B at most
    highest = counts.groupBy(b.alias("b")).agg(F.max("count").alias("highest"))
    marked = counts.join(F.broadcast(highest), b == F.col("b")).select("pair", "count", (F.col("count") == F.col("highest")).cast("long").alias("best"))
    found = pairs.select("piece", "pair").join(marked.hint("shuffle_hash"), "pair")
    return aligned.groupBy("piece").cogroup(found.groupBy("piece")).applyInArrow(
        _scored, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def op11_align_tokenizers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_tokens(table(spark, sf_dir, "documents"))
