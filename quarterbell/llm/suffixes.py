"""Removal of byte strings that occur in an earlier document, by sorting suffixes.

Suffixes of the documents' bytes are sorted by what they begin with; equal
beginnings are then neighbours, and the one of the least document is earliest.

1. *Which suffixes.* In every window of 50 bytes the 24 bytes of least hash are
   its anchor. Windows in a row with one anchor form a stretch; equal windows
   have equal anchors, so one suffix for each stretch (one for some 13 bytes) is enough
   to find where documents meet. Its leading tokens are the hash of the anchor
   and that of the whole stretch.
2. *Ranges.* Each piece of text sorts its suffixes and keeps, of equal ones, those
   of the least document; the others are repeats already. Splitters from a sample of documents
   cut the sorted run, and its parts go to the buckets of their ranges as blobs.
3. *Buckets* sort what they get by multikey quicksort over the tokens and the
   document. A suffix that follows an equal one of a smaller document is a
   repeat. Where one anchor has different stretches, a repeat may end inside
   them. An anchor may go on in the next bucket: the buckets' first and last
   anchors are compared.
4. *Ends.* Stretches of such anchors are sorted once more, now with a suffix for each
   window and 96 bits of its 50 bytes as tokens.
5. Bytes under a repeated window are removed.

Tokens are hashes, so the order of unlike suffixes is arbitrary but the same
everywhere, which is all that equality needs; two suffixes count as equal if 96 bits agree.
A piece sends one entry at most for equal suffixes of a document, so a passage that all
documents share fills no bucket; buckets are as many as the bytes ask for.

Results in the odd cases: a null or empty text has no bytes and the checksum of
no bytes; a text below 50 bytes keeps all; rows of one id are one
document, whose rows are no repeats of each other, each with its own result; rows
without an id come after all others, in the order of a hash of their texts, and equal
ones are one document; very long texts are worked on alone and whole; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarterbell.llm import tokens as T
from quarterbell.llm.tables import document_key, saved, shuffles_dropped, table

#: Bytes of a window, and of an anchor.
LENGTH, SEED = 50, 24
#: Bytes of text for each bucket: about a million suffixes.
BUCKET_BYTES = 12 << 20
#: Bytes of the documents whose suffixes give the splitters.
SAMPLE_BYTES = 16 << 20
#: Text whose suffixes make one sorted run, and text hashed at once.
RUN_BYTES, HASHED_BYTES = 12 << 20, 1 << 20
#: Entries that are no longer split by a pivot.
SMALL = 1 << 13

_LOW = np.uint64(0xFFFFFFFF)
_TOKEN = np.uint64(16)  # a token has the upper 48 bits of a hash

# A run of windows in one number: first byte, number of windows, whether it is
# a window of its own (a stretch otherwise), whether it occurs again in its row.
_START, _COUNT, _SINGLE, _AGAIN = 7, 2, 2, 1

_PARTS = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("suffixes", pa.binary()), ("n_settled", pa.int32()), ("settled", pa.binary())])
_PARTS_SQL = "bucket int, n int, suffixes binary, n_settled int, settled binary"
_MARKS = pa.schema([("doc", pa.int64()), ("run", pa.int64()), ("content", pa.int64()), ("repeat", pa.bool_()), ("edge", pa.int64()), ("bucket", pa.int32())])
_MARKS_SQL = "doc long, run long, content long, repeat boolean, edge long, bucket int"
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and where each begins (and the last ends)."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    edges = np.concatenate([[0], np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))])
    if not edges[-1]:
        return np.zeros(0, np.uint8), edges
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    begin = int(np.frombuffer(texts.buffers()[1], wide)[texts.offset])
    return np.frombuffer(texts.buffers()[2], np.uint8)[begin:begin + int(edges[-1])], edges


def _hashes(data: np.ndarray, length: int, at: np.ndarray | None = None, seed: int = 1) -> np.ndarray:
    """64 bits of the bytes from each place on (from every place with so many after it)."""
    n = len(data) - 7
    eight = np.ndarray((max(n, 0),), "<u8", np.ascontiguousarray(data), strides=(1,))
    out = np.full(max(len(data) - length + 1, 0) if at is None else len(at), seed, np.uint64)
    for step in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])]:
        out *= T._ODD
        out += eight[step:step + len(out)] if at is None else eight[at + step]
        out ^= out >> np.uint64(29)
        out *= T._MIX1
        out ^= out >> np.uint64(32)
    return out


def _least(keys: np.ndarray, reach: int) -> np.ndarray:
    """The least of each key and those after it, so many in all."""
    n = len(keys) - reach + 1
    blocks = -(-len(keys) // reach)
    padded = np.full(blocks * reach, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(keys)] = keys
    padded = padded.reshape(blocks, reach)
    upto = np.minimum.accumulate(padded, axis=1).ravel()
    onward = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(onward[:n], upto[reach - 1:reach - 1 + n])


def _stretches(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First byte, number of windows, and both leading tokens of each stretch."""
    if len(data) < LENGTH:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.view(np.uint64)
    grams = _hashes(data, SEED)
    keys = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)
    at = (_least(keys, LENGTH - SEED + 1) & _LOW).astype(np.int64)
    crossing = np.zeros(len(at) + 1, np.int64)  # windows that reach beyond their document
    np.add.at(crossing, np.minimum(np.maximum(edges[:-1], edges[1:] - LENGTH + 1), len(at)), 1)
    np.add.at(crossing, np.minimum(edges[1:], len(at)), -1)
    whole = np.cumsum(crossing[:-1]) == 0
    same = whole[1:] & whole[:-1] & (at[1:] == at[:-1])
    first = np.flatnonzero(whole & ~np.concatenate([[False], same]))
    last = np.flatnonzero(whole & ~np.concatenate([same, [False]]))
    count = last - first + 1
    content = T.mix(_hashes(data, LENGTH, first) * np.uint64(3) + T.mix(_hashes(data, LENGTH, last) + count.astype(np.uint64)))
    # least hashes are small: mixed again, anchors are spread as evenly as windows, and the same splitters serve both
    return first, count, T.mix(grams[at[first]]) >> _TOKEN, content >> _TOKEN


def _pack(*columns: np.ndarray) -> bytes:
    """Numbers by planes of their bytes, which compress better than the numbers."""
    planes = [np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T for c in columns]
    return zstandard.ZstdCompressor(level=1).compress(np.concatenate(planes).tobytes())


def _unpack(blobs: list, sizes: np.ndarray, columns: int) -> list[np.ndarray]:
    parts = [np.zeros((columns, 0), np.int64)]
    for blob, n in zip(blobs, sizes):
        if n:
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(columns, 8, n)
            parts.append(np.ascontiguousarray(planes.transpose(0, 2, 1)).view(np.int64)[..., 0])
    return list(np.concatenate(parts, axis=1))


def multikey_quicksort(tokens: list[np.ndarray]) -> np.ndarray:
    """The order of entries by their tokens, first to last.

    Entries are parted by a pivot into less, equal and greater ones; only the
    equal ones go on to the next token. Small parts are ordered at once.
    """
    order = np.arange(len(tokens[0]))
    parts = [(0, len(order), 0)]
    while parts:
        low, high, depth = parts.pop()
        if high - low < 2 or depth == len(tokens):
            continue
        part = order[low:high]
        if high - low <= SMALL:
            order[low:high] = part[np.lexsort([t[part] for t in tokens[depth:][::-1]])]
            continue
        keys = tokens[depth][part]
        some = np.sort(keys[::max(1, len(keys) // 31)])
        pivot = some[len(some) // 2]
        less, more = keys < pivot, keys > pivot
        order[low:high] = np.concatenate([part[less], part[~(less | more)], part[more]])
        a, b = low + int(less.sum()), high - int(more.sum())
        parts += [(low, a, depth), (a, b, depth + 1), (b, high, depth)]
    return order


def _bucket(splitters: np.ndarray, lead: np.ndarray, second: np.ndarray) -> np.ndarray:
    """How many splitters come no later than each entry."""
    out = np.searchsorted(splitters[:, 0], lead, "left")
    upto = np.searchsorted(splitters[:, 0], lead, "right")
    for i in np.flatnonzero(upto > out):
        out[i] += np.searchsorted(splitters[out[i]:upto[i], 1], second[i], "right")
    return out


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where entries differ from the one before."""
    new = np.zeros(len(keys[0]), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return new


def _sorted_run(lead, second, row, doc, run) -> tuple[np.ndarray, ...]:
    """Entries of a piece (in the order of rows and places), sorted, once a row; and which of them the piece settles."""
    order = np.lexsort((row, second, lead))
    lead, second, row, run = lead[order], second[order], row[order], run[order]
    once = _starts(lead, second, row)
    at = np.flatnonzero(once)
    again = np.bitwise_or.reduceat(run & _AGAIN, at) | (np.diff(at, append=len(run)) > 1) if len(at) else at
    lead, second, run, doc = lead[at], second[at], run[at] | again, doc[row[at]]
    new = _starts(lead, second)
    least = np.minimum.reduceat(doc, np.flatnonzero(new))[np.cumsum(new) - 1] if len(at) else doc
    return lead, second, doc, run, doc > least


def _parts(splitters: np.ndarray, lead, second, row, doc, run) -> Iterator[pa.RecordBatch]:
    """A row for each bucket that gets suffixes of a piece."""
    lead, second, doc, run, settled = _sorted_run(lead, second, row, doc, run)
    bucket = _bucket(splitters, lead, second)
    edges = np.append(np.flatnonzero(_starts(bucket)), len(bucket))
    out = []
    for low, high in zip(edges[:-1], edges[1:]):
        gone = settled[low:high]
        some = lambda c, keep: c[low:high][keep]
        out.append((
            int(bucket[low]), int((~gone).sum()), _pack(*[some(c, ~gone) for c in (lead, second, doc, run)]),
            int(gone.sum()), _pack(*[some(c, gone) for c in (second, doc, run)])))
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PARTS)], schema=_PARTS)


def _hashed(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """Leading tokens, row and run of the stretches of a batch, from little text at once.

    A very long text is cut: a stretch at the cut is another one then, and its windows are compared singly.
    """
    rows = 0
    for piece in T.chunks([batch], most=HASHED_BYTES):
        data, edges = bytes_of(piece.column("text"))
        step = HASHED_BYTES if piece.num_rows == 1 else len(data) + 1
        for begin in range(0, max(len(data), 1), step):
            part = data[begin:begin + step + LENGTH - 1]
            first, count, lead, second = _stretches(part, np.clip(edges - begin, 0, len(part)))
            row = np.searchsorted(edges, first + begin, "right") - 1
            yield lead, second, row + rows, ((first + begin - edges[row]) << _START) | (count << _COUNT)
        rows += piece.num_rows


def _by_stretch(splitters: np.ndarray):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches, most=RUN_BYTES):
            lead, second, row, run = (np.concatenate(c) for c in zip(*_hashed(batch)))
            yield from _parts(splitters, lead, second, row, batch.column("doc").to_numpy(), run)

    return parts


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in T.chunks(batches):
        lead, second, row, run = (np.concatenate(c) for c in zip(*_hashed(batch)))
        lead, second, _, _, settled = _sorted_run(lead, second, row, batch.column("doc").to_numpy(), run)
        keep = np.flatnonzero(~settled)[::64]
        yield pa.RecordBatch.from_pydict({"lead": T.signed(lead[keep]), "second": T.signed(second[keep])})


def splitters_of(texts: DataFrame) -> np.ndarray:
    """Leading tokens between neighbouring buckets; one row fewer than there are buckets.

    The sample only places the borders: about ``SAMPLE_BYTES`` of documents, every 64th suffix of them.
    """
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    buckets = -(-size // BUCKET_BYTES)
    if buckets < 2:
        return np.zeros((0, 2), np.uint64)
    share = -(-size // SAMPLE_BYTES)
    some = texts.where(F.pmod(F.xxhash64("doc", F.lit(13)), F.lit(share)) == 0).mapInArrow(_sampled, "lead long, second long")
    keys = some.distinct().toArrow()
    lead, second = (keys[c].to_numpy().view(np.uint64) for c in ("lead", "second"))
    order = np.lexsort((second, lead))
    at = order[(np.arange(1, buckets) * len(order)) // buckets] if len(order) else order
    return np.unique(np.stack([lead[at], second[at]], 1), axis=0)


def _judge(parts: pa.Table) -> pa.Table:
    """The repeats of a bucket, what stands at anchors of different stretches, and its first and last anchors."""
    lead, second, doc, run = _unpack(parts["suffixes"].to_pylist(), parts["n"].to_numpy(), 4)
    order = multikey_quicksort([lead, second, doc])
    lead, second, doc, run = lead[order], second[order], doc[order], run[order]
    new_lead, new = _starts(lead), _starts(lead, second)
    of_lead, of = np.cumsum(new_lead) - 1, np.cumsum(new) - 1
    repeat = doc > doc[np.flatnonzero(new)][of] if len(of) else np.zeros(0, bool)
    contested = (np.bincount(of_lead[new])[of_lead] > 1) & ~repeat if len(of) else repeat
    edge = ~repeat & ~contested & ((lead == lead[:1]) | (lead == lead[-1:])) if len(of) else repeat
    keep = repeat | contested | edge
    settled = _unpack(parts["settled"].to_pylist(), parts["n_settled"].to_numpy(), 3)
    ends = np.unique(np.concatenate([lead[:1], lead[-1:]]))
    n, m, k = int(keep.sum()), len(settled[0]), len(ends)
    join = lambda *c: np.concatenate(c)
    no = np.zeros(m, bool)
    return pa.table([
        pa.array(join(doc[keep], settled[1], np.zeros(k, np.int64)), mask=join(np.zeros(n + m, bool), np.ones(k, bool))),
        join(run[keep], settled[2], np.zeros(k, np.int64)), join(second[keep], settled[0], np.zeros(k, np.int64)),
        join(repeat[keep], ~no, np.zeros(k, bool)),
        pa.array(join(lead[keep], np.zeros(m, np.int64), ends), mask=join(~edge[keep], ~no, np.zeros(k, bool))),
        np.full(n + m + k, parts["bucket"][0].as_py(), np.int32)], schema=_MARKS)


def _marked(batch: pa.RecordBatch, data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, first byte, windows and flags of each mark that belongs to a row's text."""
    lists = batch.column("marks")
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    marks = lists.flatten()
    run, content = (marks.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("run", "content"))
    first, count = edges[row] + (run >> _START), (run >> _COUNT) & 31
    inside = first + count - 1 + LENGTH <= edges[row + 1]  # rows of one id may have different texts
    row, run, content, first, count = row[inside], run[inside], content[inside], first[inside], count[inside]
    begin, end = (_hashes(data, LENGTH, at) for at in (first, first + count - 1))
    stretch = T.mix(begin * np.uint64(3) + T.mix(end + count.astype(np.uint64)))
    single = _hashes(data, LENGTH, first, seed=2)
    own = T.signed(np.where(run & _SINGLE, single, stretch) >> _TOKEN) == content
    return row[own], first[own], count[own], run[own] & (_SINGLE | _AGAIN)


def _by_window(splitters: np.ndarray):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in T.chunks(batches):
            data, edges = bytes_of(batch.column("text"))
            row, first, count, flags = _marked(batch, data, edges)
            if not len(row):
                continue
            steps = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            at, of = np.repeat(first, count) + steps, np.repeat(row, count)
            run = ((at - edges[of]) << _START) | (1 << _COUNT) | _SINGLE | np.repeat(flags & _AGAIN, count)
            lead, second = (_hashes(data, LENGTH, at, seed) >> _TOKEN for seed in (1, 2))
            yield from _parts(splitters, lead, second, of, batch.column("doc").to_numpy(), run)

    return parts


def _keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each document."""
    for batch in T.chunks(batches):
        data, edges = bytes_of(batch.column("text"))
        row, first, count, flags = _marked(batch, data, edges)
        covered = np.zeros(len(data) + 1, np.int32)
        np.add.at(covered, first, 1)
        np.add.at(covered, first + count - 1 + LENGTH, -1)
        again = np.flatnonzero(flags & _AGAIN)
        for doc in np.unique(row[again]):  # all places of a row that hold what its marks hold
            low, high = edges[doc], edges[doc + 1]
            mine = again[row[again] == doc]
            at = np.unique(np.concatenate([first[mine] + k for k in range(31)])[np.concatenate([count[mine] > k for k in range(31)])])
            found = low + np.flatnonzero(np.isin(_hashes(data[low:high], LENGTH), _hashes(data, LENGTH, at)))
            np.add.at(covered, found, 1)
            np.add.at(covered, found + LENGTH, -1)
        gone = np.cumsum(covered[:-1]) > 0
        removed = np.concatenate([[0], np.cumsum(gone)])
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        inner = edges[:-1][edges[:-1] < len(data)]
        begins[inner] = gone[inner]
        spans = np.concatenate([[0], np.cumsum(begins)])
        kept = data[~gone].tobytes()
        ends = edges - removed[edges]
        digests = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(ends[:-1], ends[1:])]
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"), pa.array(np.diff(edges)), pa.array(np.diff(removed[edges])), pa.array(np.diff(spans[edges])),
            pa.array(digests, pa.string())], schema=_KEPT)


def without_repeated_bytes(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the checksum of the kept bytes of every document."""
    texts = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
        document_key(F.col("doc_id"), F.col("text")).alias("doc"))
    splitters = splitters_of(texts)

    def with_marks(marks: DataFrame) -> DataFrame:
        """The same columns of documents each time, so that one exchange serves both passes over them."""
        lists = marks.groupBy("doc").agg(F.collect_list(F.struct("run", "content")).alias("marks"))
        return texts.join(lists.hint("merge"), "doc", "left").select("doc_id", "doc", "text", "marks")

    suffixes = texts.select("doc", "text").mapInArrow(_by_stretch(splitters), _PARTS_SQL)
    with shuffles_dropped(documents.sparkSession):
        marks = saved(suffixes.groupBy("bucket").applyInArrow(_judge, _MARKS_SQL), "suffix-marks")
    # an anchor that ends one bucket and begins the next has different stretches there
    shared = marks.where("doc IS NULL").groupBy(F.col("edge").alias("shared")).agg(F.count_distinct("bucket").alias("buckets")).where("buckets > 1")
    inner = marks.where("doc IS NOT NULL AND NOT repeat AND edge IS NULL")
    across = marks.where("doc IS NOT NULL AND NOT repeat AND edge IS NOT NULL").join(shared, F.col("edge") == F.col("shared"), "left_semi")
    contested = inner.unionByName(across).select("doc", "run", "content")
    windows = (
        with_marks(contested).mapInArrow(_by_window(splitters), _PARTS_SQL)
        .groupBy("bucket").applyInArrow(_judge_windows, _MARKS_SQL).select("doc", "run", "content")
    )
    repeats = marks.where("repeat").select("doc", "run", "content").unionByName(windows)
    return with_marks(repeats).mapInArrow(_keep, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _judge_windows(parts: pa.Table) -> pa.Table:
    """The repeats of a bucket of single windows, whose equal suffixes are all in it."""
    marks = _judge(parts)
    return marks.filter(marks["repeat"])


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeated_bytes(table(spark, sf_dir, "documents"))
