"""Words of a batch of texts as numpy arrays: places, hashes, n-grams.

Everything works on the UTF-8 bytes of an Arrow string column, many documents
at a time. Both kinds of words are defined by ASCII characters alone, so bytes
and code points cut the texts in the same places.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text worked on at once. A longer text is worked on alone and whole.
CHUNK_BYTES = 4 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def _table(inside: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(inside)] = True
    return table


#: `[^\x20\x09-\x0D]+`
SPACED = _table(bytes(c for c in range(256) if c != 0x20 and not 0x09 <= c <= 0x0D))
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` once A-Z are lower case
LETTERS = _table(bytes(c for c in range(256) if c >= 0x80 or chr(c).isalnum()))
_LOWER = np.array([c + 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
_KEEP = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def seeded(x: np.ndarray, seed: int) -> np.ndarray:
    return mix(x + np.uint64((seed * int(_ODD) + 0x632BE59BD9B4E019) % 2**64))


@dataclass
class Words:
    """The words of some documents, document after document.

    ``first`` has the number of the first word of each document, and the number
    of all words at the end.
    """

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """The document of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    @property
    def room(self) -> np.ndarray:
        """Words from each word to the end of its document, itself included."""
        return np.repeat(self.first[1:], self.counts) - np.arange(len(self))

    def hashes(self) -> np.ndarray:
        """64 bits of each word; no two words of up to 8 bytes share them at the same length."""
        size = self.end - self.start
        padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
        eight = np.ndarray((len(self.data) + 1,), "<u8", padded, strides=(1,))
        out = mix((eight[self.start] & _KEEP[np.minimum(size, 8)]) + size.astype(np.uint64) * _ODD)
        at, more = 8, np.flatnonzero(size > 8)
        while len(more):
            left = np.minimum(size[more] - at, 8)
            out[more] = mix(out[more] * _ODD + (eight[self.start[more] + at] & _KEEP[left]))
            at += 8
            more = more[size[more] > at]
        return out

    def word(self, at: int) -> bytes:
        return self.data[self.start[at]:self.end[at]].tobytes()


def words_of(texts: pa.Array, inside: np.ndarray = SPACED, lower: bool = False) -> Words:
    """The words of an Arrow string array; a null text has none."""
    texts = pc.fill_null(texts, "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    wide = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    at, n = texts.offset, len(texts)
    edges = np.frombuffer(texts.buffers()[1], wide)[at:at + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    raw = texts.buffers()[2] if n else None
    data = np.frombuffer(raw, np.uint8)[edges[0]:edges[-1]] if raw is not None else np.zeros(0, np.uint8)
    edges = edges - edges[0]
    if lower:
        data = _LOWER[data]
    word = inside[data]
    begins = word.copy()
    begins[1:] &= ~word[:-1]
    begins[edges[:-1][edges[:-1] < len(data)]] = word[edges[:-1][edges[:-1] < len(data)]]
    ends = word.copy()
    ends[:-1] &= ~word[1:]
    last = edges[1:] - 1
    last = last[last >= 0]
    ends[last] = word[last]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, np.searchsorted(start, edges))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """64 bits of the n words from each word on, also across documents; zeros where they run out."""
    out = np.zeros(len(hashes), np.uint64)
    if len(hashes) >= n:
        sums = np.zeros(len(hashes) - n + 1, np.uint64)
        for k in range(n):
            sums = sums * _ODD + hashes[k:len(hashes) - n + 1 + k]
        out[:len(sums)] = mix(sums)
    return out


def chunks(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in pieces of a bounded amount of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 16)
        begin = 0
        while begin < batch.num_rows:
            before = size[begin - 1] if begin else 0
            stop = max(begin + 1, int(np.searchsorted(size, before + most, "right")))
            yield batch.slice(begin, stop - begin)
            begin = stop


def table_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    arrays = [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for f, c in zip(schema, (columns[f.name] for f in schema))]
    return pa.RecordBatch.from_arrays([a.cast(f.type) if a.type != f.type else a for a, f in zip(arrays, schema)], schema=schema)


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return x.view(np.int64)
