"""Words of many texts at once, as numpy arrays over one byte buffer.

A batch of texts is laid end to end as UTF-8 bytes with a separator behind each text. Words are runs of bytes that
are no separators; each gets a 64-bit hash of its lower-cased bytes. Everything is exact up to collisions of 64-bit
hashes. Memory is a small multiple of the batch, and a batch is a bounded number of bytes unless one text is longer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BATCH_BYTES = 2 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _table(separators) -> np.ndarray:
    """For each byte: 0 for a separator, else the lower-cased byte."""
    table = np.arange(256, dtype=np.uint8)
    table[ord("A") : ord("Z") + 1] += 32
    table[list(separators)] = 0
    return table


#: Words of op1 and op6: everything but blank and the controls 9 to 13. Byte 0 is a word byte there, so it is moved aside.
BLANKS = _table([0x20, *range(0x09, 0x0E)])
BLANKS[0] = 0xFF
#: Words of op10: digits, letters and all bytes of characters beyond ASCII.
PUNCTUATION = _table([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finalizer of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, kept for the next batch."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(n, BATCH_BYTES + (1 << 16))
        row = np.full(size, base % (1 << 64), dtype=np.uint64)
        row[0] = 1
        have = np.multiply.accumulate(row)
        if size <= 8 * BATCH_BYTES:
            _POWERS[base] = have
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with len + 1 entries, so that span_hash(H, start, end) is a hash of the bytes in between."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of spans of bytes; equal bytes give equal hashes wherever they lie."""
    raw = (prefix[end] - prefix[start]) * powers(_BASE_INVERSE, len(prefix))[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


class Words:
    """The words of some texts: hash (all in order) and first (where each text's words begin, one entry more than texts)."""

    def __init__(self, texts: pa.Array, table: np.ndarray) -> None:
        data, offsets = joined(texts)
        data = table[data]
        inside = np.zeros(len(data) + 1, dtype=bool)
        np.not_equal(data, 0, out=inside[:-1])
        inside[offsets[1:] - 1] = False
        edges = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edges = np.concatenate(([0], edges))
        self.start, self.end = edges[0::2], edges[1::2]
        self.hash = span_hash(prefix_hash(data), self.start, self.end)
        self.first = np.searchsorted(self.start, offsets)


def joined(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts as UTF-8 bytes, each followed by a zero byte, and where each begins. Null is empty."""
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    ends = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    lengths = np.diff(ends)
    offsets = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum(lengths + 1, out=offsets[1:])
    out = np.zeros(offsets[-1], dtype=np.uint8)
    if len(texts) and ends[-1] > ends[0]:
        source = np.frombuffer(texts.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]]
        keep = np.ones(offsets[-1], dtype=bool)
        keep[offsets[1:] - 1] = False
        out[keep] = source
    return out, offsets


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut to about BATCH_BYTES of text each; a longer text comes alone and whole."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text)).cast(pa.large_binary()).fill_null(b"")
        ends = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
        begin = 0
        while begin < batch.num_rows:
            end = int(np.searchsorted(ends, ends[begin] + BATCH_BYTES, side="right")) - 1
            end = min(max(end, begin + 1), batch.num_rows)
            yield batch.slice(begin, end - begin)
            begin = end


def shingles(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``size`` words, ascending within each text, and where each text's begin.

    A text of fewer words has its whole sequence as the one shingle; a text without words has none.
    """
    h, first = words.hash, words.first
    n = np.diff(first)
    count = np.where(n >= size, n - size + 1, (n > 0).astype(np.int64))
    begin = np.concatenate(([0], np.cumsum(count)))
    doc = np.repeat(np.arange(len(n)), count)
    at = np.arange(begin[-1]) - begin[doc] + first[doc]
    value = np.full(len(at), 0x51ED270B7F4A7C15, dtype=np.uint64)
    last = first[doc + 1]
    for k in range(size):
        there = at + k < last
        step = h[np.minimum(at + k, max(len(h) - 1, 0))] if len(h) else h
        value = np.where(there, mix(value * np.uint64(0x2545F4914F6CDD1D) + step), value)
    for a, b in zip(begin[:-1].tolist(), begin[1:].tolist()):
        value[a:b].sort()
    fresh = np.ones(len(value), dtype=bool)
    fresh[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
    value, doc = value[fresh], doc[fresh]
    return value, np.searchsorted(doc, np.arange(len(n) + 1))
