"""Word positions and word hashes of a column of texts, by whole-array arithmetic.

A word's hash is a polynomial of its bytes modulo 2^64, taken from one running sum over all
bytes, then mixed with its length. Hashes of word windows are built the same way from word hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Odd multipliers, and the finalizer constants of SplitMix64.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD6E8FEB86659FD93
MIX_1, MIX_2 = 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

# White space of `[^\\x20\\x09-\\x0D]+` words.
BLANKS = [0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]
# Bytes that are hashed in one running sum, unless a single word is longer.
HASH_BLOCK = 1 << 18
# Bytes of text that a task holds as words at a time, unless a single text is longer.
SLICE_BYTES = 1 << 22


def separators(codes: list[int]) -> np.ndarray:
    table = np.zeros(256, bool)
    table[codes] = True
    return table


BLANK_TABLE = separators(BLANKS)
# Every byte with A to Z in lower case.
LOWER = np.array([c | 32 if 65 <= c <= 90 else c for c in range(256)], np.uint8)
# Everything in ASCII but letters and digits separates normalised words.
PLAIN_TABLE = separators([c for c in range(128) if not chr(c).isalnum()])


def mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(MIX_1)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(MIX_2)
    return values ^ (values >> np.uint64(31))


class _Powers:
    """Powers of an odd base and of its inverse modulo 2^64, extended on demand."""

    def __init__(self, base: int):
        self.base, self.inverse_base = base, pow(base, -1, 1 << 64)
        self.direct = self.inverse = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.direct) < n:
            size = 1 << (n - 1).bit_length()
            self.direct, self.inverse = _powers(self.base, size), _powers(self.inverse_base, size)
        return self.direct, self.inverse


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_BYTES, _WORDS = _Powers(BYTE_BASE), _Powers(WORD_BASE)


@dataclass
class Words:
    """Words of several texts in order: byte borders in `data`, the row of each, and its hash."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    hash: np.ndarray
    # Words of row i are first[i] to first[i + 1].
    first: np.ndarray

    def of(self, row: int) -> slice:
        return slice(self.first[row], self.first[row + 1])

    def text(self, row: int, keep: np.ndarray | None = None) -> bytes:
        """The row's words, or those of `keep`, joined by one space."""
        part = self.of(row)
        start, end = self.start[part], self.end[part]
        if keep is not None:
            start, end = start[keep], end[keep]
        data = self.data
        return b" ".join([data[s:e].tobytes() for s, e in zip(start.tolist(), end.tolist())])


def text_buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a string column; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    low, high = int(offsets[0]), int(offsets[-1])
    return offsets - low, data[low:high]


def slices(batch: pa.RecordBatch, text_column: int) -> Iterator[pa.RecordBatch]:
    """Rows of a batch in runs of about `SLICE_BYTES` of text."""
    if not batch.num_rows:
        return
    offsets, _ = text_buffers(batch.column(text_column))
    begin = 0
    while begin < batch.num_rows:
        end = int(np.searchsorted(offsets, offsets[begin] + SLICE_BYTES, "right")) - 1
        end = min(max(end, begin + 1), batch.num_rows)
        yield batch.slice(begin, end - begin)
        begin = end


def find_words(texts: pa.Array, table: np.ndarray = BLANK_TABLE, lower: bool = False) -> Words:
    """Maximal runs of bytes that are not separators, A to Z in lower case if asked; no word spans two texts."""
    offsets, data = text_buffers(texts)
    if lower:
        data = LOWER[data]
    n = len(data)
    inside = ~table[data] if n else np.zeros(0, bool)
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    # A text's first byte opens a word even if the text before it ended in one.
    borders = offsets[:-1][offsets[:-1] < n]
    begins[borders] = inside[borders]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    closing = offsets[1:][offsets[1:] > 0] - 1
    ends[closing] = inside[closing]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    first = np.searchsorted(start, offsets)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, start, end, row, _hashed(data, start, end), first)


def _hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        base = int(start[at])
        stop = max(at + 1, int(np.searchsorted(end, base + HASH_BLOCK, "right")))
        s, e = start[at:stop] - base, end[at:stop] - base
        size = int(e[-1])
        direct, inverse = _BYTES.get(max(size, HASH_BLOCK))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum((data[base : base + size].astype(np.uint64) + np.uint64(1)) * direct[:size], out=sums[1:])
        out[at:stop] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
        at = stop
    return mix(out)


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the values from `start` to `end`, exclusive; neither may fall from one span to the next."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        base = int(start[at])
        stop = max(at + 1, int(np.searchsorted(end, base + HASH_BLOCK, "right")))
        s, e = start[at:stop] - base, end[at:stop] - base
        size = int(e[-1])
        direct, inverse = _WORDS.get(max(size, HASH_BLOCK))
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(values[base : base + size] * direct[:size], out=sums[1:])
        out[at:stop] = (sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64)
        at = stop
    return mix(out)


def window_hashes(values: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of `width` values; one for each value that begins a whole run."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    block = max(HASH_BLOCK, width)
    for at in range(0, n, block):
        part = values[at : min(n, at + block) + width - 1]
        direct, inverse = _WORDS.get(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * direct[: len(part)], out=sums[1:])
        count = len(part) - width + 1
        out[at : at + count] = (sums[width:] - sums[:-width]) * inverse[:count]
    return mix(out + np.uint64(width))
