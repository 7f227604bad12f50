"""Whole Arrow batches of texts as arrays of code points, and back: character work without a row or a lambda per character."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CODE_POINTS = 0x110000
# Bytes of text that are code points at a time, unless one text is longer.
SLICE_BYTES = 8 << 20


def text_slices(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in runs of about `SLICE_BYTES`; null is the empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    ends = np.cumsum(pc.binary_length(texts).to_numpy())
    begin = 0
    while begin < len(texts):
        used = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, used + SLICE_BYTES, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


def code_points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other, and how many each text has; null is the empty text."""
    texts = texts.cast(pa.large_string()).fill_null("")
    sizes = pc.utf8_length(texts).to_numpy()
    whole = "".join(texts.to_pylist()).encode("utf-32-le")
    return np.frombuffer(whole, "<u4"), sizes


def spread(firsts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions of runs that begin at `firsts`, one run after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(firsts - (ends - lengths), lengths) + np.arange(lengths.sum())


def id_lists(ids: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), pa.array(ids, pa.int32()))


def encoded_slices(texts: pa.Array, encode: Callable[[np.ndarray, np.ndarray], pa.ListArray]) -> pa.Array:
    """Id lists of a batch by `encode`, which gets the code points of some texts and how many each has."""
    lists = [encode(*code_points(part)) for part in text_slices(texts)]
    return pa.concat_arrays(lists) if lists else pa.array([], pa.list_(pa.int32()))


def table_of(ids: dict[str, int]) -> np.ndarray:
    """Id of every code point, -1 where there is none."""
    table = np.full(CODE_POINTS, -1, np.int32)
    for character, token_id in ids.items():
        table[ord(character)] = token_id
    return table
