"""Compatibility composition (NFKC) by Arrow batch, with the place in the source that every character comes from.

A text is cut where a code point can neither join the one before it nor be reordered with it. What
lies between two cuts is normalized on its own, so only runs that are not inert are looked at: each
distinct one is replaced once a batch, by table, and everything else is copied by array.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tokenloom.functions.codepoints import CODE_POINTS, code_points, spread, text_slices

FORM = "NFKC"
# Vowels and trailing consonants of Hangul, which join the syllable before them.
HANGUL_JOINING = [*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)]
SURROGATES = range(0xD800, 0xE000)

COMPOSED_TYPE = "struct<text:string,starts:array<int>>"


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: whether a text may be cut before it, and whether it stays as it is between two cuts."""
    cuts, inert = np.ones(CODE_POINTS, bool), np.ones(CODE_POINTS, bool)
    joining = set(HANGUL_JOINING)
    for point in range(CODE_POINTS):
        parts = unicodedata.decomposition(chr(point)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            joining.add(int(parts[1], 16))
    for point in range(CODE_POINTS):
        if point in SURROGATES:
            continue
        character = chr(point)
        first = unicodedata.normalize("NFKD", character)[0]
        cuts[point] = not unicodedata.combining(first) and ord(first) not in joining
        inert[point] = unicodedata.normalize(FORM, character) == character
    return cuts, inert


def composed(texts: pa.Array) -> pa.StructArray:
    """Normalized texts, and for each of their characters the first source character of the run that it comes from."""
    cuts, inert = tables()
    points, sizes = code_points(texts)
    text_ends = np.cumsum(sizes)
    begins = cuts[points]
    begins[(text_ends - sizes)[sizes > 0]] = True
    starts = np.flatnonzero(begins)
    lengths = np.diff(np.append(starts, len(points)))
    changed = np.flatnonzero((lengths > 1) | ~inert[points[starts]])
    # A run of several characters may still be its own normal form.
    known: dict[str, str] = {}
    whole = points.tobytes().decode("utf-32-le")
    fresh = []
    for run in changed.tolist():
        source = whole[starts[run] : starts[run] + lengths[run]]
        if source not in known:
            known[source] = unicodedata.normalize(FORM, source)
        fresh.append(known[source])
    out_lengths = lengths.copy()
    out_lengths[changed] = [len(f) for f in fresh]
    out = np.empty(out_lengths.sum(), "<u4")
    out_starts = np.cumsum(out_lengths) - out_lengths
    kept = np.ones(len(starts), bool)
    kept[changed] = False
    out[out_starts[kept]] = points[starts[kept]]
    filled = np.frombuffer("".join(fresh).encode("utf-32-le"), "<u4")
    out[spread(out_starts[changed], out_lengths[changed])] = filled
    # Characters of all texts before each text, in the output and in the source.
    out_ends = np.append(out_starts, len(out))[np.searchsorted(starts, text_ends)]
    places = np.repeat(starts, out_lengths) - np.repeat(text_ends - sizes, np.diff(out_ends, prepend=0))
    decoded = out.tobytes().decode("utf-32-le")
    borders = np.append(0, out_ends)
    strings = pa.array([decoded[a:b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())], pa.string())
    lists = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(places, pa.int32()))
    return pa.StructArray.from_arrays([strings, lists], ["text", "starts"])


def compose_with_places(text: Column) -> Column:
    """`text` in normal form and `starts`, the source place of each of its characters; null is the empty text."""

    @F.arrow_udf(COMPOSED_TYPE)
    def compose(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [composed(part) for part in text_slices(texts)]
            empty = pa.array([], pa.struct([("text", pa.string()), ("starts", pa.list_(pa.int32()))]))
            yield pa.concat_arrays(parts) if parts else empty

    return compose(text)


def nfkc(text: Column) -> Column:
    """Compatibility composition of a text, which Spark has no function for."""
    return compose_with_places(text)["text"]
