"""Distinct words as arrays: a row holds thousands of words, their symbols one after the other, and is worked on as a whole.

A symbol is a number: a character its code point, a merged string `CODE_POINTS` and more, in the order of its merge.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.codepoints import CODE_POINTS, code_points, spread, text_slices

PACKED_TYPE = "symbols binary, lengths binary, counts binary"
# Words of a row; distinct pairs or bytes of distinct runs that a task adds up before it hands them on.
WORDS_PER_ROW = 20_000
PAIRS_HELD = 2_000_000
RUN_BYTES_HELD = 64 << 20

# Symbols of all words, one after the other, the length of every word, and its count.
Words = tuple[np.ndarray, np.ndarray, np.ndarray]


class Symbols:
    """Numbers of the symbols known so far."""

    def __init__(self) -> None:
        self.merged: list[str] = []
        self.numbers: dict[str, int] = {}

    def add(self, symbol: str) -> int:
        if symbol not in self.numbers:
            self.numbers[symbol] = CODE_POINTS + len(self.merged)
            self.merged.append(symbol)
        return self.numbers[symbol]

    def number(self, symbol: str) -> int:
        return ord(symbol) if len(symbol) == 1 else self.numbers[symbol]

    def key(self, left: str, right: str) -> int:
        return self.number(left) << 32 | self.number(right)

    def text(self, number: int) -> str:
        return chr(number) if number < CODE_POINTS else self.merged[number - CODE_POINTS]


def pack(words: Words) -> pa.RecordBatch:
    """One row of packed words."""
    columns = [np.ascontiguousarray(a, kind).tobytes() for a, kind in zip(words, (np.int32, np.int32, np.int64))]
    return pa.RecordBatch.from_arrays([pa.array([c], pa.binary()) for c in columns], ["symbols", "lengths", "counts"])


def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[Words]:
    for batch in batches:
        for row in range(batch.num_rows):
            symbols, lengths, counts = (column[row].as_buffer() for column in batch.columns)
            yield np.frombuffer(symbols, np.int32), np.frombuffer(lengths, np.int32), np.frombuffer(counts, np.int64)


def taken(words: Words, chosen: np.ndarray) -> Words:
    """The chosen words."""
    symbols, lengths, counts = words
    return symbols[np.repeat(chosen, lengths)], lengths[chosen], counts[chosen]


def pair_keys(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the adjacent pairs by the place of the left symbol, and whether both are of one word."""
    symbols, lengths, _ = words
    keys = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
    inside = np.ones(len(symbols), bool)
    inside[np.cumsum(lengths) - 1] = False
    return keys, inside[:-1]


class PairTable:
    """A value of every listed pair."""

    def __init__(self, keys: list[int], values: list[int], size: int):
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(values, np.int64)[order]
        self.left, self.right = np.zeros(CODE_POINTS + size, bool), np.zeros(CODE_POINTS + size, bool)
        self.left[self.keys >> 32] = True
        self.right[self.keys & 0xFFFFFFFF] = True

    def places(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Places of listed pairs and their values."""
        if len(words[0]) < 2 or not len(self.keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys, inside = pair_keys(words)
        maybe = np.flatnonzero(inside & self.left[words[0][:-1]] & self.right[words[0][1:]])
        at = np.minimum(np.searchsorted(self.keys, keys[maybe]), len(self.keys) - 1)
        found = self.keys[at] == keys[maybe]
        return maybe[found], self.values[at[found]]


def merged_words(words: Words, table: PairTable, fresh: np.ndarray) -> Words:
    """The words after all merges of `table`, which ranks pairs: in every word the lowest rank first, from left to right.

    `fresh` has the new symbol of every rank. A pass takes one rank of every word that still holds a ranked pair.
    """
    done: list[Words] = []
    while len(words[1]):
        symbols, lengths, counts = words
        places, ranks = table.places(words)
        owners = np.repeat(np.arange(len(lengths)), lengths)[places]
        best = np.full(len(lengths), len(fresh))
        np.minimum.at(best, owners, ranks)
        alive = best < len(fresh)
        done.append(taken(words, ~alive))
        places, owners = places[ranks == best[owners]], owners[ranks == best[owners]]
        # Places that follow one another overlap: every second one of such a streak is merged.
        index = np.arange(len(places))
        opens = np.append(True, np.diff(places) != 1)[: len(places)]
        kept = (index - np.maximum.accumulate(np.where(opens, index, 0))) % 2 == 0
        places, owners = places[kept], owners[kept]
        symbols = symbols.copy()
        symbols[places] = fresh[best[owners]]
        stays = np.repeat(alive, lengths)
        stays[places + 1] = False
        shorter = lengths - np.bincount(owners, minlength=len(lengths))
        words = symbols[stays], shorter[alive].astype(np.int32), counts[alive]
    return tuple(np.concatenate(parts) for parts in zip(*done)) if done else words


def packed_words(words: DataFrame, parts: int) -> DataFrame:
    """Distinct `word` rows with `cnt` as packed words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, WORDS_PER_ROW):
                at = begin
                for texts in text_slices(batch.column(0).slice(begin, WORDS_PER_ROW)):
                    symbols, sizes = code_points(texts)
                    counts = batch.column(1).slice(at, len(texts)).to_numpy()
                    at += len(texts)
                    yield pack(taken((symbols.astype(np.int32), sizes, counts), sizes > 1))

    return words.select("word", F.col("cnt").cast("long").alias("cnt")).repartition(parts, "word").mapInArrow(run, PACKED_TYPE)


def merged_state(state: DataFrame, symbols: Symbols, batch: list[tuple[str, str, int]]) -> DataFrame:
    """The packed words after the merges of `batch`; a word that is one symbol holds no pair any more and goes."""
    fresh = np.array([symbols.add(left + right) for left, right, _ in batch], np.int32)
    keys = [symbols.key(left, right) for left, right, _ in batch]
    size = len(symbols.merged)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PairTable(keys, list(range(len(keys))), size)
        for words in unpack(batches):
            after = merged_words(words, table, fresh)
            yield pack(taken(after, after[1] > 1))

    return state.mapInArrow(run, PACKED_TYPE)


def _summed(keys: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    firsts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
    return keys[firsts], np.add.reduceat(weights[order], firsts) if len(keys) else weights


def packed_pairs(state: DataFrame, symbols: Symbols) -> DataFrame:
    """Weighted count of every adjacent pair; a task adds up its own words first, and symbols are spelled after the shuffle."""
    merged = list(symbols.merged)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def out(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["pair", "cnt"])

        for words in unpack(batches):
            if len(words[0]) < 2:
                continue
            keys, inside = pair_keys(words)
            held.append(_summed(keys[inside], np.repeat(words[2], words[1])[:-1][inside]))
            if sum(len(k) for k, _ in held) > PAIRS_HELD:
                held = [_summed(*map(np.concatenate, zip(*held)))]
                if len(held[0][0]) > PAIRS_HELD // 2:
                    yield out(*held.pop())
        if held:
            yield out(*_summed(*map(np.concatenate, zip(*held))))

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0).to_numpy()
            sides = []
            for numbers in (keys >> 32, keys & 0xFFFFFFFF):
                distinct, which = np.unique(numbers, return_inverse=True)
                spelled = [chr(n) if n < CODE_POINTS else merged[n - CODE_POINTS] for n in distinct.tolist()]
                sides.append(pa.array(spelled, pa.string()).take(pa.array(which)))
            yield pa.RecordBatch.from_arrays([*sides, batch.column(1)], ["left", "right", "cnt"])

    partial = state.mapInArrow(count, "pair long, cnt long")
    return partial.groupBy("pair").agg(F.sum("cnt").alias("cnt")).mapInArrow(spell, "left string, right string, cnt long")


def packed_runs(state: DataFrame, symbols: Symbols, live: frozenset[tuple[str, str]], whole: bool) -> DataFrame:
    """Distinct maximal runs of live pairs with their counts, as packed symbols; with `whole`, a word that holds one is a run."""
    keys, size = [symbols.key(*pair) for pair in live], len(symbols.merged)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PairTable(keys, [0] * len(keys), size)
        held: list[tuple[pa.Array, np.ndarray]] = []
        for words in unpack(batches):
            runs, counts = _runs(words, table, whole)
            if len(counts):
                held.append(_summed_runs(runs, counts))
            if sum(r.nbytes for r, _ in held) > RUN_BYTES_HELD:
                yield _run_batch(held)
                held = []
        if held:
            yield _run_batch(held)

    return state.mapInArrow(cut, "run binary, cnt long").groupBy("run").agg(F.sum("cnt").alias("cnt"))


def _runs(words: Words, table: PairTable, whole: bool) -> tuple[pa.Array, np.ndarray]:
    symbols, lengths, counts = words
    places, _ = table.places(words)
    owners = np.repeat(np.arange(len(lengths)), lengths)[places]
    if whole:
        owners = np.unique(owners)
        firsts, sizes = (np.cumsum(lengths) - lengths)[owners], lengths[owners]
    else:
        # Places that follow one another are of one word.
        opens = np.flatnonzero(np.append(True, np.diff(places) != 1)[: len(places)])
        firsts, sizes, owners = places[opens], np.diff(np.append(opens, len(places))) + 1, owners[opens]
    flat = symbols[spread(firsts, sizes)]
    ends = np.append(0, np.cumsum(sizes) * 4).astype(np.int64)
    return pa.Array.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(flat)]), counts[owners]


def _summed_runs(runs: pa.Array, counts: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    found = runs.dictionary_encode()
    _, sums = _summed(found.indices.to_numpy(), counts)
    return found.dictionary, sums


def _run_batch(held: list[tuple[pa.Array, np.ndarray]]) -> pa.RecordBatch:
    runs, counts = _summed_runs(pa.concat_arrays([r for r, _ in held]), np.concatenate([c for _, c in held]))
    return pa.RecordBatch.from_arrays([runs.cast(pa.binary()), pa.array(counts)], ["run", "cnt"])


def spelled_run(run: bytes, symbols: Symbols) -> list[str]:
    return [symbols.text(n) for n in np.frombuffer(run, np.int32).tolist()]
