"""Byte-pair merge learning in rounds: Spark reduces the words to the runs that a round can merge, few enough to replay.

A round counts all adjacent pairs and takes the leading ones as live. Merging (a, b) takes away an
occurrence of the pair before and after it for each one that it adds, so until the best count falls
below that of the live pairs, nothing can happen outside the maximal runs of live pairs. Equal runs
of all words are one row with their summed count. Those rows, at most `MOST_RUNS` of them, are merged
one pair at a time; what was learned is then applied to the words, which stay distributed, packed into arrays.

No pair gains but through a new symbol: a string becomes a symbol by one merge only. Wherever it
ends up as one symbol, no earlier merge crossed its borders, so its inside was merged alike everywhere.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.operators.packedwords import Symbols, merged_state, packed_pairs, packed_runs, packed_words, spelled_run
from tokenloom.operators.vocab import LEARNED_BASE, Subwords, char_coverage, word_counts
from tokenloom.session import cut_lineage

# Parts the symbols of a run. Words hold no white space, so it is free.
SEP = "\x1f"
# Stands for characters outside the alphabet, where a word is cut.
OUTSIDE = "\x1e"
# Live pairs of the first round, and of any round.
FIRST_PAIRS = 512
MOST_PAIRS = 32_768
# Most runs of a round, and most symbols of them: beyond, the round takes fewer live pairs.
MOST_RUNS = 100_000
MOST_SYMBOLS = 4_000_000
WORDS_PER_PARTITION = 100_000

Pair = tuple[str, str]
# (left, right, count)
Merge = tuple[str, str, int]


def symbol_state(words: DataFrame) -> DataFrame:
    """Distinct words as arrays of symbols, with their counts."""
    return words.select(T.characters(F.col("word")).alias("parts"), F.col("cnt").cast("long").alias("cnt"))


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], int]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def pair_counts(state: DataFrame) -> DataFrame:
    """Weighted count of every adjacent symbol pair; a task adds up its own words first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[Pair, int] = defaultdict(int)
        for parts, weight in _rows(batches):
            for pair in zip(parts, parts[1:]):
                counts[pair] += weight
        lefts, rights = [p[0] for p in counts], [p[1] for p in counts]
        yield pa.RecordBatch.from_arrays(
            [pa.array(lefts, pa.string()), pa.array(rights, pa.string()), pa.array(counts.values(), pa.int64())], ["left", "right", "cnt"]
        )

    partial = state.mapInArrow(count, "left string, right string, cnt long")
    return partial.groupBy("left", "right").agg(F.sum("cnt").alias("cnt"))


def joined(parts: list[str], left: str, right: str) -> list[str]:
    """`parts` with every (left, right) made one symbol, from left to right."""
    out, i, last = [], 0, len(parts) - 1
    while i <= last:
        if i < last and parts[i] == left and parts[i + 1] == right:
            out.append(left + right)
            i += 2
        else:
            out.append(parts[i])
            i += 1
    return out


def merged_in_order(parts: list[str], ranks: dict[Pair, int]) -> list[str]:
    """`parts` after all merges of a round in the order of their ranks."""
    while True:
        pair = min((p for p in zip(parts, parts[1:]) if p in ranks), key=ranks.get, default=None)
        if pair is None:
            return parts
        parts = joined(parts, *pair)


def live_runs(parts: list[str], live: frozenset[Pair], whole: bool) -> list[list[str]]:
    """Maximal runs of live pairs; with `whole`, a word that holds one is a run."""
    alive = [pair in live for pair in zip(parts, parts[1:])]
    if whole:
        return [parts] if any(alive) else []
    runs, begin = [], None
    for i, on in enumerate([*alive, False]):
        if on and begin is None:
            begin = i
        elif not on and begin is not None:
            runs.append(parts[begin : i + 1])
            begin = None
    return runs


class Replay:
    """One-at-a-time merging of the runs of a round; `later` pairs are only partly counted and come after all live ones."""

    def __init__(self, runs: list[tuple[str, int]], live: frozenset[Pair], whole: bool):
        self.parts = [run.split(SEP) for run, _ in runs]
        self.weights = [weight for _, weight in runs]
        self.counts: dict[Pair, int] = defaultdict(int)
        self.places: dict[Pair, set[int]] = defaultdict(set)
        for i, parts in enumerate(self.parts):
            for pair in zip(parts, parts[1:]):
                self.counts[pair] += self.weights[i]
                self.places[pair].add(i)
        self.later = {pair for pair in self.counts if pair not in live} if whole else set()
        self.heap = [(-count, *pair) for pair, count in self.counts.items()]
        heapify(self.heap)

    def best(self) -> Merge | None:
        """The leading pair; counts that fell since they were stored are put right on the way."""
        while self.heap:
            stored, left, right = self.heap[0]
            count = self.counts[left, right]
            if count == -stored and (left, right) not in self.later:
                return left, right, count
            heappop(self.heap)
            if 0 < count < -stored:
                heappush(self.heap, (-count, left, right))
        return None

    def merge(self, left: str, right: str) -> None:
        gained = set()
        for i in self.places.pop((left, right)):
            old, weight = self.parts[i], self.weights[i]
            new = self.parts[i] = joined(old, left, right)
            for pair in zip(old, old[1:]):
                self.counts[pair] -= weight
            for pair in zip(new, new[1:]):
                self.counts[pair] += weight
                self.places[pair].add(i)
                gained.add(pair)
        for pair in gained:
            heappush(self.heap, (-self.counts[pair], *pair))

    def learn(self, wanted: int, floor: int, last: Pair | None) -> list[Merge]:
        """Merges with a count of `floor` or more; at `floor` itself only pairs up to `last`, if there is one."""
        learned: list[Merge] = []
        while len(learned) < wanted:
            top = self.best()
            if top is None or top[2] < floor or (last and top[2] == floor and top[:2] > last):
                break
            self.merge(*top[:2])
            learned.append(top)
        return learned


def learn_round(state: DataFrame, symbols: Symbols, top: list[Merge], complete: bool, wanted: int) -> tuple[list[Merge], int, int]:
    """The next merges, the number of live pairs that they were found with, and that of their runs.

    `top` are the leading pairs in order, all there are if `complete`.
    """
    pairs = len(top) if complete else len(top) - 1
    while True:
        # A count that some pair left out has as well is not listed in full, so it is not live.
        floor = 1 if complete and pairs == len(top) else top[pairs][2] + 1
        listed = [m for m in top[:pairs] if m[2] >= floor]
        last = None
        if not listed:
            # All leading pairs are equally frequent: the first of them are live, and words are not cut into runs.
            listed, floor, last = top[:pairs], top[0][2], top[pairs - 1][:2]
        live = frozenset((left, right) for left, right, _ in listed)
        runs = cut_lineage(packed_runs(state, symbols, live, last is not None))
        size = runs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("run") / 4).alias("symbols")).first()
        if size["n"] <= MOST_RUNS and size["symbols"] <= MOST_SYMBOLS:
            table = runs.toArrow()
            spelled = [SEP.join(spelled_run(run, symbols)) for run in table["run"].to_pylist()]
            replay = Replay(list(zip(spelled, table["cnt"].to_pylist())), live, last is not None)
            return replay.learn(wanted, floor, last), pairs, size["n"]
        if pairs == 1:
            # The leading pair comes next whatever its runs are.
            return top[:1], pairs, size["n"]
        pairs = max(1, pairs // 4)


def learn_merges(words: DataFrame, merges: int) -> list[Merge]:
    """The first `merges` merges `(left, right, count)` over distinct `word` rows with `cnt`.

    Ties go to the smaller (left, right). The words stay distributed: a round reads them for the pair
    counts, for the live runs, and to apply what it learned. The driver holds the leading pairs and
    the runs of a round, both bounded; the number of live pairs follows from the runs that they leave.
    """
    words = cut_lineage(words.select("word", "cnt"))
    rows = words.count()
    parts = min(rows // WORDS_PER_PARTITION + 1, 4 * int(words.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    state = cut_lineage(packed_words(words, parts))
    symbols = Symbols()
    learned: list[Merge] = []
    pairs = FIRST_PAIRS
    while len(learned) < merges:
        ordered = packed_pairs(state, symbols).orderBy(F.desc("cnt"), "left", "right")
        top = [tuple(r) for r in ordered.limit(pairs + 1).collect()]
        if not top:
            break
        batch, used, runs = learn_round(state, symbols, top, len(top) <= pairs, merges - len(learned))
        learned += batch
        # As many live pairs as the bound on runs leaves room for.
        pairs = min(MOST_PAIRS, max(2 * used, 2) if 2 * runs < MOST_RUNS else used)
        if len(learned) < merges:
            state = cut_lineage(merged_state(state, symbols, batch))
    return learned


def train_subwords(docs: DataFrame, vocab_size: int, coverage: float = 0.9999, **sampling) -> Subwords:
    """Subword model of at most `vocab_size` pieces, specials and bytes included."""
    words = cut_lineage(word_counts(docs, **sampling))
    counts = (
        words.select("cnt", F.explode(T.characters(F.col("word"))).alias("char"))
        .groupBy("char")
        .agg(F.sum("cnt").alias("cnt"))
    )
    ranked = char_coverage(counts, coverage).orderBy("char_rank").collect()
    alphabet = [r["char"] for r in ranked if r["kept"]]
    outside = "".join(r["char"] for r in ranked if not r["kept"])
    wanted = vocab_size - LEARNED_BASE - len(alphabet)
    if wanted < 0:
        raise ValueError(f"vocabulary of {vocab_size} is smaller than its {LEARNED_BASE + len(alphabet)} base pieces")
    if outside:
        cut = F.translate("word", outside, OUTSIDE * len(outside))
        words = (
            words.select(F.explode(F.split(cut, f"{OUTSIDE}+")).alias("word"), "cnt")
            .where(F.col("word") != "")
            .groupBy("word")
            .agg(F.sum("cnt").alias("cnt"))
        )
    learned = learn_merges(words, wanted)
    return Subwords([(a, b) for a, b, _ in learned], alphabet)
