"""Benchmark decontamination: passages within an edit distance of a benchmark item.

Texts are sequences of lower-case words of letters and digits. A CGK embedding walks a word
sequence with one random bit per step and word: it writes the word it stands on, and moves on if the
bit is set. Sequences that differ by few edits fall in step again, so edit distance turns into
Hamming distance, and a few sampled positions of the embedding agree with fair probability.

* Every word of every document starts an item-sized window, and every word of an item starts one of its
  own windows, so that an edit near one start leaves the others. One walk serves items of all lengths, because the
  samples lie in its first `REACH` steps: a walk over a whole item at every word would cost hundreds of steps a word.
* A repetition draws its bits and its sampled steps anew. Its key is looked up sample by sample: windows whose first
  samples belong to no item are left at once.
* Repetitions are added until edited copies of the items are found with the target recall, which is measured.
* Items that a walk cannot tell, of fewer than `SHORT` different words, and all items should `MOST_REPEATS` repetitions not reach
  the target, are sought exactly: of a run that differs by k edits, one of the item's k + 1 pieces is unedited.
* Each candidate is verified by the exact edit distance between the whole item and the best run of words
  around it; it is a hit when the distance is at most `floor(rate * words)`.

Items without words have no hits, and neither have documents without words. Repeated items with one id and text count
once. The documents are never shuffled or joined; benchmark items are taken in blocks of bounded size, with one pass over
the documents each.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.words import PLAIN_TABLE, find_words, mix, slices, window_hashes

RATE = 0.2
SHORT = 8
# Samples of a walk within its first steps, the first step always among them, and how many words among the samples make a
# key telling: a walk that hardly moves writes one common word again and again, and its window is left to other repetitions.
SAMPLES, REACH = 6, 24
TELLING = 4
TARGET_RECALL = 0.995
MOST_REPEATS = 48
# One pass over the documents holds so many items, of so many bytes.
BLOCK_ITEMS, BLOCK_BYTES = 20_000, 1 << 26
# A filter has so many bits, or more: about thirty for every key.
FILTER_BITS = 20
HIT_TYPE = "array<struct<item_id: bigint, distance: int, n_words: int, first_word: int, end_word: int>>"


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    words = find_words(pc.utf8_lower(pa.array(texts, pa.large_string())), PLAIN_TABLE)
    return [words.hash[words.of(i)] for i in range(len(texts))]


def step_bits(hashes: np.ndarray, repeat: int) -> np.ndarray:
    """Bit j of a word's number decides whether a walk that stands on it at step j moves on."""
    return mix(hashes ^ np.uint64((repeat + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))


def sampled_steps(repeat: int) -> list[int]:
    """The steps whose words a repetition compares."""
    return [0, *sorted(random.Random(repeat).sample(range(1, REACH), SAMPLES - 1))]


def lookup_filter(keys: np.ndarray) -> np.ndarray:
    """A bit table that says no to most keys that are not among `keys`."""
    bits = max(FILTER_BITS, int(32 * max(len(keys), 1)).bit_length())
    table = np.zeros(1 << bits, bool)
    table[(keys >> np.uint64(64 - bits)).astype(np.int64)] = True
    return table


def may_hold(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return table[(keys >> np.uint64(65 - len(table).bit_length())).astype(np.int64)]


def walk(
    hashes: np.ndarray, bits: np.ndarray, at: np.ndarray, steps: list[int], filters: list[np.ndarray] | None
) -> tuple[list[np.ndarray], np.ndarray]:
    """Keys of the walks from `at` after each sample, and their starts; with `filters`, of the walks that pass them all.

    Walks that leave the sequence are dropped.
    """
    start, key, keys = at, np.zeros(len(at), np.uint64), []
    for step in range(steps[-1] + 1):
        if step in steps:
            key = mix(key * np.uint64(31) + hashes[at])
            if filters is not None:
                kept = may_hold(filters[len(keys)], key)
                start, at, key = start[kept], at[kept], key[kept]
            keys.append(key)
        if step < steps[-1]:
            at = at + ((bits[at] >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
            inside = at < len(hashes)
            if not inside.all():
                start, at, key = start[inside], at[inside], key[inside]
                keys = [k[inside] for k in keys] if filters is None else keys
    return keys, start


@dataclass
class Repeat:
    """One repetition: sampled steps, filters per sample, and the items' keys in order with their item and start."""

    steps: list[int]
    filters: list[np.ndarray]
    keys: np.ndarray
    item: np.ndarray
    offset: np.ndarray


@dataclass
class Index:
    ids: list[int]
    words: list[np.ndarray]
    repeats: list[Repeat] = field(default_factory=list)
    # Per width of a piece: hashes of such pieces in order, with their item and first word.
    pieces: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = field(default_factory=list)
    # Share of edited copies that the walks alone find.
    recall: float = 1.0


def build_index(items: list[tuple[int, str]], rate: float = RATE, target: float = TARGET_RECALL) -> Index:
    index = Index([i for i, _ in items], word_hashes([t for _, t in items]))
    longer = [i for i, w in enumerate(index.words) if _walkable(w)]
    trials = _edited_copies(index, longer, rate)
    missed = trials
    while longer and len(missed) > (1 - target) * len(trials):
        if len(index.repeats) == MOST_REPEATS:
            break
        repeat = _repeat(index, longer, len(index.repeats))
        index.repeats.append(repeat)
        missed = [(i, copy) for i, copy in missed if not _finds(repeat, len(index.repeats) - 1, i, copy)]
    index.recall = 1 - len(missed) / len(trials) if trials else 1.0
    sure = set(longer) if index.recall >= target else set()
    index.pieces = _pieces(index, [i for i, w in enumerate(index.words) if len(w) and i not in sure], rate)
    return index


def _pieces(index: Index, chosen: list[int], rate: float) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """The items cut into one piece more than they may have edits: at least one of them stands unedited in any hit."""
    by_width: dict[int, list[tuple[int, int, int]]] = {}
    for i in chosen:
        words = index.words[i]
        count = int(rate * len(words)) + 1
        borders = [len(words) * p // count for p in range(count + 1)]
        for a, b in zip(borders, borders[1:]):
            by_width.setdefault(b - a, []).append((int(window_hashes(words[a:b], b - a)[0]), i, a))
    out = []
    for width, rows in sorted(by_width.items()):
        rows.sort()
        hashes, item, offset = zip(*rows)
        out.append((width, np.array(hashes, np.uint64), np.array(item), np.array(offset)))
    return out


def _walkable(words: np.ndarray) -> bool:
    return len(np.unique(words)) >= SHORT


def _repeat(index: Index, chosen: list[int], number: int) -> Repeat:
    steps = sampled_steps(number)
    levels: list[list[np.ndarray]] = [[] for _ in steps]
    item, offset = [], []
    for i in chosen:
        words = index.words[i]
        bits = step_bits(words, number)
        keys, start = walk(words, bits, np.arange(len(words)), steps, None)
        telling = _sampled_words(words, bits, start, steps) >= TELLING
        for level, part in zip(levels, keys):
            level.append(part[telling])
        item.append(np.full(int(telling.sum()), i))
        offset.append(start[telling])
    flat = [np.concatenate(level) for level in levels]
    order = np.argsort(flat[-1], kind="stable")
    filters = [lookup_filter(level) for level in flat]
    return Repeat(steps, filters, flat[-1][order], np.concatenate(item)[order], np.concatenate(offset)[order])


def _sampled_words(words: np.ndarray, bits: np.ndarray, start: np.ndarray, steps: list[int]) -> np.ndarray:
    """How many different words each walk writes at the sampled steps."""
    at, seen = start, []
    for step in range(steps[-1] + 1):
        if step in steps:
            seen.append(words[at])
        if step < steps[-1]:
            at = at + ((bits[at] >> np.uint64(step)) & np.uint64(1)).astype(np.int64)
    ordered = np.sort(np.stack(seen), axis=0)
    return 1 + (ordered[1:] != ordered[:-1]).sum(axis=0)


def _edited_copies(index: Index, chosen: list[int], rate: float, most: int = 64) -> list[tuple[int, np.ndarray]]:
    """Copies of evenly chosen items at the largest distance that still counts: edits spread evenly, and at random."""
    copies = []
    for i in chosen[:: max(1, len(chosen) // most)]:
        rng = random.Random(i)
        n = len(index.words[i])
        edits = int(rate * n)
        for trial in range(6):
            places = [(2 * e + 1) * n // (2 * edits) for e in range(edits)] if trial == 0 else rng.sample(range(n), edits)
            copy: list[int] = []
            for at, word in enumerate(index.words[i].tolist()):
                kind = rng.choice(["replace", "insert", "delete"]) if trial > 1 else "replace"
                if at not in places:
                    copy.append(word)
                elif kind == "insert":
                    copy += [rng.getrandbits(64), word]
                elif kind == "replace":
                    copy.append(rng.getrandbits(64))
            copies.append((i, np.array(copy, np.uint64)))
    return copies


def _finds(repeat: Repeat, number: int, item: int, copy: np.ndarray) -> bool:
    keys, _ = walk(copy, step_bits(copy, number), np.arange(len(copy)), repeat.steps, repeat.filters)
    low = np.searchsorted(repeat.keys, keys[-1], "left")
    high = np.searchsorted(repeat.keys, keys[-1], "right")
    return any(item in repeat.item[a:b] for a, b in zip(low, high))


def candidates(index: Index, hashes: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Distinct (row, item, first word) at which an item may begin; the last counts from the row's first word."""
    first = np.searchsorted(row, np.arange(row[-1] + 2)) if len(row) else np.zeros(1, np.int64)
    found = []
    for number, repeat in enumerate(index.repeats):
        bits = step_bits(hashes, number)
        keys, start = walk(hashes, bits, np.arange(len(hashes)), repeat.steps, repeat.filters)
        found.append(_looked_up(keys[-1], start, repeat.keys, repeat.item, repeat.offset, row, first))
    for width, keys, item, offset in index.pieces:
        windows = window_hashes(hashes, width)
        start = np.flatnonzero(np.isin(windows, keys))
        found.append(_looked_up(windows[start], start, keys, item, offset, row, first))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), np.int64)


def _looked_up(key, start, keys, item, offset, row, first) -> np.ndarray:
    low, high = np.searchsorted(keys, key, "left"), np.searchsorted(keys, key, "right")
    counts = high - low
    entry = np.repeat(low, counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    begin = np.repeat(start, counts)
    # A walk may have begun in one text and the item in another; verification sees the row's own words only.
    rows = row[begin]
    return np.stack([rows, item[entry], begin - offset[entry] - first[rows]], 1).astype(np.int64)


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(distance, end) of the run of `text` that is nearest to `item`; the first one of several."""
    columns = np.arange(len(text) + 1)
    above = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item, 1):
        line = np.empty_like(above)
        line[0] = i
        line[1:] = np.minimum(above[1:] + 1, above[:-1] + (text != word))
        above = np.minimum.accumulate(line - columns) + columns
    end = int(above.argmin())
    return int(above[end]), end


def hits(index: Index, texts: pa.Array, rate: float = RATE) -> list[list[dict]]:
    """The hits of every text, by item and place; hits of one item do not overlap, nearer ones go first."""
    words = find_words(pc.utf8_lower(texts.cast(pa.large_string())), PLAIN_TABLE)
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    verified: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    listed = [w.tolist() for w in index.words]
    for row, item, begin in candidates(index, words.hash, words.row).tolist():
        wanted, own = index.words[item], words.hash[words.of(row)]
        most = int(rate * len(wanted))
        low = max(0, begin - most)
        region = own[low : max(0, begin + len(wanted) + most)]
        # Fewer words in common than the distance allows: no alignment can be near.
        if len(region) < len(wanted) - most or sum(map(set(region.tolist()).__contains__, listed[item])) < len(wanted) - most:
            continue
        distance, end = best_match(wanted, region)
        if distance <= most:
            _, length = best_match(wanted[::-1], region[:end][::-1])
            verified.setdefault((row, item), []).append((distance, low + end - length, low + end))
    for (row, item), found in sorted(verified.items()):
        taken: list[tuple[int, int, int]] = []
        for hit in sorted(set(found)):
            if all(hit[2] <= t[1] or hit[1] >= t[2] for t in taken):
                taken.append(hit)
        out[row] += [
            {"item_id": index.ids[item], "distance": d, "n_words": len(index.words[item]), "first_word": s, "end_word": e}
            for d, s, e in sorted(taken, key=lambda t: t[1])
        ]
    return out


def item_blocks(items: DataFrame, item_id: str = "item_id", text: str = "text") -> Iterator[list[tuple[int, str]]]:
    """Distinct (id, text) of the items that have a text, in blocks of bounded size."""
    slim = items.select(items[item_id].cast("long").alias("id"), items[text].alias("text")).where("text is not null").distinct()
    size = slim.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    blocks = max(-(-size["n"] // (BLOCK_ITEMS // 2)), -(-size["bytes"] // (BLOCK_BYTES // 2)), 1)
    for block in range(blocks):
        # Hashed blocks of half the bound on average; a block past the bound would be an error, not a cut.
        rows = slim.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == block).orderBy("id", "text").limit(BLOCK_ITEMS + 1).collect()
        if len(rows) > BLOCK_ITEMS:
            raise ValueError("a block of items is larger than its bound")
        yield [(r["id"], r["text"]) for r in rows]


def _with_hits(docs: DataFrame, index: Index, text: str, name: str, rate: float) -> DataFrame:
    hit_type = pa.list_(pa.struct([("item_id", pa.int64()), *[(n, pa.int32()) for n in ("distance", "n_words", "first_word", "end_word")]]))

    def find(texts: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays([texts], ["text"])
        return pa.array([h for part in slices(batch, 0) for h in hits(index, part.column(0), rate)], hit_type)

    # Not to be evaluated twice: once for a filter above it and once for its value.
    udf = F.arrow_udf(find, HIT_TYPE).asNondeterministic()
    return docs.withColumn(name, udf(docs[text]))


def contaminations(docs: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id", rate: float = RATE) -> DataFrame:
    """One row per document and passage near an item: `doc_id`, `item_id`, `distance`, `n_words`, `first_word`, `end_word`."""
    slim = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    found = [_with_hits(slim, build_index(block, rate), "text", "hits", rate) for block in item_blocks(items)]
    return reduce(DataFrame.unionAll, [f.select("doc_id", F.inline("hits")) for f in found])


def decontaminate(docs: DataFrame, items: DataFrame, text: str = "text", rate: float = RATE) -> DataFrame:
    """The rows of `docs` without a passage near any item; all columns stay as they are."""
    clean, name = docs, "_hits"
    while name in docs.columns:
        name = f"_{name}"
    for block in item_blocks(items):
        clean = _with_hits(clean, build_index(block, rate), text, name, rate).where(F.size(name) == 0).drop(name)
    return clean
