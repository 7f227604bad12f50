"""Substring dedup: seeds at winnowed anchors, extended both ways to maximal repeats.

A window is `WIDTH` consecutive words. Its anchor is the first smallest of its `SEED`-word hashes, so
equal windows have equal anchors at equal places, and consecutive windows around one anchor form a
seed's run: the stretch to which a match at that anchor can be extended to either side.

1. Anchors are counted over the corpus; only runs whose anchor occurs again go on.
2. Runs that are equal as a whole are repeats as a whole, however many copies there are.
3. Runs that share an anchor but differ are extended word by word to both sides: their windows are compared, one row per
   distinct run, window and place. Windows found in two different runs are repeats.
4. Repeated windows of a text overlap into maximal repeats, and the words that they cover are removed.

No pair of occurrences is ever formed: every step counts or joins on a hash, so a passage in a third of all
documents is one pre-aggregated key. Texts are named by a 128-bit hash, so equal texts share one result.

Words are runs of bytes that are not blanks. Null and empty texts have none; texts below `WIDTH` words have no window.
Repeated rows and null or repeated ids are rows like others. Windows are compared by 128 bits of hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.llm.storage import written
from tokenloom.llm.words import find_words, slices, span_hashes, window_hashes

WIDTH = 35
SEED = 8

RUN_TYPE = "anchor long, run long, text_1 long, text_2 long, first int, windows int"
WINDOW_TYPE = "anchor long, run long, copies long, window long, text_1 long, text_2 long, first int"


def text_key(text):
    """Two hashes of a text; null is the empty text."""
    filled = F.coalesce(text, F.lit(""))
    return F.xxhash64(filled).alias("text_1"), F.xxhash64(F.lit(WIDTH), filled, F.lit(SEED)).alias("text_2")


def first_smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest value in every window of `width` values."""
    place = np.arange(len(values))
    span = 1
    while 2 * span <= width:
        left, right = place[:-span], place[span:]
        place = np.where(values[left] <= values[right], left, right)
        span *= 2
    rest = width - span
    if rest:
        left, right = place[:-rest], place[rest:]
        place = np.where(values[left] <= values[right], left, right)
    return place


def runs(words, width: int, seed: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, run hash, row, first window and number of windows of every run of the texts."""
    count = len(words.hash) - width + 1
    if count <= 0:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    grams = window_hashes(words.hash, seed)
    place = first_smallest(grams, width - seed + 1)
    inside = words.row[:count] == words.row[width - 1 :]
    starts = inside.copy()
    starts[1:] &= (place[1:] != place[:-1]) | ~inside[:-1]
    first = np.flatnonzero(starts)
    # A run ends where the next one begins, or where its text ends.
    last_whole = words.first[words.row[first] + 1] - width + 1
    windows = np.minimum(np.append(first[1:], count), last_whole) - first
    row = words.row[first]
    whole = span_hashes(words.hash, first, first + windows + width - 1)
    return grams[place[first]], whole, row, first - words.first[row], windows


def _runs(width: int, seed: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                anchor, run, row, first, windows = runs(find_words(part.column(2)), width, seed)
                names = [part.column(i).take(pa.array(row)) for i in range(2)]
                columns = [
                    pa.array(anchor.view(np.int64)), pa.array(run.view(np.int64)), *names,
                    pa.array(first.astype(np.int32)), pa.array(windows.astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "run", "text_1", "text_2", "first", "windows"])

    return find


def _anchors(width: int, seed: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 0):
                anchor = runs(find_words(part.column(0)), width, seed)[0]
                values, counts = np.unique(anchor, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(counts)], ["anchor", "n"])

    return find


def _windows(width: int):
    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                words = find_words(part.column(2))
                hashes = window_hashes(words.hash, width)
                owner = part.column(3).value_lengths().to_numpy()
                listed = part.column(3).flatten()
                row = np.repeat(np.arange(part.num_rows), owner)
                first, windows = (listed.field(c).to_numpy() for c in ("first", "windows"))
                own = np.repeat(np.arange(len(first)), windows)
                place = first[own] + np.arange(len(own)) - np.repeat(np.cumsum(windows) - windows, windows)
                window = hashes[words.first[row[own]] + place]
                take = pa.array(own)
                columns = [listed.field(c).take(take) for c in ("anchor", "run", "copies")]
                columns += [pa.array(window.view(np.int64)), *(part.column(i).take(pa.array(row[own])) for i in range(2))]
                columns.append(pa.array(place.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "run", "copies", "window", "text_1", "text_2", "first"])

    return extend


def repeated_spans(docs: DataFrame, text: str = "text", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """(`text_1`, `text_2`, `spans`): per distinct text with repeats, its (`first`, `windows`) runs of repeated windows."""
    slim = docs.select(*text_key(docs[text]), docs[text].alias("text"))
    counted = slim.select("text").mapInArrow(_anchors(width, seed), "anchor long, n long")
    # The small sides of joins on hot anchors are written: such a join reads two plain shuffles, whose large
    # partitions Spark splits.
    again = written(counted.groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor"), "anchors")
    found = written(slim.mapInArrow(_runs(width, seed), RUN_TYPE).join(again, "anchor", "left_semi"), "runs")

    copies = written(found.groupBy("anchor", "run").agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct("text_1", "text_2", "first", "windows")).alias("at")), "copies")
    whole = found.join(copies.where("copies > 1").select("anchor", "run"), ["anchor", "run"], "left_semi")
    whole = whole.select("text_1", "text_2", "first", "windows")

    # Only anchors with different runs are extended, one occurrence of each run.
    several = written(copies.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"), "several")
    asked = copies.join(several, "anchor", "left_semi").select("anchor", "run", "copies", "at.*")
    per_text = asked.groupBy("text_1", "text_2").agg(
        F.collect_list(F.struct("first", "windows", "anchor", "run", "copies")).alias("runs")
    )
    # One row of each text that is asked for; equal texts would only repeat it.
    texts = slim.join(per_text.select("text_1", "text_2"), ["text_1", "text_2"], "left_semi").dropDuplicates(["text_1", "text_2"])
    extended = written(
        texts.join(per_text, ["text_1", "text_2"]).select("text_1", "text_2", "text", "runs").mapInArrow(_windows(width), WINDOW_TYPE),
        "windows",
    )
    shared = extended.groupBy("anchor", "window").agg(F.min("run").alias("low"), F.max("run").alias("high"))
    shared = shared.where("low <> high").select("anchor", "window")
    # Runs with copies are repeats already.
    partly = extended.where("copies = 1").join(shared, ["anchor", "window"], "left_semi")
    partly = partly.select("text_1", "text_2", "first", F.lit(1).alias("windows"))
    return whole.unionAll(partly).groupBy("text_1", "text_2").agg(F.collect_set(F.struct("first", "windows")).alias("spans"))


def _covered(words, row: int, spans, width: int) -> np.ndarray:
    """Words of a row that lie in none of its repeated windows."""
    count = int(words.first[row + 1] - words.first[row])
    edges = np.zeros(count + 1, np.int64)
    if spans is not None and len(spans):
        first, windows = (spans.field(c).to_numpy() for c in ("first", "windows"))
        np.add.at(edges, first, 1)
        np.add.at(edges, first + windows + width - 1, -1)
    return np.cumsum(edges)[:-1] == 0


def _kept(batches, width: int, column: int, finish):
    for batch in batches:
        for part in slices(batch, column):
            words, spans = find_words(part.column(column)), part.column(column + 1)
            listed = spans.flatten()
            ends = np.cumsum(spans.value_lengths().fill_null(0).to_numpy())
            rows = []
            for row in range(part.num_rows):
                own = listed.slice(int(ends[row - 1]) if row else 0, int(ends[row] - (ends[row - 1] if row else 0)))
                keep = _covered(words, row, own, width)
                rows.append((keep, words.text(row, keep)))
            yield finish(part, rows)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """One row per document: `doc_id`, `n_words`, `n_removed`, and `kept`, the remaining words joined by one space."""
    spans = repeated_spans(docs, text, width, seed)
    slim = docs.select(docs[doc_id].cast("long").alias("doc_id"), *text_key(docs[text]), docs[text].alias("text"))
    joined = slim.join(spans, ["text_1", "text_2"], "left").select("doc_id", "text", "spans")

    def finish(part, rows):
        kept = pa.array([t.decode() for _, t in rows], pa.string())
        counts = [pa.array([f(k) for k, _ in rows], pa.int64()) for f in (len, lambda k: len(k) - int(k.sum()))]
        return pa.RecordBatch.from_arrays([part.column(0), *counts, kept], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.mapInArrow(lambda b: _kept(b, width, 1, finish), "doc_id long, n_words long, n_removed long, kept string")


def kept_digest(result: DataFrame) -> DataFrame:
    """`remove_repeats` with the digest of the kept words in place of the words."""
    return result.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256)).drop("kept")
