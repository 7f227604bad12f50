"""Ranked lexical search: the best documents of every item by integer impacts, pruned by norm buckets.

A document is a vector of impacts, one per item term that it holds, and an item a vector of term
weights; a score is their inner product. The vectors are range-partitioned by falling length and a
task takes its part in buckets of `BUCKET` vectors. By Cauchy and Schwarz no vector of a bucket scores
more than the item's length times the bucket's greatest one, so a bucket below the item's threshold
is left out, and so are the shorter vectors at a bucket's end. Inside, an item's large coordinates give
bounds: a vector whose score reaches the threshold must hold as much of them. What survives is scored
exactly in 64-bit integers. The part of the longest vectors is searched first; its results are the
thresholds of all other parts. A threshold is the score of the `top`-th best vector seen so far, ties stay.

Statistics (documents, terms, document frequencies) are those of all documents. Items are searched in
blocks of `MOST_ITEMS`, whose terms and weights travel to every task; a block reads the documents once.

* Null and empty texts have no terms: such documents do not count and are never found, such items find nothing.
* Rows with one `item_id` (null is one as well) are one item with the terms of all of them. Rows with one
  `doc_id` are documents of their own; equal scores go by `doc_id`, null last.
* Long texts are cut into words in one pass; a document's row holds each item term once.
* Copies and equal lengths are spread over parts, as the order goes on with the id and a hash.
* Empty tables give an empty result; other columns, whatever they are called, are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.llm.storage import written
from tokenloom.llm.words import PLAIN_TABLE, find_words, slices

TOP = 50
# Items of a block, vectors of a bucket, and vectors of a part.
MOST_ITEMS = 10_000
BUCKET = 4_096
ROWS_PER_PART = 32_768
# Fixed values of the score: length normalisation b = 50 %, saturation 1.2, both in integers.
IMPACT_SCALE, SATURATION, HALF = 1_000_000_000, 20, 50
# Bounds are computed in doubles and compared with this much room.
ROOM = 1 + 1e-9

POSTINGS_TYPE = "doc_id long, n long, terms array<int>, tfs array<int>"
VECTORS_TYPE = "doc_id long, norm double, terms array<int>, impacts array<int>"
FOUND_TYPE = "item int, doc_id long, score long"
RESULT_TYPE = "item_id long, rank int, doc_id long, score long"
# Terms of the rows that carry the number of documents and that of all their terms.
DOCUMENTS, LENGTHS = -1, -2


@dataclass
class Items:
    """Items of a block: per item its id and the numbers of its terms, ascending; `hashes` are all terms in order."""

    ids: list[int | None]
    terms: list[np.ndarray]
    hashes: np.ndarray
    # Weight of every term, once the documents are counted.
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))

    def norm(self, item: int) -> float:
        return float(np.sqrt((self.weights[self.terms[item]].astype(float) ** 2).sum()))


def plain_words(texts: pa.Array):
    return find_words(texts, PLAIN_TABLE, lower=True)


def item_blocks(items: DataFrame, text: str, item_id: str) -> Iterator[Items]:
    """Blocks of at most `MOST_ITEMS` items in the order of their ids; a block is read by its range of ids."""
    slim = items.select(items[item_id].cast("long").alias("item_id"), items[text].cast("string").alias("text"))
    distinct = slim.select("item_id").distinct()
    after = None
    nulls = slim.where(F.col("item_id").isNull())
    if not nulls.isEmpty():
        yield _item_block(nulls)
    while True:
        rest = distinct.where(F.col("item_id").isNotNull() if after is None else F.col("item_id") > after)
        ids = rest.orderBy("item_id").limit(MOST_ITEMS).agg(F.min("item_id").alias("low"), F.max("item_id").alias("high")).first()
        if ids["low"] is None:
            return
        yield _item_block(slim.where(F.col("item_id").between(ids["low"], ids["high"])))
        after = ids["high"]


def _item_block(rows: DataFrame) -> Items:
    table = rows.toArrow()
    found = plain_words(table["text"].combine_chunks())
    # Null sorts as the last id.
    keys = table["item_id"].to_pylist()
    ids = sorted(set(keys), key=lambda k: (k is None, k or 0))
    place = {key: i for i, key in enumerate(ids)}
    row_item = np.array([place[k] for k in keys], np.int64)
    hashes, number = np.unique(found.hash, return_inverse=True)
    pairs = np.unique(row_item[found.row] * max(len(hashes), 1) + number) if len(hashes) else np.zeros(0, np.int64)
    terms = np.split(pairs % max(len(hashes), 1), np.searchsorted(pairs, np.arange(1, len(ids)) * max(len(hashes), 1)))
    return Items(ids, terms, hashes)


def postings(docs: DataFrame, hashes: np.ndarray, text: str, doc_id: str) -> DataFrame:
    """Per document with terms: how many it has, and how often it holds each item term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                words = plain_words(part.column(1))
                at = np.minimum(np.searchsorted(hashes, words.hash), len(hashes) - 1)
                hit = hashes[at] == words.hash
                keys, tfs = np.unique(words.row[hit] * len(hashes) + at[hit], return_counts=True)
                ends = np.searchsorted(keys, np.arange(part.num_rows + 1) * len(hashes)).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (keys % len(hashes), tfs)
                ]
                n = np.diff(words.first).astype(np.int64)
                rows = pa.RecordBatch.from_arrays([part.column(0), pa.array(n), *lists], ["doc_id", "n", "terms", "tfs"])
                yield rows.filter(pa.array(n > 0))

    slim = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string").alias("text"))
    return slim.mapInArrow(count, POSTINGS_TYPE)


def corpus_counts(held: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents, terms of all documents, and document frequency of every item term."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows, lengths = np.zeros(terms, np.int64), 0, 0
        for batch in batches:
            df += np.bincount(batch.column(1).flatten().to_numpy(), minlength=terms)
            rows += batch.num_rows
            lengths += pc.sum(batch.column(0)).as_py() or 0
        number = np.concatenate([np.arange(terms), [DOCUMENTS, LENGTHS]]).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(np.append(df, [rows, lengths]))], ["term", "value"])

    sums = held.select("n", "terms").mapInArrow(add, "term int, value long").groupBy("term").agg(F.sum("value").alias("value"))
    df, totals = np.zeros(terms, np.int64), {DOCUMENTS: 0, LENGTHS: 0}
    # One row per term of the block.
    for term, value in sums.collect():
        if term < 0:
            totals[term] = value
        else:
            df[term] = value
    return totals[DOCUMENTS], totals[LENGTHS], df


def term_weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)


def impacts_of(tfs: np.ndarray, lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Impact of a term that occurs `tfs` times in a document of `lengths` terms."""
    longest = int(lengths.max(initial=0))
    kind = np.int64 if HALF * longest * documents < 1 << 63 else object
    m = (100 - HALF + (HALF * lengths.astype(kind) * documents) // max(total, 1)).astype(np.int64)
    return (IMPACT_SCALE * tfs) // (1000 * tfs + SATURATION * m)


def vectors(held: DataFrame, weights: np.ndarray, documents: int, total: int) -> DataFrame:
    """Impact vectors of the documents that hold an item term of some weight, with their lengths."""

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists, n = batch.column(2), batch.column(1).to_numpy()
            sizes = lists.value_lengths().to_numpy()
            terms, tfs = lists.flatten().to_numpy(), batch.column(3).flatten().to_numpy().astype(np.int64)
            rows = np.repeat(np.arange(len(n)), sizes)
            impacts = impacts_of(tfs, n[rows], documents, total)
            live = weights[terms] > 0
            terms, impacts, rows = terms[live], impacts[live], rows[live]
            norm = np.sqrt(np.bincount(rows, weights=impacts.astype(float) ** 2, minlength=len(n)))
            ends = pa.array(np.searchsorted(rows, np.arange(len(n) + 1)).astype(np.int32))
            columns = [pa.ListArray.from_arrays(ends, pa.array(v.astype(np.int32))) for v in (terms, impacts)]
            out = pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(norm), *columns], ["doc_id", "norm", "terms", "impacts"]
            )
            yield out.filter(pa.array(norm > 0))

    return held.mapInArrow(weigh, VECTORS_TYPE)


class Best:
    """The best scores of every item so far, and the thresholds that they give."""

    def __init__(self, items: int, thresholds: np.ndarray, top: int):
        self.scores = [np.zeros(0, np.int64) for _ in range(items)]
        self.docs = [np.zeros(0, np.int64) for _ in range(items)]
        self.thresholds, self.top = thresholds.copy(), top

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        enough = scores >= max(int(self.thresholds[item]), 1)
        if not enough.any():
            return
        scores = np.concatenate([self.scores[item], scores[enough]])
        docs = np.concatenate([self.docs[item], docs[enough]])
        order = np.lexsort((docs, -scores))[: self.top]
        self.scores[item], self.docs[item] = scores[order], docs[order]
        if len(order) == self.top:
            self.thresholds[item] = max(self.thresholds[item], self.scores[item][-1])


# Stands for a null id in arrays; after all others.
NO_ID = np.iinfo(np.int64).max


class Bucket:
    """Vectors of similar length, longest first, with an inverted list per term."""

    def __init__(self, batch: pa.RecordBatch):
        # A task may read the ends of two files, so the order is made sure of here.
        batch = batch.take(pa.array(np.argsort(-batch.column(1).to_numpy(), kind="stable")))
        self.docs = pc.fill_null(batch.column(0), int(NO_ID)).to_numpy()
        self.norms = batch.column(1).to_numpy()
        sizes = batch.column(2).value_lengths().to_numpy()
        terms, rows = batch.column(2).flatten().to_numpy(), np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(terms, kind="stable")
        self.rows = rows[order]
        self.impacts = batch.column(3).flatten().to_numpy()[order].astype(np.int64)
        self.listed, starts = np.unique(terms[order], return_index=True)
        self.starts = np.append(starts, len(order))

    def lists(self, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begin and end of the list of every term; empty for those that no vector holds."""
        at = np.searchsorted(self.listed, terms)
        found = np.append(self.listed, -1)[at] == terms
        begin = np.where(found, self.starts[at], 0)
        return begin, np.where(found, self.starts[np.minimum(at + 1, len(self.starts) - 1)], 0)

    def search(self, item: int, terms: np.ndarray, weights: np.ndarray, norm: float, best: Best) -> None:
        threshold = int(best.thresholds[item])
        # Cauchy-Schwarz: the whole bucket, then the shorter vectors at its end.
        if norm * self.norms[0] * ROOM < threshold:
            return
        live = len(self.norms)
        if threshold:
            live = int(np.searchsorted(-self.norms, -threshold / (norm * ROOM), "right"))
        begin, end = self.lists(terms)
        wanted = self.survivors(terms, weights, norm, threshold, begin, end, live)
        scores = np.zeros(len(self.norms), np.int64)
        for b, e, weight in zip(begin.tolist(), end.tolist(), weights.tolist()):
            if e > b:
                # A vector stands once in a list.
                scores[self.rows[b:e]] += weight * self.impacts[b:e]
        scores[~wanted] = 0
        best.add(item, scores, self.docs)

    def survivors(self, terms, weights, norm: float, threshold: int, begin, end, live: int) -> np.ndarray:
        """Vectors that no coordinate bound rules out.

        With unit vectors q and v and q.v >= t, a coordinate of v is at least t q_f - sqrt((1 - t^2)(1 - q_f^2)).
        """
        wanted = np.zeros(len(self.norms), bool)
        wanted[:live] = True
        share = threshold / (norm * self.norms[0] * ROOM)
        if not 0 < share <= 1:
            return wanted
        q = weights / norm
        least = share * q - np.sqrt((1 - share * share) * np.maximum(1 - q * q, 0))
        for f in np.flatnonzero(least > 0):
            rows = self.rows[begin[f] : end[f]]
            held = np.zeros(len(wanted), bool)
            held[rows[self.impacts[begin[f] : end[f]] * ROOM >= least[f] * self.norms[rows]]] = True
            wanted &= held
        return wanted


def search_parts(parts: DataFrame, block: Items, thresholds: np.ndarray, top: int) -> DataFrame:
    """The best documents of every item in each task, from vectors by falling length."""
    listed = [(terms[w > 0], w[w > 0], block.norm(i)) for i, terms in enumerate(block.terms) for w in [block.weights[terms]]]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(listed), thresholds, top)
        for batch in _buckets(batches):
            bucket = Bucket(batch)
            for item, (terms, weights, norm) in enumerate(listed):
                if len(terms):
                    bucket.search(item, terms, weights, norm, best)
        item = np.repeat(np.arange(len(listed), dtype=np.int32), [len(s) for s in best.scores])
        if len(item):
            docs = np.concatenate(best.docs)
            columns = [pa.array(item), pa.array(docs, mask=docs == NO_ID), pa.array(np.concatenate(best.scores))]
            yield pa.RecordBatch.from_arrays(columns, ["item", "doc_id", "score"])

    return parts.select("doc_id", "norm", "terms", "impacts").mapInArrow(search, FOUND_TYPE)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BUCKET):
            yield batch.slice(at, BUCKET)


def leading(found: DataFrame, top: int) -> DataFrame:
    """The `top` best rows of every item with their rank; a task hands on at most as many per item."""
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_block(docs: DataFrame, block: Items, text: str, doc_id: str, top: int) -> DataFrame | None:
    """`(item, rank, doc_id, score)` of the items of a block; None if nothing can be found."""
    if not len(block.hashes):
        return None
    held = written(postings(docs, block.hashes, text, doc_id), "postings")
    documents, total, df = corpus_counts(held, len(block.hashes))
    block.weights = term_weights(documents, df)
    weighed = vectors(held, block.weights, documents, total)
    parts = max(1, -(-documents // ROWS_PER_PART))
    # Ids and hashes cut runs of equal length, so that copies do not share one part.
    order = [F.desc("norm"), F.asc_nulls_last("doc_id"), F.xxhash64("terms", "impacts")]
    cut = weighed.repartitionByRange(parts, *order).sortWithinPartitions(F.desc("norm"))
    ordered = written(cut.withColumn("part", F.spark_partition_id()), "vectors")
    # The first of the parts that has rows: the sampled cuts may leave some empty.
    first = ordered.agg(F.min("part").alias("part")).first()["part"]
    if first is None:
        return None
    none = np.zeros(len(block.ids), np.int64)
    longest = written(search_parts(ordered.where(F.col("part") == first), block, none, top), "longest")
    thresholds = none.copy()
    # At most one row per item of the block.
    for item, score in leading(longest, top).where(F.col("rank") == top).select("item", "score").collect():
        thresholds[item] = score
    others = search_parts(ordered.where(F.col("part") > first), block, thresholds, top)
    return leading(longest.unionAll(others), top)


def rank_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id"
) -> DataFrame:
    """`(item_id, rank, doc_id, score)`: the `top` best documents of every item with a score above 0."""
    spark: SparkSession = docs.sparkSession
    out = spark.createDataFrame([], RESULT_TYPE)
    for block in item_blocks(items, text, item_id):
        found = search_block(docs, block, text, doc_id, top)
        if found is not None:
            names = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id long")
            named = found.join(F.broadcast(names), "item")
            out = out.unionAll(named.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))
    return out
