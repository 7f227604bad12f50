"""Next-token model from pair counts, and cross-entropy under it."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType

from tokenloom.functions.lookup import ID_LIMIT
from tokenloom.operators.joins import BROADCAST_VALUES, fits_broadcast, lookup_join
from tokenloom.session import cut_lineage, written

# Share of the pair estimate; the rest is the add-one estimate of the single token.
PAIR_WEIGHT = 0.75
IGNORED_TARGET = -1
# Distinct pairs that a task adds up before it hands them on.
PAIRS_HELD = 1_000_000
# Tokens of the documents that are scored together: their distinct pairs are joined to the model, once each.
TOKENS_PER_BLOCK = 2_000_000
# Partitions that the blocks are dealt to.
MOST_PARTS = 8192


def pair_counts(encoded: DataFrame, eos_id: int, *by: str) -> DataFrame:
    """Occurrences of every (prev, next) per group; a document starts after the end-of-text id. Tasks add up their own pairs first."""
    kinds = {f.name: f.dataType for f in encoded.schema.fields}
    schema = StructType([*[StructField(c, kinds[c]) for c in by], *[StructField(c, IntegerType()) for c in ("prev", "next")], StructField("cnt", LongType())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[tuple[np.ndarray, np.ndarray]]] = {}
        pairs = 0
        for batch in batches:
            groups = {}
            names = list(zip(*[batch.column(c).to_pylist() for c in range(len(by))])) or [()] * batch.num_rows
            number = np.array([groups.setdefault(name, len(groups)) for name in names], np.int64)
            sizes, ids, before = followed_ids(batch.column(len(by)), eos_id)
            if len(ids) and (min(ids.min(), before.min()) < IGNORED_TARGET or max(ids.max(), before.max()) >= ID_LIMIT):
                raise ValueError("ids do not fit 16 bits")
            # Ids and the ignored target, which is below them, take 17 bits each.
            keys, counts = np.unique((np.repeat(number, sizes) << 34) | ((before + 1) << 17) | (ids + 1), return_counts=True)
            borders = np.searchsorted(keys, np.arange(len(groups) + 1) << 34)
            for name, i in groups.items():
                own = slice(borders[i], borders[i + 1])
                held.setdefault(name, []).append((keys[own] & ((1 << 34) - 1), counts[own]))
            pairs += len(keys)
            if pairs > PAIRS_HELD:
                yield added_up(held)
                held, pairs = {}, 0
        yield added_up(held)

    def added_up(held: dict[tuple, list[tuple[np.ndarray, np.ndarray]]]) -> pa.RecordBatch:
        names, found = [], []
        for name, parts in held.items():
            keys, place = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
            counts = np.zeros(len(keys), np.int64)
            np.add.at(counts, place, np.concatenate([c for _, c in parts]))
            found.append((keys, counts))
            names.append((name, len(keys)))
        keys, counts = (np.concatenate([f[i] for f in found] or [np.zeros(0, np.int64)]) for i in (0, 1))
        index = pa.array(np.repeat(np.arange(len(names)), [n for _, n in names]))
        columns = [pa.array([name[i] for name, _ in names], to_arrow_type(kinds[c])).take(index) for i, c in enumerate(by)]
        columns += [pa.array(((keys >> 17) - 1).astype(np.int32)), pa.array(((keys & 0x1FFFF) - 1).astype(np.int32)), pa.array(counts)]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    partial = encoded.select(*by, "ids").mapInArrow(count, schema)
    return partial.groupBy(*by, "prev", "next").agg(F.sum("cnt").alias("cnt"))


def followed_ids(lists: pa.Array, eos_id: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of ids of every document, all ids one after the other, and the id before each."""
    sizes = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
    ids = lists.flatten().to_numpy().astype(np.int64)
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = eos_id
    return sizes, ids, before


@dataclass(frozen=True)
class NgramModel:
    """Interpolated pair model. `contexts` and `tokens` hold at most one row per token id."""

    pairs: DataFrame
    contexts: DataFrame
    tokens: DataFrame
    total: int
    vocab_size: int

    def probability(self, cnt: Column, context_cnt: Column, token_cnt: Column) -> Column:
        single = (F.coalesce(token_cnt, F.lit(0)) + 1.0) / F.lit(float(self.total + self.vocab_size))
        pair = F.coalesce(cnt, F.lit(0)) / context_cnt
        return F.when(context_cnt.isNull(), single).otherwise(F.lit(PAIR_WEIGHT) * pair + F.lit(1 - PAIR_WEIGHT) * single)


def train_ngram(counts: DataFrame, vocab_size: int) -> NgramModel:
    """Model of `(prev, next, cnt)` rows; the counted pairs are written once and shared by all uses."""
    if vocab_size > ID_LIMIT:
        raise ValueError("vocabulary does not fit 16-bit ids")
    pairs = cut_lineage(counts.select("prev", "next", "cnt"))
    contexts = pairs.groupBy("prev").agg(F.sum("cnt").alias("context_cnt"))
    tokens = pairs.groupBy("next").agg(F.sum("cnt").alias("token_cnt"))
    total = pairs.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("n")).first()["n"]
    return NgramModel(pairs, contexts, tokens, total, vocab_size)


def with_probability(rows: DataFrame, model: NgramModel, spread_by: str, most_values: int | None = None) -> DataFrame:
    """Adds `p` of `next` after `prev` to rows with distinct `(spread_by, prev, next)`.

    Rows that meet a model of more than `most_values` pairs are written first: their heavy pairs are counted, then joined.
    """
    size = model.pairs.count()
    if not fits_broadcast(size, most_values):
        rows = written(rows)
    known = model.pairs.withColumnRenamed("cnt", "pair_cnt")
    joined = (
        lookup_join(rows, known, ["prev", "next"], size, spread_by, most_values=most_values)
        .join(F.broadcast(model.contexts), "prev", "left")
        .join(F.broadcast(model.tokens), "next", "left")
    )
    p = model.probability(F.col("pair_cnt"), F.col("context_cnt"), F.col("token_cnt"))
    return joined.withColumn("p", p).drop("pair_cnt", "context_cnt", "token_cnt")


def cross_entropy(counts: DataFrame, model: NgramModel, *by: str) -> DataFrame:
    """Mean loss and perplexity per group of counted pairs; ignored targets do not count."""
    scored = with_probability(counts.where(F.col("next") != IGNORED_TARGET), model, by[0])
    mean = F.sum(-F.log("p") * F.col("cnt")) / F.sum("cnt")
    return scored.groupBy(*by).agg(F.sum("cnt").alias("tokens"), mean.alias("loss"), F.exp(mean).alias("perplexity"))


def window_losses(windows: DataFrame, model: NgramModel, *by: str) -> DataFrame:
    """Mean loss of each batch of windows: positions of `x` predict `y`."""
    pairs = windows.select(*by, F.inline(F.arrays_zip(F.col("x").alias("prev"), F.col("y").alias("next"))))
    counts = pairs.groupBy(*by, "prev", "next").agg(F.count(F.lit(1)).alias("cnt"))
    # All groups of a batch share hot pairs, so a batch column spreads them.
    return cross_entropy(counts, model, *reversed(by)).drop("perplexity")


def loss_of_ids(model: NgramModel, eos_id: int):
    """Arrow function from the ids of a document to its mean loss; null without ids.

    The seen pairs travel as two sorted arrays, the rest is one number per token id.
    """
    size = model.vocab_size
    pairs = model.pairs.join(F.broadcast(model.contexts), "prev").join(F.broadcast(model.tokens), "next", "left")
    p = model.probability(F.col("cnt"), F.col("context_cnt"), F.col("token_cnt"))
    key = F.col("prev").cast("long") * size + F.col("next")
    seen = pairs.select(key.alias("key"), (-F.log(p)).alias("loss")).toPandas().sort_values("key")
    keys, losses = seen["key"].to_numpy(np.int64), seen["loss"].to_numpy(float)
    counts = np.zeros(size)
    for r in model.tokens.collect():
        counts[r["next"]] = r["token_cnt"]
    single = -np.log((counts + 1.0) / float(model.total + size))
    followed = np.zeros(size, bool)
    followed[keys // size] = True
    unseen = -math.log(1 - PAIR_WEIGHT)

    @F.arrow_udf("double")
    def fold(batch: pa.Array) -> pa.Array:
        lengths, following, before = followed_ids(batch, eos_id)
        firsts = (np.cumsum(lengths) - lengths)[lengths > 0]
        wanted = before * size + following
        at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
        loss = single[following] + np.where(followed[before], unseen, 0.0)
        if len(keys):
            loss = np.where(keys[at] == wanted, losses[at], loss)
        means = np.full(len(lengths), np.nan)
        if len(firsts):
            means[lengths > 0] = np.add.reduceat(loss, firsts) / lengths[lengths > 0]
        return pa.array(means, mask=lengths == 0)

    # Not to be evaluated once more for the filter on its result.
    return fold.asNondeterministic()


def document_losses(
    encoded: DataFrame,
    model: NgramModel,
    eos_id: int,
    *keep: str,
    most_pairs: int = BROADCAST_VALUES // 2,
    most_values: int | None = None,
) -> DataFrame:
    """Mean loss of every non-empty document.

    A model of at most `most_pairs` pairs (counted) travels to the documents, which are folded where they stand, without
    a shuffle. Beyond that, pairs are counted per block of documents and joined, beyond `most_values` with heavy pairs
    spread, and the documents of a block are folded with its pairs. Rows of one document count as one.
    """
    if model.pairs.count() <= most_pairs:
        folded = encoded.select("doc_id", *keep, loss_of_ids(model, eos_id)(F.col("ids")).alias("loss"))
        return folded.where(F.col("loss").isNotNull())
    blocked = in_blocks(encoded.select("doc_id", *keep, "ids"))
    counts = pair_counts(blocked, eos_id, "_block").select("_block", "prev", "next")
    scored = with_probability(counts, model, "_block", most_values).select("_block", pair_key("prev", "next").alias("key"), (-F.log("p")).alias("loss"))
    kinds = {f.name: f.dataType for f in blocked.schema.fields}
    schema = StructType([*[StructField(c, kinds[c]) for c in ("doc_id", *keep)], StructField("loss", DoubleType()), StructField("n", LongType())])

    def fold(docs: pa.Table, pairs: pa.Table) -> pa.Table:
        docs = docs.combine_chunks()
        keys, losses = pairs["key"].to_numpy(), pairs["loss"].to_numpy()
        order = np.argsort(keys)
        keys, losses = keys[order], losses[order]
        lists = docs["ids"].combine_chunks() if isinstance(docs["ids"], pa.ChunkedArray) else docs["ids"]
        sizes, ids, before = followed_ids(lists, eos_id)
        loss = losses[np.searchsorted(keys, before * ID_LIMIT + ids)] if len(ids) else np.zeros(0)
        sums = np.zeros(len(sizes))
        firsts = np.cumsum(sizes) - sizes
        if len(ids):
            sums[sizes > 0] = np.add.reduceat(loss, firsts[sizes > 0])
        return pa.table({**{c: docs[c] for c in ("doc_id", *keep)}, "loss": sums, "n": sizes})

    met = blocked.groupBy("_block").cogroup(scored.groupBy("_block")).applyInArrow(fold, schema)
    return met.where(F.col("n") > 0).groupBy("doc_id", *keep).agg((F.sum("loss") / F.sum("n")).alias("loss"))


def pair_key(prev: str, following: str) -> Column:
    return F.col(prev).cast("long") * ID_LIMIT + F.col(following)


def in_blocks(docs: DataFrame) -> DataFrame:
    """Documents with `_block`, one of as many as their tokens ask for, by key and ids, and those of a block together."""
    tokens = docs.agg(F.coalesce(F.sum(F.size("ids").cast("long")), F.lit(0)).alias("n")).first()["n"]
    blocks = tokens // TOKENS_PER_BLOCK + 1
    numbered = docs.where(F.size("ids") > 0).withColumn("_block", F.pmod(F.xxhash64("doc_id", "ids"), F.lit(blocks)).cast("int"))
    return numbered.repartition(max(1, min(blocks, MOST_PARTS)), "_block")


# Lower ends of the loss bands, from 0 up.
LOSS_BANDS = [
    (0.0, "overfit risk"),
    (2.0, "below good"),
    (2.5, "good"),
    (2.8, "above good"),
    (3.0, "sentences"),
    (3.5, "above sentences"),
    (4.0, "words"),
    (5.0, "above words"),
    (7.0, "frequencies"),
    (8.0, "above frequencies"),
    (10.0, "random"),
]


def loss_band(loss: Column) -> Column:
    """Name of the half-open band a loss falls in."""
    band = F.lit(LOSS_BANDS[0][1])
    for low, name in LOSS_BANDS[1:]:
        band = F.when(loss >= low, name).otherwise(band)
    return band
