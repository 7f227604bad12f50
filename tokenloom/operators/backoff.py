"""Next-token model over contexts of several lengths: a count trie, interpolated from the longest context that it holds.

Level k holds the contexts of the last k ids with the tokens that follow them. A context of n
occurrences and t different followers gives its counts the weight n / (n + t) and leaves the rest to the
context that is one id shorter (Witten and Bell); below the single tokens lies add-one. Contexts with
fewer than `least` occurrences are pruned. A longer context never occurs more often, so a pruned one has
no kept one above it, and the probabilities of all tokens add up to 1 after any context.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField, StructType

from tokenloom.functions.keys import order_key, uniform
from tokenloom.functions.lookup import ID_LIMIT, constant_array
from tokenloom.operators.joins import fits_broadcast, lookup_join
from tokenloom.operators.sampling import SAMPLE_SEED
from tokenloom.session import cut_lineage, written

# Ids of the longest context; with the token after it they fill 64 bits.
ORDER = 3
LEAST = 2
# Stands where a context is shorter; no id is as large.
NO_ID = ID_LIMIT - 1
CONTEXT = [f"c{k}" for k in range(1, ORDER + 1)]
# Distinct runs that a task adds up before it hands them on.
RUNS_HELD = 2_000_000
# Rows and runs of one last id that meet in a task before they are spread over several.
PIECE_ROWS = 1_000_000
# Rows that such a task looks up at a time, and goes on with to the end of their last two ids.
STREAM_ROWS = 500_000
# What a row of such a task is: a follower of a last id, a run of the trie, or a row to be scored.
FOLLOWER, RUN, WANTED = range(3)


def packed_runs(ids: np.ndarray, sizes: np.ndarray, eos_id: int) -> np.ndarray:
    """Every id with the `ORDER` ids before it in its document, which starts after the end-of-text id, as one number."""
    # Each document behind one end-of-text id.
    starts = np.cumsum(sizes + 1) - (sizes + 1)
    padded = np.empty(len(ids) + len(sizes), np.uint64)
    place = np.arange(len(ids)) + np.repeat(np.arange(1, len(sizes) + 1), sizes)
    padded[starts], padded[place] = eos_id, ids
    depth = place - np.repeat(starts, sizes)
    keys = padded[place]
    for k in range(1, ORDER + 1):
        before = np.where(depth >= k, padded[np.maximum(place - k, 0)], np.uint64(NO_ID))
        keys |= before << np.uint64(16 * k)
    return keys


def run_counts(encoded: DataFrame, eos_id: int, by: str) -> DataFrame:
    """`(by, next, c1, c2, c3, cnt)`: how often a token follows its context; tasks add up their own runs first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str | None, list[np.ndarray]] = {}
        rows = 0
        for batch in batches:
            names = batch.column(0).to_pylist()
            for name in dict.fromkeys(names):
                lists = batch.column(1).filter(pa.array([n == name for n in names]))
                sizes = lists.value_lengths().fill_null(0).to_numpy().astype(np.int64)
                ids = lists.flatten().to_numpy()
                if ids.size and (ids.min() < 0 or ids.max() >= NO_ID):
                    raise ValueError("ids do not fit the packed contexts")
                found = np.unique(packed_runs(ids.astype(np.uint64), sizes, eos_id), return_counts=True)
                held.setdefault(name, []).append(np.stack([found[0].view(np.int64), found[1].astype(np.int64)]))
                rows += len(found[0])
            if rows > RUNS_HELD:
                yield from _run_batches(held, by)
                held, rows = {}, 0
        yield from _run_batches(held, by)

    partial = encoded.select(F.col(by).cast("string"), "ids").mapInArrow(count, f"{by} string, _run long, cnt long")
    summed = partial.groupBy(by, "_run").agg(F.sum("cnt").alias("cnt"))
    fields = [F.shiftrightunsigned("_run", 16 * k).bitwiseAND(0xFFFF).cast("int").alias(c) for k, c in enumerate(["next", *CONTEXT])]
    return summed.select(by, *fields, "cnt")


def _run_batches(held: dict, by: str) -> Iterator[pa.RecordBatch]:
    for name, parts in held.items():
        keys, place = np.unique(np.concatenate([p[0] for p in parts]).view(np.uint64), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, place, np.concatenate([p[1] for p in parts]))
        columns = [pa.array([name] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(counts)]
        yield pa.RecordBatch.from_arrays(columns, [by, "_run", "cnt"])


@dataclass(frozen=True)
class Trie:
    """Per level: `followers` (context, next, cnt) and `contexts` (context, total, kinds), with their numbers of rows.

    Where the counted `runs` are too many to be sent to every task, the levels above the first are read off them.
    """

    tokens: DataFrame
    followers: list[DataFrame]
    contexts: list[DataFrame]
    sizes: list[tuple[int, int]]
    total: int
    vocab_size: int
    runs: DataFrame
    least: int


def train_trie(counts: DataFrame, vocab_size: int, least: int = LEAST, stored: bool = False) -> Trie:
    """The trie of `(next, c1, c2, c3, cnt)` rows; its levels are sums over the counted runs, the tokens are read once.

    `stored` rows are written and hold each run once.
    """
    if vocab_size >= NO_ID:
        raise ValueError("vocabulary does not fit the packed contexts")
    runs = counts.select("next", *CONTEXT, "cnt")
    if not stored:
        runs = written(runs.groupBy("next", *CONTEXT).agg(F.sum("cnt").alias("cnt")))
    tokens = cut_lineage(runs.groupBy("next").agg(F.sum("cnt").alias("token_cnt")))
    total = tokens.agg(F.coalesce(F.sum("token_cnt"), F.lit(0)).alias("n")).first()["n"]
    levels = ORDER if fits_broadcast(3 * runs.count()) else 1
    followers, contexts, sizes = [], [], []
    for k in range(1, levels + 1):
        keys = CONTEXT[:k]
        level = runs.where(F.col(keys[-1]) != NO_ID).groupBy(*keys, "next").agg(F.sum("cnt").alias("cnt"))
        above = level.groupBy(*keys).agg(F.sum("cnt").alias("total"), F.count(F.lit(1)).alias("kinds"))
        above = cut_lineage(above.where(F.col("total") >= least))
        kept = level.join(above.select(*keys), keys, "left_semi")
        followers.append(cut_lineage(kept.withColumnRenamed("cnt", "_cnt")))
        contexts.append(above)
        sizes.append((3 * followers[-1].count(), 3 * above.count()))
    return Trie(tokens, followers, contexts, sizes, total, vocab_size, runs, least)


def with_probability(rows: DataFrame, trie: Trie, spread_by: str, most_values: int | None = None, stored: bool = False) -> DataFrame:
    """Adds `p` of `next` after the context, and `matched`, the length of the longest context that the trie holds.

    Rows that meet a level of more than `most_values` values meet all levels in one shuffle; they are written first
    unless they are `stored`, as they are read once more to spread their last ids.
    """
    if len(trie.sizes) < ORDER or not fits_broadcast(max(n for size in trie.sizes for n in size), most_values):
        return _met_in_order(rows if stored else written(rows), trie)
    joined = rows.join(F.broadcast(trie.tokens), "next", "left")
    p = (F.coalesce("token_cnt", F.lit(0)) + 1.0) / F.lit(float(trie.total + trie.vocab_size))
    joined = joined.withColumn("p", p).withColumn("matched", F.lit(0)).drop("token_cnt")
    for k in range(1, ORDER + 1):
        keys = CONTEXT[:k]
        joined = lookup_join(joined, trie.contexts[k - 1], keys, trie.sizes[k - 1][1], spread_by, rows, most_values)
        joined = lookup_join(joined, trie.followers[k - 1], [*keys, "next"], trie.sizes[k - 1][0], spread_by, rows, most_values)
        mixed = (F.coalesce("_cnt", F.lit(0)) + F.col("kinds") * F.col("p")) / (F.col("total") + F.col("kinds"))
        joined = (
            joined.withColumn("p", F.when(F.col("total").isNull(), F.col("p")).otherwise(mixed))
            .withColumn("matched", F.when(F.col("total").isNull(), F.col("matched")).otherwise(F.lit(k)))
            .drop("total", "kinds", "_cnt")
        )
    return joined


def _met_in_order(rows: DataFrame, trie: Trie) -> DataFrame:
    """`with_probability` for large tries: the rows and the counted runs are shuffled by their last ids, once, and sorted.

    A task then finds the runs of a row's last two ids next to it, and sums the upper levels up from them. A last id of
    more than `PIECE_ROWS` rows is dealt out by the id before it; its followers, one per token at most, go to each piece.
    """
    both = rows.select("c1").unionAll(trie.runs.select("c1"))
    held = {r["c1"]: r["n"] for r in both.groupBy("c1").agg(F.count(F.lit(1)).alias("n")).collect()}
    pieces = constant_array([-(-held.get(i, 1) // PIECE_ROWS) for i in range(ID_LIMIT)], "int")
    rest = [f for f in rows.schema.fields if f.name not in ("next", *CONTEXT)]
    piece = F.pmod(F.xxhash64("c2"), F.get(pieces, F.col("c1"))).cast("int")

    def keyed(frame: DataFrame, kind: int, cnt: Column, *kept: Column) -> DataFrame:
        key = reduce(Column.bitwiseOR, [F.shiftleft(F.col(c).cast("long"), 48 - 16 * k) for k, c in enumerate([*CONTEXT, "next"])])
        marks = [key.alias("_run"), F.lit(kind).cast("byte").alias("_kind"), cnt.cast("long").alias("_cnt")]
        return frame.select(F.col("c1").alias("_last"), F.col("_piece"), *marks, *kept)

    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in rest]
    copied = trie.followers[0].withColumn("_piece", F.explode(F.sequence(F.lit(0), F.get(pieces, F.col("c1")) - 1)))
    copied = copied.withColumns({c: F.lit(0) for c in CONTEXT[1:]})
    met = (
        keyed(copied, FOLLOWER, F.col("_cnt"), *empty)
        .unionAll(keyed(trie.runs.withColumn("_piece", piece), RUN, F.col("cnt"), *empty))
        .unionAll(keyed(rows.withColumn("_piece", piece), WANTED, F.lit(None), *[F.col(f.name) for f in rest]))
    )
    parts = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), sum(held.values()) // (4 * PIECE_ROWS) + 1)
    order = ["_last", "_piece", F.col("_kind") != FOLLOWER, "_run"]
    laid = met.repartition(parts, "_last", "_piece").sortWithinPartitions(*order)
    schema = StructType([*rest, StructField("_run", LongType()), StructField("p", DoubleType()), StructField("matched", IntegerType())])
    scored = laid.mapInArrow(_scorer(trie, [f.name for f in rest]), schema)
    fields = [F.shiftrightunsigned("_run", 48 - 16 * k).bitwiseAND(0xFFFF).cast("int").alias(c) for k, c in enumerate([*CONTEXT, "next"])]
    return scored.select(*[f.name for f in rest], *fields, "p", "matched")


def _found(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the wanted keys in a sorted table, and whether they are there."""
    if not len(table):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def _scorer(trie: Trie, rest: list[str]):
    """Function from sorted rows of `_met_in_order` to scored ones; it holds one number per token id."""
    counts = np.zeros(ID_LIMIT)
    for r in trie.tokens.collect():
        counts[r["next"]] = r["token_cnt"]
    single = (counts + 1.0) / float(trie.total + trie.vocab_size)
    totals, kinds = np.zeros(ID_LIMIT), np.zeros(ID_LIMIT)
    for r in trie.contexts[0].collect():
        totals[r["c1"]], kinds[r["c1"]] = r["total"], r["kinds"]
    least, low = trie.least, np.uint64(0xFFFF)

    def mixed(p, count, total, kind):
        return (count + kind * p) / (total + kind)

    def score(table: pa.Table, carried: tuple[np.ndarray, np.ndarray]) -> tuple[pa.RecordBatch, tuple[np.ndarray, np.ndarray]]:
        runs = table["_run"].to_numpy().view(np.uint64)
        kind = table["_kind"].to_numpy()
        cnt = table["_cnt"].fill_null(0).to_numpy()
        first = kind == FOLLOWER
        pair = np.concatenate([carried[0], ((runs[first] >> np.uint64(48)) << np.uint64(16)) | (runs[first] & low)])
        pair, at = np.unique(pair, return_index=True)
        pair_cnt = np.concatenate([carried[1], cnt[first]])[at]
        known, known_cnt = runs[kind == RUN], cnt[kind == RUN].astype(float)
        rows = np.flatnonzero(kind == WANTED)
        wanted = runs[rows]
        token, last = (wanted & low).astype(np.int64), (wanted >> np.uint64(48)).astype(np.int64)
        p, matched = single[token], np.zeros(len(rows), np.int32)
        at, there = _found(pair, ((wanted >> np.uint64(48)) << np.uint64(16)) | (wanted & low))
        count = np.where(there, pair_cnt[at] if len(pair) else 0, 0)
        held = totals[last] > 0
        p[held], matched[held] = mixed(p[held], count[held], totals[last][held], kinds[last][held]), 1
        for k in range(2, ORDER + 1):
            shift = np.uint64(64 - 16 * k)
            full = (known >> shift) & low != np.uint64(NO_ID)
            follower, place = np.unique((known[full] >> shift << np.uint64(16)) | (known[full] & low), return_inverse=True)
            if not len(follower):
                continue
            follower_cnt = np.bincount(place, known_cnt[full], len(follower))
            context, starts = np.unique(follower >> np.uint64(16), return_index=True)
            total, kinds_k = np.add.reduceat(follower_cnt, starts), np.diff(np.append(starts, len(follower)))
            at, held = _found(context, wanted >> shift)
            held &= total[at] >= least
            to, there = _found(follower, (wanted >> shift << np.uint64(16)) | (wanted & low))
            count = np.where(there, follower_cnt[to], 0.0)
            p[held], matched[held] = mixed(p[held], count[held], total[at][held], kinds_k[at][held]), k
        taken = table.select(rest).take(pa.array(rows)).combine_chunks()
        columns = [*[taken[c].combine_chunks() for c in rest], pa.array(wanted.view(np.int64)), pa.array(p), pa.array(matched)]
        columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
        # Rows that follow may end in the last id of these.
        stays = pair >> np.uint64(16) == runs[-1] >> np.uint64(48) if len(runs) else slice(0)
        return pa.RecordBatch.from_arrays(columns, [*rest, "_run", "p", "matched"]), (pair[stays], pair_cnt[stays])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carried = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < STREAM_ROWS:
                continue
            table = pa.Table.from_batches(held)
            runs, first = table["_run"].to_numpy().view(np.uint64), table["_kind"].to_numpy() == FOLLOWER
            # Followers of a last id, and rows that share their last two, stay together.
            group = np.where(first, runs >> np.uint64(48) << np.uint64(16), runs >> np.uint64(32))
            changes = np.flatnonzero((group[1:] != group[:-1]) | (first[1:] != first[:-1]))
            if len(changes):
                whole = int(changes[-1]) + 1
                scored, carried = score(table.slice(0, whole), carried)
                yield scored
                held = table.slice(whole).to_batches()
        if held:
            yield score(pa.Table.from_batches(held), carried)[0]

    return stream


def cross_entropy(counts: DataFrame, trie: Trie, by: str, most_values: int | None = None) -> DataFrame:
    """Mean loss and perplexity per group of counted runs."""
    scored = with_probability(counts, trie, by, most_values, stored=True)
    mean = F.sum(-F.log("p") * F.col("cnt")) / F.sum("cnt")
    return scored.groupBy(by).agg(F.sum("cnt").alias("tokens"), mean.alias("loss"), F.exp(mean).alias("perplexity"))


def context_of(ids: Column, block: int) -> list[Column]:
    """The last ids of a text, nearest first, as the model sees it through a window of `block` ids."""
    reach = F.least(F.size(ids), F.lit(block))
    return [F.when(reach >= k, F.element_at(ids, -k)).otherwise(F.lit(NO_ID)).alias(CONTEXT[k - 1]) for k in range(1, ORDER + 1)]


def distributions(rows: DataFrame, trie: Trie, temperature: float = 1.0) -> DataFrame:
    """`(c1, c2, c3, matched, upto)` of the contexts of `rows`: running sums of all tokens' probabilities, by id."""
    distinct = rows.select(*CONTEXT).distinct()
    every = F.sequence(F.lit(0), F.lit(trie.vocab_size - 1))
    dense = distinct.withColumn("_id", F.xxhash64(*CONTEXT)).withColumn("next", F.explode(every))
    weighed = with_probability(dense, trie, "_id").withColumn("w", F.pow("p", F.lit(1.0 / temperature)))
    listed = weighed.groupBy(*CONTEXT).agg(F.max("matched").alias("matched"), F.sort_array(F.collect_list(F.struct("next", "w"))).alias("s"))
    return listed.select(*CONTEXT, "matched", running_shares(F.col("s")["w"]).alias("upto"))


@F.arrow_udf(ArrayType(DoubleType()))
def running_shares(weights: pa.Array) -> pa.Array:
    """Running sums of every list, as shares of its whole."""
    lists = [np.cumsum(w) / max(np.sum(w), np.finfo(float).tiny) for w in weights.to_pylist()]
    return pa.array(lists, pa.list_(pa.float64()))


def draw_next(rows: DataFrame, trie: Trie, key: str, step: int, temperature: float = 1.0, seed: int = SAMPLE_SEED) -> DataFrame:
    """Adds `token`, drawn from all tokens after the context of each row, and the `matched` length of that context."""
    table = cut_lineage(distributions(rows, trie, temperature))
    u = uniform(order_key(seed, F.col(key), F.col("sample"), F.lit(step)))
    joined = lookup_join(rows, table, CONTEXT, trie.vocab_size * table.count(), key)
    at = F.array_position(F.transform("upto", lambda c: c > u), F.lit(True)).cast("int") - 1
    return joined.withColumn("token", F.when(at >= 0, at).otherwise(F.lit(trie.vocab_size - 1))).drop("upto")


def generate(
    prompts: DataFrame, trie: Trie, key: str, steps: int, block: int, temperature: float = 1.0, seed: int = SAMPLE_SEED
) -> DataFrame:
    """`generated` ids after `steps` draws for all fanned-out prompts, each seen through a window of `block` ids."""
    state = prompts.select(key, "sample", *context_of(F.col("ids"), block), F.array().cast("array<int>").alias("generated"))
    for step in range(steps):
        drawn = draw_next(state, trie, key, step, temperature, seed)
        moved = [F.col("token").alias("c1"), *[F.col(f"c{k - 1}").alias(f"c{k}") for k in range(2, ORDER + 1)]]
        seen = [c if k < block else F.lit(NO_ID).alias(f"c{k + 1}") for k, c in enumerate(moved)]
        state = cut_lineage(drawn.select(key, "sample", *seen, F.array_append("generated", F.col("token")).alias("generated")))
    return state.select(key, "sample", "generated")
