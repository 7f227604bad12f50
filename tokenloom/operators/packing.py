"""Token streams: offsets, block-aligned chunks, random windows and the batch plan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.keys import key_integer, order_key
from tokenloom.operators.ordered import BUCKET, bucket_digits, hashed_prefix_sum

WINDOW_SEED = 1337
MOST_SPLITS = 1000
# Names the run of chunks that a piece of text lies in.
RUN = "stream_run"


def stream_offsets(encoded: DataFrame) -> DataFrame:
    """Adds `stream_start`, the position of each document in the token stream of its split, and its bucket."""
    digits = bucket_digits(encoded.count())
    return hashed_prefix_sum(encoded, "split", "order_key", "doc_id", F.col("len"), "stream_start", digits, keep_bucket=True)


def pack_chunks(offsets: DataFrame, block: int, run: int = 1) -> DataFrame:
    """The stream cut into `(split, chunk_id, tokens)` rows of `block` tokens, the last one shorter.

    A document is sliced at chunk borders. A chunk gathers at most `block` pieces, as every piece
    holds a token. Rows that still lie by the bucket of their order are gathered where they are;
    only chunks that cross a bucket's border are shuffled, so the tokens move once. With
    `run`, that many consecutive chunks meet in one partition, in order, ready for a file. Rows that were laid there
    by `text_runs` are cut into chunks as they come.
    """
    if RUN in offsets.columns:
        return chunks_in_order(offsets, block)
    end = F.col("stream_start") + F.col("len")
    size = F.lit(block).cast("long")

    def piece(chunk):
        first = F.greatest(F.col("stream_start"), chunk * size)
        last = F.least(end, (chunk + 1) * size)
        taken = F.slice("ids", (first - F.col("stream_start") + 1).cast("int"), (last - first).cast("int"))
        return F.struct(chunk.alias("chunk_id"), first.alias("first"), taken.alias("piece"))

    first_chunk = F.expr(f"stream_start div {block}")
    last_chunk = F.expr(f"(stream_start + len - 1) div {block}")
    pieces = offsets.where(F.col("len") > 0).select(
        "split", *[c for c in offsets.columns if c == BUCKET], F.inline(F.transform(F.sequence(first_chunk, last_chunk), piece))
    )
    if BUCKET in pieces.columns and run == 1:
        near = pieces.groupBy("split", BUCKET, "chunk_id").agg(F.sort_array(F.collect_list(F.struct("first", "piece"))).alias("p"))
        joined = near.select("split", "chunk_id", "p", F.flatten(F.transform("p", lambda s: s["piece"])).alias("tokens"))
        whole = joined.where(F.size("tokens") == block).select("split", "chunk_id", "tokens")
        border = joined.where(F.size("tokens") < block).select("split", "chunk_id", F.explode("p").alias("part"))
        met = border.groupBy("split", "chunk_id").agg(F.sort_array(F.collect_list("part")).alias("p"))
        return whole.unionAll(met.select("split", "chunk_id", F.flatten(F.transform("p", lambda s: s["piece"])).alias("tokens")))
    keys = ["split", "chunk_id"]
    if run > 1:
        # The grouping keys contain the shuffle keys, so the grouping adds no second shuffle.
        pieces = pieces.withColumn("run", F.expr(f"chunk_id div {run}"))
        # About one partition per run, whatever the session's default is: a task gathers the tokens of a file or two.
        sums = offsets.agg(F.coalesce(F.sum(F.col("len").cast("long")), F.lit(0)).alias("n"), F.count_distinct("split").alias("splits")).first()
        pieces = pieces.repartition(sums["n"] // (block * run) + sums["splits"] + 1, "split", "run")
        keys = ["split", "run", "chunk_id"]
    gathered = pieces.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("first", "piece"))).alias("p"))
    chunks = gathered.select("split", "chunk_id", F.flatten(F.transform("p", lambda s: s["piece"])).alias("tokens"))
    return chunks.sortWithinPartitions("split", "chunk_id") if run > 1 else chunks


def text_runs(offsets: DataFrame, block: int, run: int, tokens: dict[str, int]) -> DataFrame:
    """Texts of one id per character, cut where a run of `run` chunks ends, with all of a run in one partition, in order.

    `tokens` is the length of each split. Texts are shuffled, as their ids would take several times the bytes.
    """
    size = block * run
    end = F.col("stream_start") + F.col("len")
    first_run, last_run = F.expr(f"stream_start div {size}"), F.expr(f"(stream_start + len - 1) div {size}")

    def piece(number):
        first, last = F.greatest(F.col("stream_start"), number * size), F.least(end, (number + 1) * size)
        part = F.substring(F.col("text"), (first - F.col("stream_start") + 1).cast("int"), (last - first).cast("int"))
        text = F.when(first_run == last_run, F.col("text")).otherwise(part)
        return F.struct(number.alias(RUN), first.alias("stream_start"), text.alias("text"))

    pieces = offsets.where(F.col("len") > 0).select("split", F.inline(F.transform(F.sequence(first_run, last_run), piece)))
    parts = sum(tokens.values()) // size + len(tokens) + 1
    return pieces.repartition(parts, "split", RUN).sortWithinPartitions("split", RUN, "stream_start")


def chunks_in_order(rows: DataFrame, block: int) -> DataFrame:
    """Chunks of `(split, stream_start, ids)` rows that come in the order of their stream, from a chunk's first token on."""

    def listed(split: str, first: int, ids: np.ndarray) -> pa.RecordBatch:
        ends = np.append(np.arange(0, len(ids), block), len(ids)).astype(np.int32)
        chunks = first // block + np.arange(len(ends) - 1)
        columns = [pa.array([split] * len(chunks), pa.string()), pa.array(chunks, pa.int64())]
        return pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), pa.array(ids))], ["split", "chunk_id", "tokens"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, first, rest = None, 0, np.zeros(0, np.int32)
        for batch in batches:
            if batch.num_rows == 0:
                continue
            splits = batch.column(0).to_numpy(zero_copy_only=False)
            starts = batch.column(1).to_numpy()
            lists = batch.column(2)
            ids = lists.flatten().to_numpy()
            ends = np.cumsum(lists.value_lengths().to_numpy().astype(np.int64))
            sizes = np.diff(ends, prepend=0)
            follows = (splits[1:] == splits[:-1]) & (starts[1:] == starts[:-1] + sizes[:-1])
            borders = np.flatnonzero(np.concatenate([[True], ~follows]))
            for low, high in zip(borders, [*borders[1:], batch.num_rows]):
                if (splits[low], starts[low]) != (split, first + len(rest)):
                    if len(rest):
                        yield listed(split, first, rest)
                    if starts[low] % block:
                        raise ValueError("the rows do not begin with a chunk")
                    split, first, rest = splits[low], int(starts[low]), rest[:0]
                rest = np.concatenate([rest, ids[ends[low] - sizes[low] : ends[high - 1]]])
                whole = len(rest) // block * block
                if whole:
                    yield listed(split, first, rest[:whole])
                    first, rest = first + whole, rest[whole:]
        if len(rest):
            yield listed(split, first, rest)

    return rows.select("split", "stream_start", "ids").mapInArrow(cut, "split string, chunk_id long, tokens array<int>")


def stream_lengths(encoded: DataFrame, length: Column | None = None) -> dict[str, int]:
    """Tokens per split. Splits are named one by one in later plans, so more than `MOST_SPLITS` raise."""
    length = F.col("len") if length is None else length
    sums = encoded.groupBy("split").agg(F.sum(length.cast("long")).alias("n"))
    rows = sums.limit(MOST_SPLITS + 1).collect()
    if len(rows) > MOST_SPLITS:
        raise ValueError(f"more than {MOST_SPLITS} splits")
    return {r["split"]: r["n"] for r in rows}


def batch_plan(
    spark: SparkSession,
    iterations: int,
    batch_size: int,
    accumulation: int = 1,
    ranks: int = 1,
    seed: int = WINDOW_SEED,
) -> DataFrame:
    """One row per drawn window: `(iter, micro_step, rank, slot, rank_seed)`.

    `accumulation` is divided among the ranks. The rows are counted off one distributed
    range, so nothing is joined.
    """
    if accumulation % ranks:
        raise ValueError("gradient accumulation steps must be divisible by the number of ranks")
    micro = accumulation // ranks
    slots = spark.range(iterations * micro * ranks * batch_size)
    i = F.col("id")
    return slots.select(
        F.expr(f"id div {micro * ranks * batch_size}").alias("iter"),
        F.expr(f"id div {ranks * batch_size} % {micro}").cast("int").alias("micro_step"),
        F.expr(f"id div {batch_size} % {ranks}").cast("int").alias("rank"),
        (i % batch_size).cast("int").alias("slot"),
        (F.expr(f"id div {batch_size} % {ranks}") + seed).cast("int").alias("rank_seed"),
    )


def draw_offsets(plan: DataFrame, split: str, tokens: int, block: int) -> DataFrame:
    """A start in [0, tokens - block) for every planned window, with replacement."""
    if tokens <= block:
        raise ValueError(f"{tokens} tokens are too few for windows of {block}")
    draw = F.md5(
        F.concat_ws(
            ":", F.col("rank_seed").cast("string"), F.lit(split), *[F.col(c).cast("string") for c in ("iter", "micro_step", "slot")]
        )
    )
    return plan.withColumn("split", F.lit(split)).withColumn(
        "offset", key_integer(draw) % F.lit(tokens - block).cast("long")
    )


def cut_windows(windows: DataFrame, chunks: DataFrame, block: int, *keys: str) -> DataFrame:
    """`x` and `y` (`x` moved on by one) of every window, read from the chunks it touches.

    A window of block + 1 tokens lies in two neighbouring chunks. Each half is sliced next to
    its chunk and only the tokens of the window are shuffled again. Offsets are uniform, so
    no chunk is hot.
    """
    size = F.lit(block).cast("long")
    first = F.expr(f"offset div {block}")
    halves = windows.select(*keys, "split", "offset", F.explode(F.array(first, first + 1)).alias("chunk_id"))
    start = F.greatest(F.col("offset"), F.col("chunk_id") * size)
    end = F.least(F.col("offset") + block + 1, (F.col("chunk_id") + 1) * size)
    part = F.slice("tokens", (start - F.col("chunk_id") * size + 1).cast("int"), (end - start).cast("int"))
    cut = halves.join(chunks, ["split", "chunk_id"]).select(*keys, "split", "offset", "chunk_id", part.alias("part"))
    whole = cut.groupBy(*keys, "split", "offset").agg(F.sort_array(F.collect_list(F.struct("chunk_id", "part"))).alias("p"))
    tokens = F.flatten(F.transform("p", lambda s: s["part"]))
    return whole.withColumn("t", tokens).select(
        *keys, "split", "offset", F.slice("t", 1, block).alias("x"), F.slice("t", 2, block).alias("y")
    )


def epoch_blocks(chunks: DataFrame, block: int, first: int = 0, last: int | None = None) -> DataFrame:
    """Full blocks of the stream in order, optionally from `first` up to but not including `last`."""
    wanted = F.col("chunk_id") >= first
    if last is not None:
        wanted &= F.col("chunk_id") < last
    return chunks.where(wanted & (F.size("tokens") == block))


def synthetic_tokens(rows: DataFrame, key: str, block: int, vocab_size: int = 50304, seed: int = WINDOW_SEED) -> DataFrame:
    """A fixed block of uniform token ids for every row, the same whenever it is read."""
    ids = F.transform(
        F.sequence(F.lit(0), F.lit(block - 1)),
        lambda i: (key_integer(order_key(seed, F.col(key), i)) % vocab_size).cast("int"),
    )
    return rows.select(key, ids.alias("tokens"))
