"""Queries over the packed token dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions.arrays import digest, joined
from tokenloom.operators import packing
from tokenloom.operators.encode import char_ids, encode_documents
from tokenloom.operators.ordered import ranged_prefix_sum
from tokenloom.operators.packing import stream_lengths, text_runs
from tokenloom.operators.splits import sequential_split
from tokenloom.operators.vocab import char_vocab, collect_ids
from tokenloom.plans import sqlparts as S
from tokenloom.plans.tables import char_tokens, documents
from tokenloom.session import scratch_path
from tokenloom.sources import metadata as meta
from tokenloom.sources.documents import clean, write_corpus_text
from tokenloom.sources.textrange import read_text_ranges
from tokenloom.sources.tokenbin import read_tokens, read_windows, write_tokens
from tokenloom.streaming.encode import document_stream
from tokenloom.streaming.tokens import read_token_stream, write_char_stream

BLOCK = 256
BATCH = 4
ACCUMULATION = 4
RANKS = 2
# Files of 128 MB of 16-bit ids.
# Share of a stream's documents that are held out, by their keys.
STREAM_FRACTION = 0.1
# Bytes of a range and of a piece of a text file.
RANGE_BYTES, PIECE_BYTES = 8 << 20, 1 << 18
CHUNKS_PER_FILE = (128 << 20) // (2 * BLOCK)


def chunks_of(spark: SparkSession, sf: str, run: int = 1) -> tuple[DataFrame, DataFrame]:
    encoded, _, _ = char_tokens(spark, sf)
    return packing.pack_chunks(packing.stream_offsets(encoded), BLOCK, run), encoded


def summary(chunks: DataFrame) -> DataFrame:
    return chunks.select(
        "split", "chunk_id", F.size("tokens").alias("n_tokens"), digest(F.col("tokens")).alias("tokens_md5")
    )


def packed_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return summary(chunks_of(spark, sf)[0])


def token_store(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write_tokens(chunks_of(spark, sf, CHUNKS_PER_FILE)[0], path, BLOCK)
    return summary(read_tokens(spark, path))


def sequential_store(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Both halves of a text as ids without end marks, in document order, as stored token files.

    An id stands for a character, so the texts are placed and shuffled, and encoded next to the files.
    """
    ids = collect_ids(char_vocab(docs))
    halves = sequential_split(docs).withColumn("len", F.char_length("text"))
    placed = ranged_prefix_sum(halves, ["split", "doc_id"], F.col("len"), "start", wide=True)
    # The order puts all of `train` first.
    lengths = stream_lengths(halves)
    train = F.when(F.col("split") == "val", lengths.get("train", 0)).otherwise(0)
    offsets = placed.withColumn("stream_start", F.col("start") - train)
    encoded = encode_documents(text_runs(offsets, BLOCK, CHUNKS_PER_FILE, lengths), char_ids(F.col("text"), ids), None)
    path = scratch_path(spark, "sequential")
    write_tokens(packing.pack_chunks(encoded, BLOCK, CHUNKS_PER_FILE), path, BLOCK)
    return summary(read_tokens(spark, path))


def sequential_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return sequential_store(spark, documents(spark, sf).withColumn("text", F.coalesce("text", F.lit(""))))


def file_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The corpus as text files, read back by byte ranges that cut documents anywhere, split and stored as tokens."""
    folder = scratch_path(spark, "text")
    write_corpus_text(documents(spark, sf).orderBy("doc_id"), folder)
    return sequential_store(spark, read_text_ranges(spark, folder, RANGE_BYTES, PIECE_BYTES))


def stream_tokens(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as a stream, appended to a token dataset by one run over what is there."""
    target = scratch_path(spark, "stream")
    ids = collect_ids(char_vocab(clean(documents(spark, sf))))
    # A pattern, as a stream's plain path must be a folder and the table may be one file.
    docs = document_stream(spark, f"{sf}/documents.parque[t]")
    run = write_char_stream(docs, ids, len(ids), target, BLOCK, STREAM_FRACTION).trigger(availableNow=True).start()
    run.awaitTermination()
    return summary(read_token_stream(spark, target, BLOCK))


def epoch_blocks(spark: SparkSession, sf: str) -> DataFrame:
    blocks = packing.epoch_blocks(chunks_of(spark, sf)[0], BLOCK)
    return blocks.select(
        "split", "chunk_id", F.element_at("tokens", 1).alias("first_id"), F.element_at("tokens", -1).alias("last_id")
    )


def epoch_plan(spark: SparkSession, encoded: DataFrame) -> tuple[DataFrame, int]:
    """As many iterations as one pass over the training stream takes."""
    tokens = packing.stream_lengths(encoded)["train"]
    per_iteration = ACCUMULATION * BATCH * BLOCK
    return packing.batch_plan(spark, -(-tokens // per_iteration), BATCH, ACCUMULATION, RANKS), tokens


def batch_plan(spark: SparkSession, sf: str) -> DataFrame:
    encoded, _, _ = char_tokens(spark, sf)
    plan, tokens = epoch_plan(spark, encoded)
    return packing.draw_offsets(plan, "train", tokens, BLOCK)


def window_batches(spark: SparkSession, sf: str) -> DataFrame:
    chunks, encoded = chunks_of(spark, sf)
    plan, tokens = epoch_plan(spark, encoded)
    windows = packing.draw_offsets(plan, "train", tokens, BLOCK)
    cut = packing.cut_windows(windows, chunks, BLOCK, "iter", "micro_step", "rank", "slot")
    return cut.select(
        "iter", "micro_step", "rank", "slot", "offset", digest(F.col("x")).alias("x_md5"), digest(F.col("y")).alias("y_md5")
    )


def window_reads(spark: SparkSession, sf: str) -> DataFrame:
    """Like `window_batches`, but the windows are read from the stored files by seeking."""
    path = scratch_path(spark, "seek")
    chunks, encoded = chunks_of(spark, sf, CHUNKS_PER_FILE)
    write_tokens(chunks, path, BLOCK)
    plan, tokens = epoch_plan(spark, encoded)
    windows = packing.draw_offsets(plan, "train", tokens, BLOCK)
    cut = read_windows(windows, path, BLOCK, "iter", "micro_step", "rank", "slot")
    return cut.select(
        "iter", "micro_step", "rank", "slot", "offset", digest(F.col("x")).alias("x_md5"), digest(F.col("y")).alias("y_md5")
    )


def stored_range(spark: SparkSession, sf: str) -> DataFrame:
    """The second half of the stored training chunks: a filter that the source turns into byte ranges."""
    path = scratch_path(spark, "range")
    chunks, encoded = chunks_of(spark, sf, CHUNKS_PER_FILE)
    write_tokens(chunks, path, BLOCK)
    half = packing.stream_lengths(encoded)["train"] // BLOCK // 2
    return summary(read_tokens(spark, path).where((F.col("split") == "train") & (F.col("chunk_id") >= half)))


def synthetic_batch(spark: SparkSession, sf: str) -> DataFrame:
    tokens = packing.synthetic_tokens(documents(spark, sf).select("doc_id"), "doc_id", 16)
    return tokens.select("doc_id", joined(F.col("tokens")).alias("tokens"))


def metadata(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "meta")
    meta.write_metadata(meta.char_metadata(char_vocab(clean(documents(spark, sf)))), path)
    stored = meta.read_metadata(spark, path)
    sizes = meta.model_vocab_size(stored).withColumn("source", F.lit("dataset"))
    missing = meta.model_vocab_size(stored.where("false")).withColumn("source", F.lit("none"))
    spelled = stored.select(
        F.md5(F.array_join(F.transform(F.sequence(F.lit(0), F.col("vocab_size") - 1), lambda i: F.col("itos")[i]), "")).alias(
            "alphabet_md5"
        ),
        F.lit("dataset").alias("source"),
    )
    return sizes.unionByName(missing).join(F.broadcast(spelled), "source", "left")


QUERIES = {
    "packed_chunks": packed_chunks,
    "token_store": token_store,
    "sequential_tokens": sequential_tokens,
    "file_tokens": file_tokens,
    "stream_tokens": stream_tokens,
    "epoch_blocks": epoch_blocks,
    "batch_plan": batch_plan,
    "window_batches": window_batches,
    "window_reads": window_reads,
    "stored_range": stored_range,
    "synthetic_batch": synthetic_batch,
    "metadata": metadata,
}

CHUNKS = f"""SELECT split, g // {BLOCK} AS chunk_id, count(*)::INTEGER AS n_tokens,
        md5(string_agg(id::VARCHAR, ' ' ORDER BY g)) AS tokens_md5
    FROM stream GROUP BY split, g // {BLOCK}"""

PLAN = f"""total AS (SELECT count(*) AS n FROM stream WHERE split = 'train'),
    slots AS (
        SELECT unnest(generate_series(0, ((n + {ACCUMULATION * BATCH * BLOCK - 1}) // {ACCUMULATION * BATCH * BLOCK})
                                         * {ACCUMULATION * BATCH} - 1)) AS i, n FROM total),
    plan AS (
        SELECT i // {ACCUMULATION * BATCH} AS iter, (i // {RANKS * BATCH}) % {ACCUMULATION // RANKS} AS micro_step,
               (i // {BATCH}) % {RANKS} AS rank, i % {BATCH} AS slot, n FROM slots),
    windows AS (
        SELECT iter, micro_step, rank, slot, 1337 + rank AS rank_seed,
               ('0x' || substr(md5(concat_ws(':', 1337 + rank, 'train', iter, micro_step, slot)), 1, 15))::BIGINT
                 % (n - {BLOCK}) AS "offset"
        FROM plan)"""

SEQUENTIAL = f"""spots AS (
        SELECT doc_id, unnest(string_split(t, '')) AS c, generate_subscripts(string_split(t, ''), 1) AS pos FROM raw WHERE t <> ''),
    vocab AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS id FROM (SELECT DISTINCT c FROM spots)),
    placed AS (SELECT id, row_number() OVER (ORDER BY doc_id, pos) - 1 AS n, (SELECT count(*) FROM spots) AS total
               FROM spots JOIN vocab USING (c)),
    stream AS (
        SELECT CASE WHEN n < floor(0.9::DOUBLE * total) THEN 'train' ELSE 'val' END AS split, id,
               n - CASE WHEN n < floor(0.9::DOUBLE * total) THEN 0 ELSE floor(0.9::DOUBLE * total)::BIGINT END AS g
        FROM placed)
    {CHUNKS}"""

WINDOWS = f"""WITH {S.TOKEN_STREAM}, {PLAN},
        cells AS (SELECT *, unnest(generate_series(0, {BLOCK})) AS j FROM windows)
        SELECT iter, micro_step::INTEGER AS micro_step, rank::INTEGER AS rank, slot::INTEGER AS slot, "offset",
               md5(string_agg(id::VARCHAR, ' ' ORDER BY j) FILTER (j < {BLOCK})) AS x_md5,
               md5(string_agg(id::VARCHAR, ' ' ORDER BY j) FILTER (j > 0)) AS y_md5
        FROM cells JOIN stream ON g = "offset" + j AND stream.split = 'train'
        GROUP BY 1, 2, 3, 4, 5"""

ORACLE = {
    "packed_chunks": f"WITH {S.TOKEN_STREAM} {CHUNKS}",
    "token_store": f"WITH {S.TOKEN_STREAM} {CHUNKS}",
    "sequential_tokens": f"""WITH raw AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), {SEQUENTIAL}""",
    "file_tokens": f"""WITH {S.CLEAN}, raw AS (SELECT doc_id, t || chr(10) AS t FROM clean WHERE t <> ''), {SEQUENTIAL}""",
    "stored_range": f"""WITH {S.TOKEN_STREAM}, lens AS (SELECT count(*) AS n FROM stream WHERE split = 'train'),
        chunks AS ({CHUNKS})
        SELECT chunks.* FROM chunks, lens WHERE split = 'train' AND chunk_id >= n // {BLOCK} // 2""",
    "stream_tokens": f"""WITH {S.TOKENS}, splits AS (
            SELECT doc_id, k, CASE WHEN ('0x' || substr(k, 1, 15))::BIGINT / 1152921504606846976.0::DOUBLE < {STREAM_FRACTION}::DOUBLE
                                   THEN 'val' ELSE 'train' END AS split
            FROM (SELECT doc_id, md5('2357:' || doc_id) AS k FROM documents)), {S.STREAM}
        {CHUNKS}""",
    "epoch_blocks": f"""WITH {S.TOKEN_STREAM}
        SELECT split, g // {BLOCK} AS chunk_id, arg_min(id, g)::INTEGER AS first_id, arg_max(id, g)::INTEGER AS last_id
        FROM stream GROUP BY split, g // {BLOCK} HAVING count(*) = {BLOCK}""",
    "batch_plan": f"""WITH {S.TOKEN_STREAM}, {PLAN}
        SELECT iter, micro_step::INTEGER AS micro_step, rank::INTEGER AS rank, slot::INTEGER AS slot,
               rank_seed::INTEGER AS rank_seed, 'train' AS split, "offset" FROM windows""",
    "window_batches": WINDOWS,
    "window_reads": WINDOWS,
    "synthetic_batch": """
        SELECT doc_id, array_to_string([('0x' || substr(md5('1337:' || doc_id || ':' || i), 1, 15))::BIGINT % 50304
                                        for i in range(16)], ' ') AS tokens
        FROM documents""",
    "metadata": f"""WITH {S.CLEAN}, {S.VOCAB}
        SELECT count(*)::INTEGER AS vocab_size, 'dataset' AS source, md5(string_agg(c, '' ORDER BY id)) AS alphabet_md5
        FROM vocab UNION ALL SELECT 50304, 'none', NULL""",
}
