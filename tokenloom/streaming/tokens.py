"""A growing token dataset: every micro-batch of documents is appended to the token stream of its split.

A batch is encoded, split by key, ordered and packed like a table. Its state is one small file per batch,
written last: where its tokens begin in each stream and which files hold them. A batch that runs again replaces
its own state, so its tokens are never counted twice, and files of failed attempts are never read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tokenloom.functions.keys import order_key, uniform
from tokenloom.operators import packing
from tokenloom.operators.encode import char_ids, encode_documents, encode_subwords
from tokenloom.operators.vocab import Subwords
from tokenloom.session import checkpoint_dir, cut_lineage
from tokenloom.sources.documents import clean
from tokenloom.sources.tokenbin import SCHEMA, Place, Shard, open_folder, read_manifest, shared_path, write_tokens

SPLIT_SEED = 2357
# Chunks of a batch that lie in one file.
CHUNKS_PER_FILE = 1 << 16


def split_by_key(docs: DataFrame, fraction: float, key: str = "doc_id") -> DataFrame:
    """Adds `order_key` and `split`; a stream has no size, so about `fraction` of the documents are `val`, not exactly."""
    keyed = docs.withColumn("order_key", order_key(SPLIT_SEED, F.col(key)))
    return keyed.withColumn("split", F.when(uniform(F.col("order_key")) < fraction, "val").otherwise("train"))


def batch_states(target: str) -> list[dict]:
    """The states of the finished batches, in order."""
    fs, folder = open_folder(target)
    if fs.get_file_info(folder).type == pafs.FileType.NotFound:
        return []
    files = sorted(f.path for f in fs.get_file_info(pafs.FileSelector(folder)) if f.base_name.endswith(".json"))
    states = []
    for file in files:
        with fs.open_input_stream(file) as source:
            states.append(json.loads(source.read()))
    return states


def append_batch(encoded: DataFrame, batch: int, target: str, block: int) -> None:
    """Appends documents with `split`, `order_key`, `doc_id`, `ids` and `len` as micro-batch number `batch`."""
    shared_path(encoded.sparkSession, target)
    encoded = cut_lineage(encoded)
    earlier = [s for s in batch_states(target) if s["batch"] < batch]
    tokens = {k: int(v) for k, v in packing.stream_lengths(encoded).items() if v}
    starts = {split: sum(s["tokens"].get(split, 0) for s in earlier) for split in tokens}
    name = f"batch-{batch:012d}-{uuid.uuid4().hex}"
    if tokens:
        chunks = packing.pack_chunks(packing.stream_offsets(encoded), block, CHUNKS_PER_FILE)
        write_tokens(chunks, f"{target}/{name}", block)
    fs, folder = open_folder(target)
    fs.create_dir(folder, recursive=True)
    state = {"batch": batch, "folder": name, "starts": starts, "tokens": tokens}
    with fs.open_output_stream(f"{folder}/batch-{batch:012d}.json") as out:
        out.write(json.dumps(state).encode())


def write_char_stream(docs: DataFrame, vocab: dict[str, int], eos_id: int, target: str, block: int, fraction: float) -> DataStreamWriter:
    """Writer of a stream of documents as character tokens."""

    def append(rows: DataFrame, batch: int) -> None:
        append_batch(encode_documents(split_by_key(clean(rows), fraction), char_ids(F.col("text"), vocab), eos_id), batch, target, block)

    return _writer(docs, append, target)


def write_subword_stream(docs: DataFrame, model: Subwords, target: str, block: int, fraction: float) -> DataStreamWriter:
    """Writer of a stream of documents as subword tokens."""

    def append(rows: DataFrame, batch: int) -> None:
        append_batch(encode_subwords(split_by_key(rows, fraction), model), batch, target, block)

    return _writer(docs, append, target)


def _writer(docs: DataFrame, append, target: str) -> DataStreamWriter:
    progress = f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/tokens-{target.strip('/').replace('/', '-')}"
    return docs.writeStream.foreachBatch(append).option("checkpointLocation", progress)


def stream_places(target: str) -> tuple[dict[str, Place], dict[str, int]]:
    """Per split the files of all batches by their first token, and the length of the stream."""
    found: dict[str, list[tuple[int, Shard]]] = {}
    totals: dict[str, int] = {}
    for state in batch_states(target):
        for split, count in state["tokens"].items():
            totals[split] = totals.get(split, 0) + count
        if not state["tokens"]:
            continue
        block, shards = read_manifest(f"{target}/{state['folder']}")
        for s in shards:
            inside = Shard(s.split, s.first_chunk, s.tokens, f"{state['folder']}/{s.file}")
            found.setdefault(s.split, []).append((state["starts"][s.split] + s.first_chunk * block, inside))
    ordered = {split: sorted(rows, key=lambda r: r[0]) for split, rows in found.items()}
    return {split: Place([start for start, _ in rows], [s for _, s in rows], 1) for split, rows in ordered.items()}, totals


def read_token_stream(spark: SparkSession, target: str, block: int) -> DataFrame:
    """`(split, chunk_id, tokens)` of the streams as they are now; a chunk may lie in files of several batches."""
    shared_path(spark, target)
    places, totals = stream_places(target)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = open_folder(target)
        for batch in batches:
            lists = []
            for split, chunk in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parts = []
                for shard, first, count in places[split].pieces(chunk * block, min(block, totals[split] - chunk * block)):
                    with fs.open_input_file(f"{folder}/{shard.file}") as source:
                        parts.append(np.frombuffer(source.read_at(2 * count, 2 * first), "<u2").astype(np.int32))
                lists.append(np.concatenate(parts))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists, pa.list_(pa.int32()))], ["split", "chunk_id", "tokens"])

    ranges = [spark.range(-(-n // block)).select(F.lit(split).alias("split"), F.col("id").alias("chunk_id")) for split, n in sorted(totals.items())]
    if not ranges:
        return spark.createDataFrame([], SCHEMA)
    return reduce(DataFrame.unionAll, ranges).mapInArrow(read, SCHEMA)
