"""The document expressions are stateless, so a stream of documents is encoded like a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tokenloom.operators.encode import char_ids, encode_documents
from tokenloom.session import checkpoint_dir, small_batches
from tokenloom.sources.documents import clean


def document_stream(spark: SparkSession, path: str) -> DataFrame:
    """New parquet files of documents below `path`."""
    return small_batches(spark).readStream.schema("doc_id long, text string").parquet(path)


def encode_stream(docs: DataFrame, vocab: dict[str, int], eos_id: int, target: str) -> DataStreamWriter:
    """Writer of `(doc_id, ids, len)` parquet files; each document is written once."""
    encoded = encode_documents(clean(docs), char_ids(F.col("text"), vocab), eos_id)
    progress = f"{checkpoint_dir(docs.sparkSession).rstrip('/')}/stream-{target.strip('/').replace('/', '-')}"
    return encoded.writeStream.format("parquet").option("path", target).option("checkpointLocation", progress)
