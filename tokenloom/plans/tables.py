"""The given tables, and the corpus frames that several queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.operators.encode import char_ids, encode_documents
from tokenloom.operators.profile import check_id_range
from tokenloom.operators.splits import random_split
from tokenloom.operators.vocab import char_vocab, collect_ids
from tokenloom.session import small_batches
from tokenloom.sources.documents import clean, read_documents

VAL_FRACTION = 0.005
BLOCK = 1024
BATCH = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return small_batches(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_documents(spark, f"{sf_dir}/documents.parquet")


def documents_with(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def char_tokens(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, int], int]:
    """Split and character-encoded documents, the vocabulary, and the end-of-text id after it.

    Stripped length plus one is the token count, so `len` needs no encoded array.
    """
    docs = clean(documents(spark, sf_dir))
    vocab = collect_ids(char_vocab(docs))
    eos = len(vocab)
    labelled = random_split(docs, VAL_FRACTION)
    length = F.when(F.col("text") != "", F.char_length("text") + 1).otherwise(0)
    measured = labelled.withColumn("n", length)
    encoded = encode_documents(measured, char_ids(F.col("text"), vocab), eos)
    return check_id_range(encoded.drop("len").withColumnRenamed("n", "len")), vocab, eos
