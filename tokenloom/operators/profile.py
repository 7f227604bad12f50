"""Corpus and split statistics: one aggregate each, combined before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.functions.lookup import ID_LIMIT


def corpus_profile(docs: DataFrame) -> DataFrame:
    """Rows, written documents, their characters, and the size of the corpus file in MB."""
    body = T.strip(F.col("text"))
    written = body != ""
    return docs.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.count_if(written).alias("docs_written"),
        F.coalesce(F.sum(F.when(written, F.char_length(body)).cast("long")), F.lit(0)).alias("total_chars"),
        (F.coalesce(F.sum(F.when(written, F.octet_length(body) + 1).cast("long")), F.lit(0)) / (1024.0 * 1024.0)).alias(
            "corpus_mb"
        ),
    )


def split_token_stats(encoded: DataFrame) -> DataFrame:
    """Rows, tokens, average tokens per document and packed size of each split."""
    total = F.coalesce(F.sum(F.col("len").cast("long")), F.lit(0))
    return encoded.groupBy("split").agg(
        F.count(F.lit(1)).alias("num_rows"),
        total.alias("total_tokens"),
        F.coalesce(F.avg("len"), F.lit(0.0)).alias("avg_tokens"),
        (total * 2 / (1024.0**3)).alias("stream_gb"),
    )


def check_id_range(encoded: DataFrame, limit: int = ID_LIMIT) -> DataFrame:
    """Fail the job at the first id that 16 bits cannot hold."""
    largest = F.array_max("ids")
    return encoded.withColumn(
        "ids",
        F.when(
            largest >= limit, F.raise_error(F.concat(F.lit("token id out of range: "), largest.cast("string")))
        ).otherwise(F.col("ids")),
    )
