"""Document collections: scan, whole-text scan and corpus text sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.session import small_batches


def read_documents(spark: SparkSession, path: str, fmt: str = "parquet", key: str = "doc_id") -> DataFrame:
    """`key` and `text` of a parquet or JSON collection; nothing else is read.

    A text directory has no key: its rows are keyed by file and line with `read_whole_text`.
    """
    return small_batches(spark).read.format(fmt).load(path).select(key, "text")


def read_whole_text(spark: SparkSession, path: str) -> DataFrame:
    """One row per file of a directory, keyed by file name: the corpus is their concatenation in key order."""
    return spark.read.text(path, wholetext=True).select(
        F.input_file_name().alias("doc_id"), F.col("value").alias("text")
    )


def clean(docs: DataFrame) -> DataFrame:
    """Text stripped; empty documents stay."""
    return docs.withColumn("text", T.strip(F.col("text")))


def write_corpus_text(docs: DataFrame, path: str) -> None:
    """Stripped non-empty documents, each closed by a newline, as a directory of text files."""
    clean(docs).where(F.col("text") != "").select("text").write.mode("errorifexists").text(path)


def read_corpus_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a corpus directory, split at `\\n` only."""
    return spark.read.option("lineSep", "\n").text(path).select(F.col("value").alias("line"))


def sentences(docs: DataFrame, max_bytes: int = 16384) -> DataFrame:
    """Non-empty lines of the stripped documents, no longer than `max_bytes` bytes."""
    lines = clean(docs).select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    return lines.where((F.col("line") != "") & (F.octet_length("line") <= max_bytes))
