"""The corpus pipeline: quality, near duplicates, benchmark passages, source mix, shards.

Every stage reads the documents that the one before it has written. Each of them calls one operator
of `tokenloom.llm`, whose docstring says what it does with nulls, empty texts, ties and repeated rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tokenloom.llm import decontam, forest, mixing, quality, shards
from tokenloom.llm.storage import written

SHARDS = 16
# Columns of the last stage beside those of the documents; where one is taken, ours gets underscores behind it.
PLACED = ["shard", "slot", "size"]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near duplicates: five words a shingle, similarity 0.8 or more."""
    return forest.drop_near_duplicates(docs)


def clean_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage near an item of the benchmark."""
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, by the weights of domain, language and source; a short leaf's documents may repeat."""
    return mixing.mix(docs, mixing.domain_of(F.col("source")), mixing.MIX_WEIGHTS, mixing.MIX_SHARE).select("row.*")


def sharded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard of nearly equal bytes, their place in it and their size."""
    names = [F.col(c).alias(free_name(c, docs.columns)) for c in PLACED]
    return shards.assign_shards(docs, SHARDS).select("row.*", *names)


def free_name(name: str, taken: list[str]) -> str:
    """`name`, with as many underscores behind it as make it differ from all of `taken`."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("decontamination", clean_documents),
    ("mixing", mixed_documents),
    ("sharding", sharded_documents),
]

# A classifier, near duplicates and edit distances are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; every stage's documents are written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
