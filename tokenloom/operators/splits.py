"""Exact-size random split, sequential split, shards and bounded samples."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.functions.keys import order_key
from tokenloom.operators.ordered import bucket_digits, hashed_cut, hashed_prefix_sum, weighted_cut
from tokenloom.session import cut_lineage

SPLIT_SEED = 2357


def random_split(docs: DataFrame, val_fraction: float, seed: int = SPLIT_SEED, key: str = "doc_id") -> DataFrame:
    """Adds `order_key` and `split`; `val` holds the ceil(fraction * n) smallest keys.

    One small aggregate over the ids and one look into a bucket find the cut key; labelling is then a plain projection.
    """
    keyed = docs.withColumn("order_key", order_key(seed, F.col(key)))
    cut = hashed_cut(keyed, "order_key", key, lambda rows: math.ceil(val_fraction * rows))
    if cut is None:
        return keyed.withColumn("split", F.lit("train"))
    in_val = cut.up_to(F.col("order_key"), F.col(key))
    return keyed.withColumn("split", F.when(in_val, "val").otherwise("train"))


def shuffled(split_docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Documents in the order of their shuffle, range-partitioned by split and key."""
    return split_docs.repartitionByRange("split", "order_key", key).sortWithinPartitions("split", "order_key", key)


def sequential_split(docs: DataFrame, train_fraction: float = 0.9, key: str = "doc_id") -> DataFrame:
    """First int(fraction * n) characters of the concatenation to `train`, the rest to `val`.

    Ids and lengths are written once, and only they are shuffled. The documents pass one
    projection, in which the document that holds the boundary is cut in two.
    """
    lengths = cut_lineage(docs.select(key, F.char_length(F.coalesce("text", F.lit(""))).alias("n")))
    total = lengths.agg(F.coalesce(F.sum(F.col("n").cast("long")), F.lit(0)).alias("t")).first()["t"]
    boundary = int(train_fraction * total)
    cut = weighted_cut(lengths, key, F.col("n"), boundary)
    body = F.coalesce(F.col("text"), F.lit(""))
    if cut is None:
        return docs.select(key, F.lit("train").alias("split"), body.alias("text"))
    position = boundary - cut.before
    here = F.col(key)
    parts = F.when(here < cut.values[0], F.array(F.struct(F.lit("train").alias("split"), body.alias("text"))))
    if position > 0:
        parts = parts.when(
            here == cut.values[0],
            F.array(
                F.struct(F.lit("train").alias("split"), F.substring(body, 1, position).alias("text")),
                F.struct(
                    F.lit("val").alias("split"),
                    F.substring(body, position + 1, 2**31 - 1 - position).alias("text"),
                ),
            ),
        )
    parts = parts.otherwise(F.array(F.struct(F.lit("val").alias("split"), body.alias("text"))))
    return docs.select(key, F.inline(parts))


def shards(split_docs: DataFrame, max_shards: int = 1024, key: str = "doc_id", always_max: bool = False) -> DataFrame:
    """Contiguous shard number of each document in its split; the first n mod k shards hold one more.

    k is min(`max_shards`, n), or `max_shards` always.
    """
    slim = split_docs.select("split", "order_key", key)
    sizes = slim.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    rows = sizes.agg(F.max("n").alias("n")).first()["n"] or 0
    indexed = hashed_prefix_sum(slim, "split", "order_key", key, F.lit(1), "row_index", bucket_digits(rows))
    count = F.lit(max_shards) if always_max else F.least(F.lit(max_shards), F.col("n"))
    small = F.floor(F.col("n") / F.col("k")).cast("long")
    longer = F.col("n") % F.col("k")
    in_longer = F.col("row_index") < longer * (small + 1)
    shard = F.when(in_longer, F.expr("row_index div (n div k + 1)")).otherwise(
        longer + F.expr("(row_index - (n % k) * (n div k + 1)) div greatest(n div k, 1)")
    )
    return (
        indexed.join(F.broadcast(sizes), "split")
        .withColumn("k", count.cast("long"))
        .select("split", key, "row_index", shard.cast("long").alias("shard"))
    )


def bounded_sample(rows: DataFrame, limit: int, seed: int, *key: str) -> DataFrame:
    """`limit` rows chosen by the smallest order keys, all of them when there are fewer."""
    keyed = rows.withColumn("order_key", order_key(seed, *[F.col(k) for k in key]))
    tie = F.struct(*[F.col(k) for k in key])
    tied = keyed.withColumn("_tie", F.to_json(tie))
    cut = hashed_cut(tied, "order_key", "_tie", limit)
    if cut is None:
        return keyed
    return tied.where(cut.up_to(F.col("order_key"), F.col("_tie"))).drop("_tie")
