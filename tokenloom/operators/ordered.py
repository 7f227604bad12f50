"""Positions in a global order, without a window over one whole group.

Rows are cut into contiguous runs of the order, each run is numbered on its own, and the
totals of the runs before it are added. Only the run totals meet in one window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.functions.lookup import constant_array, count_at_most, count_in
from tokenloom.session import cut_lineage

# Hexadecimal digits of an md5 key that name its bucket, and the most buckets that gives.
BUCKET = "order_bucket"
BUCKET_DIGITS = 3
MAX_BUCKET_DIGITS = 4
ROWS_PER_BUCKET = 20_000
# Most bucket totals that are sent to every task.
BROADCAST_TOTALS = 1 << 20
# Rows below which a range of an order is not cut further.
ROWS_PER_PART = 20_000
# Weight of the wide rows of a part, which one window holds.
WEIGHT_PER_PART = 8 << 20


def bucket_digits(rows: int) -> int:
    """Digits that keep a bucket of uniform keys near `ROWS_PER_BUCKET`, within the broadcast bound."""
    return MAX_BUCKET_DIGITS if rows > ROWS_PER_BUCKET * 16**BUCKET_DIGITS else BUCKET_DIGITS


def hashed_prefix_sum(
    df: DataFrame, group: str, key: str, tie: str, weight: Column, name: str, digits: int = BUCKET_DIGITS, keep_bucket: bool = False
) -> DataFrame:
    """Sum of `weight` over the rows before this one in (`key`, `tie`) order, per `group`.

    `key` is an md5 key, so its leading digits cut the order into even buckets. Only bucket
    totals (at most 16^digits per group) are broadcast; beyond `BROADCAST_TOTALS` of them they are joined by key.
    With `keep_bucket` the rows keep their `BUCKET` and stay partitioned by group and bucket.
    A bucket is one task's window, so a group of more than about 10^12 rows asks for more digits than there are.
    """
    if digits > MAX_BUCKET_DIGITS:
        raise ValueError("too many buckets to broadcast")
    weighted = df.withColumn("_bucket", F.substring(key, 1, digits)).withColumn("_weight", weight.cast("long"))
    totals = weighted.groupBy(group, "_bucket").agg(F.sum("_weight").alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(group, "_bucket", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    bases = cut_lineage(bases)
    inside = Window.partitionBy(group, "_bucket").orderBy(key, tie).rowsBetween(Window.unboundedPreceding, -1)
    return (
        weighted.withColumn("_local", F.coalesce(F.sum("_weight").over(inside), F.lit(0)))
        .join(F.broadcast(bases) if bases.count() <= BROADCAST_TOTALS else bases, [group, "_bucket"])
        .withColumn(name, F.col("_base") + F.col("_local"))
        .withColumnRenamed("_bucket", BUCKET if keep_bucket else "_bucket")
        .drop("_bucket", "_weight", "_total", "_base", "_local")
    )


def ranged(df: DataFrame, order: Sequence[str], parts: int | None = None) -> DataFrame:
    """Rows with `_part`, the number of their contiguous run in `order`.

    Spark's range partitioner samples the whole order, so a hot leading key is cut into as
    many runs as its share of the rows asks for. The sampled cuts differ between runs of a
    plan, therefore the rows are written once and read from there.
    """
    if parts is None:
        most = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        parts = min(most, df.count() // ROWS_PER_PART + 1)
    return cut_lineage(df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))


def ranged_prefix_sum(df: DataFrame, order: Sequence[str], weight: Column, name: str, wide: bool = False) -> DataFrame:
    """Sum of `weight` over all rows before this one; `order` must be unique.

    The rows of a part are written with its number. `wide` ones, whose weight is about their size, are read again instead:
    only their order and weight are written, and the parts, of about `WEIGHT_PER_PART` each, are told by their first rows.
    """
    if wide:
        return _wide_prefix_sum(df, order, weight, name)
    cut = ranged(df.withColumn("_weight", weight.cast("long")), order)
    totals = cut.groupBy("_part").agg(F.sum("_weight").alias("_total"))
    # One row per part: as many as the range shuffle was told to make.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    return (
        cut.withColumn("_local", _weight_before(order))
        .join(F.broadcast(bases), "_part")
        .withColumn(name, F.col("_base") + F.col("_local"))
        .drop("_part", "_weight", "_base", "_local")
    )


def _weight_before(order: Sequence[str]) -> Column:
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("_weight").over(inside), F.lit(0))


def _wide_prefix_sum(df: DataFrame, order: Sequence[str], weight: Column, name: str) -> DataFrame:
    weighted = df.withColumn("_weight", weight.cast("long"))
    slim = cut_lineage(weighted.select(*order, "_weight"))
    sums = slim.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("_weight"), F.lit(0)).alias("w")).first()
    # The parts are told by constants of the plan, so their number is bounded.
    most = 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cut = ranged(slim, order, min(most, max(sums["n"] // ROWS_PER_PART, sums["w"] // WEIGHT_PER_PART) + 1))
    parts = cut.groupBy("_part").agg(F.min(F.struct(*order)).alias("first"), F.sum("_weight").alias("total")).orderBy("_part").collect()
    bases, total = [], 0
    for part in parts:
        bases.append(total)
        total += part["total"] or 0
    # Structs compare like the sort, nulls first. Rows of one order lie in one part.
    types = {f.name: f.dataType for f in slim.schema.fields}
    firsts = [F.struct(*[F.lit(part["first"][c]).cast(types[c]).alias(c) for c in order]) for part in parts[1:]]
    number = count_in(F.array(*firsts), len(firsts), F.struct(*order)) if firsts else F.lit(0)
    return (
        weighted.withColumn("_part", number.cast("int"))
        .withColumn("_local", _weight_before(order))
        .withColumn(name, F.get(constant_array(bases or [0], "long"), F.col("_part")) + F.col("_local"))
        .drop("_part", "_weight", "_local")
    )


def row_numbers(df: DataFrame, group: str, order: Sequence[str], name: str) -> DataFrame:
    """Row number from 1 within `group`; `order` must be unique inside it.

    The totals table has at most one row per group and one more per part.
    """
    cut = ranged(df, [group, *order])
    totals = cut.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_total"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(group, "_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_base"))
    inside = Window.partitionBy(group, "_part").orderBy(*order)
    return (
        cut.withColumn("_local", F.row_number().over(inside))
        .join(bases, [group, "_part"])
        .withColumn(name, F.col("_base") + F.col("_local"))
        .drop("_part", "_base", "_local")
    )


@dataclass(frozen=True)
class Cut:
    """The row at which a running total reaches a target: its order values, and the total before it."""

    values: tuple
    before: int

    def up_to(self, *columns: Column) -> Column:
        """Rows up to and including the cut row, in the order of `columns`."""
        condition = F.lit(True)
        for column, value in reversed(list(zip(columns, self.values))):
            condition = (column < F.lit(value)) | ((column == F.lit(value)) & condition)
        return condition


def hashed_cut(df: DataFrame, key: str, tie: str, rank: int | Callable[[int], int]) -> Cut | None:
    """The row of rank `rank` (from 1) in (`key`, `tie`) order, if there is one; `key` is an md5 key.

    `rank` may depend on the number of rows, which the bucket totals hold.
    """
    slim = df.select(key, tie).withColumn("_bucket", F.substring(key, 1, MAX_BUCKET_DIGITS))
    totals = slim.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_total"))
    if callable(rank):
        totals = cut_lineage(totals)
        rank = rank(totals.agg(F.coalesce(F.sum("_total"), F.lit(0)).alias("n")).first()["n"])
    if rank < 1:
        return None
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    hit = (
        totals.withColumn("_through", F.sum("_total").over(running))
        .where(F.col("_through") >= rank)
        .orderBy("_bucket")
        .first()
    )
    if hit is None:
        return None
    before = hit["_through"] - hit["_total"]
    row = slim.where(F.col("_bucket") == hit["_bucket"]).orderBy(key, tie).offset(rank - before - 1).first()
    return Cut((row[key], row[tie]), rank - 1)


def weighted_cut(df: DataFrame, order: str, weight: Column, target: int, buckets: int = 4096) -> Cut | None:
    """The row whose span [before, before + weight) holds position `target`; `order` is a unique number.

    Buckets end at sampled quantiles of `order`, so that sparse or clustered numbers fill them evenly.
    """
    slim = df.select(F.col(order).alias("_order"), weight.cast("long").alias("_weight"))
    fractions = constant_array([i / buckets for i in range(1, buckets)], "double")
    ends = slim.agg(F.percentile_approx("_order", fractions, 10 * buckets).alias("ends")).first()["ends"]
    if not ends:
        return None
    slim = slim.withColumn("_bucket", count_at_most(sorted(set(ends)), "long", F.col("_order")))
    totals = slim.groupBy("_bucket").agg(F.sum("_weight").alias("_total"))
    running = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    hit = (
        totals.withColumn("_through", F.sum("_total").over(running))
        .where(F.col("_through") > target)
        .orderBy("_bucket")
        .first()
    )
    if hit is None:
        return None
    base = hit["_through"] - hit["_total"]
    inside = Window.partitionBy("_bucket").orderBy("_order").rowsBetween(Window.unboundedPreceding, 0)
    row = (
        slim.where(F.col("_bucket") == hit["_bucket"])
        .withColumn("_end", F.sum("_weight").over(inside) + F.lit(base))
        .where(F.col("_end") > target)
        .orderBy("_order")
        .first()
    )
    return Cut((row["_order"],), row["_end"] - row["_weight"])
