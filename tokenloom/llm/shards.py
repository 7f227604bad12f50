"""Contiguous shards of nearly equal bytes, from prefix sums over per-partition totals.

Rows are range-partitioned on their order, the byte totals of the partitions are summed up in
that order, and a row's global position is the total before its partition plus the sum inside
it. Equal targets of the whole size cut the order: a row belongs to the shard whose target
range holds the middle of its bytes, so a border is at most half a document away from its target.

* Order: `order` columns (nulls first), then CRC and size of the text, then the input position, so repeated
  rows and one hot key are cut like any others.
* Null or empty text has size 1 and CRC 0. An empty table gives an empty result.
* A row larger than a target leaves the shards that it spans empty; nothing is cut inside a row.
* The input's own columns stay inside one struct, so none of their names can clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.functions.lookup import count_at_most
from tokenloom.llm.storage import written
from tokenloom.session import cut_lineage

ROWS_PER_PART = 20_000
# One row of totals per part is broadcast.
MOST_PARTS = 100_000


def text_size(text: Column) -> Column:
    """UTF-8 bytes of a text and one for its end."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long")


def text_crc(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def assign_shards(docs: DataFrame, shards: int, text: str = "text", order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(`row`, `size`, `crc`, `shard`, `slot`) of every row; `row` holds the input's columns, `slot` counts from 0 in a shard.

    Select the columns that `row` should carry first: they travel through the range shuffle.
    """
    if shards < 1:
        raise ValueError("at least one shard is needed")
    rows = docs.select(
        F.struct("*").alias("row"),
        F.struct(*[docs[c] for c in order]).alias("key"),
        text_size(docs[text]).alias("size"),
        text_crc(docs[text]).alias("crc"),
    )
    return _cut(rows, shards)


def manifest(docs: DataFrame, shards: int, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(`doc_id`, `size`, `crc`, `shard`, `slot`): the assignment without the texts."""
    slim = docs.select(
        docs[doc_id].alias("doc_id"), text_size(docs[text]).alias("size"), text_crc(docs[text]).alias("crc")
    )
    rows = written(slim, "sizes").select(
        F.struct("doc_id").alias("row"), F.struct("doc_id").alias("key"), "size", "crc"
    )
    return _cut(rows, shards).select("row.doc_id", "size", "crc", "shard", "slot")


def write_shards(docs: DataFrame, path: str, shards: int, text: str = "text", order: Sequence[str] = ("doc_id",)) -> None:
    """Parquet files below `path`, one folder per shard; `row` holds the input's columns."""
    assign_shards(docs, shards, text, order).write.partitionBy("shard").parquet(path)


def _cut(rows: DataFrame, shards: int) -> DataFrame:
    whole = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    parts = min(MOST_PARTS, whole["rows"] // ROWS_PER_PART + 1)
    tied = rows.withColumn("tie", F.monotonically_increasing_id())
    order = ["key", "crc", "size", "tie"]
    # The partitioner samples its cuts, so the partitions are written before anything is summed.
    cut = cut_lineage(tied.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()))

    totals = cut.groupBy("part").agg(F.sum("size").alias("part_bytes"), F.count(F.lit(1)).alias("part_rows"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select(
        "part",
        F.coalesce(F.sum("part_bytes").over(earlier), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("part_rows").over(earlier), F.lit(0)).alias("rows_before"),
    )
    inside = Window.partitionBy("part").orderBy(*order)
    middle = 2 * (F.col("bytes_before") + F.col("through")) - F.col("size")
    targets = [-(-2 * whole["bytes"] * i // shards) for i in range(1, shards)]
    placed = (
        cut.withColumn("through", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("local", F.row_number().over(inside))
        .join(F.broadcast(bases), "part")
        .withColumn("place", F.col("rows_before") + F.col("local") - 1)
        .withColumn("shard", count_at_most(targets, "long", middle).cast("int"))
        .select("row", "size", "crc", "shard", "place")
    )
    # One row per shard, as many as asked for.
    firsts = placed.groupBy("shard").agg(F.min("place").alias("first_place"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "row", "size", "crc", "shard", (F.col("place") - F.col("first_place")).alias("slot")
    )
