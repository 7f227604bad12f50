"""Nearest rows of another table by a number: a merge of two sorted tables whose carried rows cross partition borders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tokenloom.operators.ordered import ranged
from tokenloom.session import cut_lineage


def nearest(queries: DataFrame, points: DataFrame, at: str, value: str, tie: str, name: str) -> DataFrame:
    """`queries` with `name`, the row of `points` whose `value` is closest to `at`, as a struct.

    Of equally close points the one with the least `tie` is taken. Null values are nobody's neighbour: a query
    without `at`, or any query of no points, gets null. Both tables are range-partitioned together; a part hands its
    first and last point on, so only one row per part is seen by all, and neither table needs to be small.
    """
    firsts = points.where(F.col(value).isNotNull()).groupBy(value).agg(F.min_by(F.struct(*points.columns), tie).alias("_point"))
    empty = F.lit(None).cast(firsts.schema["_point"].dataType)
    asked = queries.where(F.col(at).isNotNull())
    row = F.struct(*queries.columns)
    # Points go before queries of the same value; the hash spreads equal queries over parts.
    merged = firsts.select(
        F.col(value).cast("double").alias("_value"), F.lit(0).alias("_kind"), F.lit(0).cast("long").alias("_tie"), "_point",
        F.lit(None).cast(asked.select(row.alias("r")).schema["r"].dataType).alias("_query"),
    ).unionByName(
        asked.select(
            F.col(at).cast("double").alias("_value"), F.lit(1).alias("_kind"), F.xxhash64(row).alias("_tie"),
            empty.alias("_point"), row.alias("_query"),
        )
    )
    cut = ranged(merged, ["_value", "_kind", "_tie"])
    ends = cut_lineage(
        cut.where(F.col("_kind") == 0)
        .groupBy("_part")
        .agg(F.max_by("_point", "_value").alias("_last"), F.min_by("_point", "_value").alias("_first"))
    )
    parts = cut.select("_part").distinct().join(ends, "_part", "left")
    # One row per part.
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.orderBy(F.desc("_part")).rowsBetween(Window.unboundedPreceding, -1)
    borders = parts.select(
        "_part",
        F.last("_last", ignorenulls=True).over(earlier).alias("_before"),
        F.last("_first", ignorenulls=True).over(later).alias("_after"),
    )
    up = Window.partitionBy("_part").orderBy("_value", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("_part").orderBy(F.desc("_value"), F.desc("_kind")).rowsBetween(Window.unboundedPreceding, 0)
    seen = cut.withColumn("_below", F.last("_point", ignorenulls=True).over(up)).withColumn(
        "_above", F.last("_point", ignorenulls=True).over(down)
    )
    placed = seen.where(F.col("_kind") == 1).join(F.broadcast(borders), "_part")

    def gap(point):
        distance = F.abs(point[value].cast("double") - F.col("_value"))
        return F.when(point.isNotNull(), F.struct(distance.alias("gap"), point[tie].alias("tie"), point.alias("point")))

    both = F.filter(
        F.array(gap(F.coalesce("_below", "_before")), gap(F.coalesce("_above", "_after"))), lambda g: g.isNotNull()
    )
    best = F.reduce(
        both,
        F.get(both, 0),
        lambda a, b: F.when(F.struct(b["gap"], b["tie"]) < F.struct(a["gap"], a["tie"]), b).otherwise(a),
    )
    found = placed.select("_query.*", best["point"].alias(name))
    return found.unionByName(queries.where(F.col(at).isNull()).withColumn(name, empty))
