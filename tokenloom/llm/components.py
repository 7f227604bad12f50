"""Connected components of a link table, by alternating star contraction.

Large-star hangs every larger neighbour of a vertex on its smallest neighbour, small-star every
smaller one. The links stay as many at most, the number of rounds grows with the logarithm of the
longest chain, and a round is one pre-aggregated minimum and one join. Every round is checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.session import cut_lineage


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(`vertex`, `root`) for every vertex of a link that is not the smallest of its component; `root` is that smallest."""
    ordered = links.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("high"), F.least(left, right).alias("low")
    )
    edges = cut_lineage(ordered.distinct())
    state = None
    while True:
        now = edges.agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)")).alias("digest")
        ).first()
        if now == state or not now["n"]:
            return edges.select(F.col("high").alias("vertex"), F.col("low").alias("root"))
        state = now
        edges = cut_lineage(_small_star(_large_star(edges)))


# The minima are written, so that a round's join reads two plain shuffles: Spark splits the large partition of a hub.


def _large_star(edges: DataFrame) -> DataFrame:
    """Larger neighbours go to the smallest neighbour; `high` > `low` in every edge."""
    both = edges.select(F.col("high").alias("at"), F.col("low").alias("to")).unionAll(
        edges.select(F.col("low").alias("at"), F.col("high").alias("to"))
    )
    least = both.groupBy("at").agg(F.least(F.min("to"), F.col("at")).alias("least"))
    least = cut_lineage(least)
    larger = edges.select(F.col("low").alias("at"), F.col("high").alias("to"))
    return larger.join(least, "at").select(F.col("to").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Smaller neighbours, and the vertex itself, go to the smallest one."""
    least = cut_lineage(edges.groupBy(F.col("high").alias("at")).agg(F.min("low").alias("least")))
    moved = edges.withColumnRenamed("high", "at").join(least, "at").select(F.col("low").alias("high"), F.col("least").alias("low"))
    own = least.select(F.col("at").alias("high"), F.col("least").alias("low"))
    return moved.unionAll(own).where(F.col("high") != F.col("low")).distinct()
