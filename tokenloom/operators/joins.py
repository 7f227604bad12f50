"""Joins against model tables whose size is checked first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tokenloom.session import cut_lineage

# Values that a broadcast side may hold.
BROADCAST_VALUES = 4_000_000
# A key with more than one in `PIECES` rows is heavy; it is cut into pieces of about that share.
PIECES = 1024
# Keys that the sketch follows. Its counts are too high by at most one in 6,000 rows, so it misses no heavy key
# and names fewer than 2 * PIECES.
TRACKED = 16_384


def fits_broadcast(values: int, most_values: int | None = None) -> bool:
    return values <= (BROADCAST_VALUES if most_values is None else most_values)


def heavy_keys(rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """(`_key`, `_pieces`) of the keys of `rows` that are to be spread: at most 2 * `PIECES`, found by a mergeable sketch.

    Written, as the sketch may differ between executions. `_key` is a hash: keys that share it are spread alike.
    """
    keys = rows.select(F.xxhash64(*on).alias("_key"))
    # One row per task is shuffled.
    counted = keys.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_key, {2 * PIECES}, {TRACKED})").alias("top"))
    listed = counted.select("n", F.inline("top"))
    pieces = F.least(F.ceil(F.col("count") * PIECES / F.col("n")), F.col("count")).cast("int")
    return cut_lineage(listed.select(F.col("item").alias("_key"), pieces.alias("_pieces")).where(F.col("_pieces") > 1))


def lookup_join(
    rows: DataFrame,
    model: DataFrame,
    on: Sequence[str],
    values: int,
    spread_by: str,
    counted: DataFrame | None = None,
    most_values: int | None = None,
) -> DataFrame:
    """Left join of many `rows` to a `model` table with `values` values and unique keys.

    A small model is broadcast. For a larger one the heavy keys of `rows` are spread on both sides: their rows by the
    hash of `spread_by`, their model rows by copies, fewer than 3 * `PIECES` in all. The rest is joined plainly, each row once.
    `counted` holds the same keys where `rows` would be computed anew to count them. Null keys find nothing.
    """
    if fits_broadcast(values, most_values):
        return rows.join(F.broadcast(model), list(on), "left")
    heavy = F.broadcast(heavy_keys(rows if counted is None else counted, on))
    key = F.xxhash64(*on).alias("_key")
    piece = F.when(F.col("_pieces").isNull(), 0).otherwise(F.pmod(F.xxhash64(spread_by), F.col("_pieces"))).cast("int")
    spread = rows.select("*", key).join(heavy, "_key", "left").withColumn("_salt", piece).drop("_key", "_pieces")
    copies = model.select("*", key).join(heavy, "_key", "left").drop("_key")
    numbers = F.sequence(F.lit(0), F.coalesce("_pieces", F.lit(1)) - 1)
    copies = copies.withColumn("_salt", F.explode(numbers)).drop("_pieces")
    return spread.join(copies, [*on, "_salt"], "left").drop("_salt")
