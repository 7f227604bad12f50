"""Training log lines and JSON columns as typed rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The two log line formats.
ITER_FORMAT = "iter %d: loss %.4f, time %.2fms, mfu %.2f%%"
STEP_FORMAT = "step %d: train loss %.4f, val loss %.4f"
NUMBER = r"(-?[0-9]+\.[0-9]+|nan)"
ITER_PATTERN = rf"^iter ([0-9]+): loss {NUMBER}, time {NUMBER}ms, mfu {NUMBER}%$"
STEP_PATTERN = rf"^step ([0-9]+): train loss {NUMBER}, val loss {NUMBER}$"


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select(F.col("value").alias("line"))


def _fields(lines: DataFrame, pattern: str, names: list[str]) -> DataFrame:
    hits = lines.where(F.col("line").rlike(pattern))
    first, *rest = names
    return hits.select(
        F.regexp_extract("line", pattern, 1).cast("long").alias(first),
        *[F.regexp_extract("line", pattern, i).cast("double").alias(n) for i, n in enumerate(rest, 2)],
    )


def iteration_rows(lines: DataFrame) -> DataFrame:
    """`(iter, loss, time_ms, mfu_pct)`; other lines are dropped."""
    return _fields(lines, ITER_PATTERN, ["iter", "loss", "time_ms", "mfu_pct"])


def evaluation_rows(lines: DataFrame) -> DataFrame:
    """`(step, train_loss, val_loss)`; other lines are dropped."""
    return _fields(lines, STEP_PATTERN, ["step", "train_loss", "val_loss"])


def json_rows(rows: DataFrame, column: str, fields: list[str]) -> DataFrame:
    """A JSON array of numeric arrays to one typed row per inner array."""
    kept = [c for c in rows.columns if c != column]
    listed = rows.select(*kept, F.posexplode(F.from_json(F.col(column), "array<array<double>>")).alias("position", "_v"))
    return listed.select(*kept, "position", *[F.get("_v", F.lit(i)).alias(f) for i, f in enumerate(fields)])
