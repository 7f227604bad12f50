"""Written tables between steps, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tokenloom.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a Parquet table below the shared folder, read again: later steps neither recompute nor lose it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
