"""Session helpers: where state is cut, and the size of batches."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
# Bytes of a batch that Python gets: its arrays of code points and ids take some twenty times as much.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> SparkSession:
    """The session with bounded Arrow batches where they were left at Spark's default of 64 MB; a size of its own stays."""
    if spark.conf.get(BATCH_SETTING).rstrip("b") == str(64 << 20):
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the session with its file system named; a local one is made only for a local master that names none."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
            folder = tempfile.mkdtemp(prefix="tokenloom-")
        sc.setCheckpointDir(folder)
    # Spark resolves the folder against its default file system and keeps its own state in one below it.
    return sc.getCheckpointDir().rstrip("/").rsplit("/", 1)[0]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and continue from the written rows."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like `cut_lineage`, but written as a compressed table: many rows of small numbers take a fraction of the bytes."""
    path = scratch_path(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
