import pyarrow as pa
from pyspark.sql import functions as F

from tokenloom.session import BATCH_BYTES, BATCH_SETTING
from tokenloom.sources.documents import read_documents


def largest_batch(docs):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    return docs.mapInArrow(sizes, "n long").agg(F.max("n").alias("n")).first()["n"]


def test_documents_reach_python_in_small_batches(spark, tmp_path):
    spark.conf.unset(BATCH_SETTING)
    rows = spark.range(0, 2000, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 10_000).alias("text"))
    rows.write.parquet(f"{tmp_path}/d")
    assert largest_batch(read_documents(spark, f"{tmp_path}/d").coalesce(1)) < 2 * BATCH_BYTES


def test_a_size_of_the_session_stays(spark, tmp_path):
    spark.conf.set(BATCH_SETTING, "1m")
    spark.range(1).select(F.col("id").alias("doc_id"), F.lit("x").alias("text")).write.parquet(f"{tmp_path}/d")
    read_documents(spark, f"{tmp_path}/d").count()
    assert spark.conf.get(BATCH_SETTING) == "1m"
    spark.conf.unset(BATCH_SETTING)
