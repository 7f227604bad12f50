import glob
import os

import duckdb
import pytest

import __spark_entry__ as spark_entry
from check_oracle import fingerprint
from tokenloom.operators.encode import char_ids, encode_documents
from tokenloom.operators.vocab import char_vocab, collect_ids
from tokenloom.plans import catalog
from tokenloom.sources.documents import clean
from tokenloom.streaming.encode import document_stream, encode_stream

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    connection.execute("SET memory_limit = '4GB'; SET max_temp_directory_size = '1GB'")
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_oracle_has_a_query():
    assert set(spark_entry.oracle_sql()) <= set(spark_entry.queries())


def test_entry(spark):
    assert {r.split for r in spark_entry.entry(spark).collect()} == {"train", "val"}


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_equals_its_oracle(spark, db, name):
    ours = spark_entry.queries()[name](spark, SF).toPandas()
    theirs = db.execute(spark_entry.oracle_sql()[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert len(ours) == len(theirs) > 0
    assert fingerprint(ours) == fingerprint(theirs)


def test_stream_encodes_like_a_table(spark, docs, tmp_path):
    frame = docs("ab", " b ", "")
    ids = collect_ids(char_vocab(clean(frame)))
    frame.write.parquet(f"{tmp_path}/in")
    query = encode_stream(document_stream(spark, f"{tmp_path}/in"), ids, len(ids), f"{tmp_path}/out")
    query.trigger(availableNow=True).start().awaitTermination(120)
    from pyspark.sql import functions as F

    table = encode_documents(clean(frame), char_ids(F.col("text"), ids), len(ids))
    assert sorted(spark.read.parquet(f"{tmp_path}/out").collect()) == sorted(table.collect())
