import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import fingerprint
from tokenloom.llm import decontam, forest, mixing, queries

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1_decontamination": ["doc_id", "item_id", "distance", "n_words", "first_word", "end_word"],
    "op2_quality": ["doc_id", "held_out", "score", "predicted"],
    "op3_secret_scan": ["doc_id", "n_assign", "n_access", "n_hex", "n_more", "base_sha256", "spans"],
    "op4_substring_dedup": ["doc_id", "n_words", "n_removed", "kept_sha256"],
    "op5_html_extraction": ["page_id", "url", "text", "n_chars"],
    "op6_embedding_neardup": ["vec_id", "n_links", "component_id", "kept"],
    "op8_jaccard_join": ["doc_id", "class_id", "n_links"],
    "op10_language": ["doc_id", "page_id", "lang", "confidence", "text_lang"],
}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_its_oracle(spark, db, name):
    ours, theirs = queries.QUERIES[name](spark, SF).toPandas(), db.execute(queries.ORACLE[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns) and len(ours) == len(theirs) > 0
    assert fingerprint(ours) == fingerprint(theirs)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, name):
    got = queries.QUERIES[name](spark, SF)
    assert got.columns == COLUMNS[name] and got.count() >= (name != "op1_decontamination")


def test_stages_of_the_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        stage(spark, kept, SF).write.parquet(f"{tmp_path}/{name}")
        kept = spark.read.parquet(f"{tmp_path}/{name}")
        assert kept.columns == columns and kept.count() > 0
        if name == "mixing":
            # All tokens are mixed and short leaves repeat, so rows may grow while tokens do not.
            held, spent = (f.agg(F.sum(mixing.tokens_of(F.col("text"))).alias("n")).first()["n"] for f in (before, kept))
            assert 0 < spent <= held
        else:
            assert kept.count() <= before.count()
        assert kept.subtract(before).count() == 0
        if name == "near_duplicates":
            assert forest.jaccard_join(kept).where("n_links > 0").count() == 0
        if name == "decontamination":
            assert decontam.contaminations(kept, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    last = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert last.columns == [*columns, *corpus_pipeline.PLACED] and last.count() == kept.count()
    assert {r.shard for r in last.collect()} == set(range(corpus_pipeline.SHARDS))


def test_pipeline_of_empty_and_odd_documents(spark, tmp_path):
    tables = {n: spark.read.parquet(f"{SF}/{n}.parquet") for n in ("labels", "benchmark", "documents")}
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "src1", 0), (2, "the and of a", None, "x", 3)], tables["documents"].schema)
    for name, docs in (("empty", tables["documents"].limit(0)), ("odd", tables["documents"].unionAll(odd).unionAll(odd))):
        for other in ("labels", "benchmark"):
            tables[other].write.parquet(f"{tmp_path}/{name}/{other}.parquet")
        docs.selectExpr("*", "'s' AS shard", "1 AS `row`", "2 AS `score.x`", "3 AS tokens", "4 AS `set`", "5 AS hits").write.parquet(f"{tmp_path}/{name}/documents.parquet")
        out = corpus_pipeline.run(spark, f"{tmp_path}/{name}")
        assert out.columns[-4:] == ["hits", "shard_", "slot", "size"]
        rows = out.collect()
        assert (rows == []) == (name == "empty") and {r["shard"] for r in rows} <= {"s"}
        assert all(0 <= r["shard_"] < corpus_pipeline.SHARDS for r in rows)
