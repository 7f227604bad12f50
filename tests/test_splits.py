import math

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import ordered, splits
from tokenloom.operators.ordered import (
    bucket_digits,
    hashed_prefix_sum,
    ranged_prefix_sum,
    row_numbers,
    weighted_cut,
)


@pytest.mark.parametrize("n", [1, 7, 200])
@pytest.mark.parametrize("fraction", [0.005, 0.0005, 0.3])
def test_random_split_has_the_exact_size(spark, n, fraction):
    ids = spark.range(n).withColumnRenamed("id", "doc_id")
    sizes = {r.split: r["count"] for r in splits.random_split(ids, fraction).groupBy("split").count().collect()}
    assert sizes.get("val", 0) == math.ceil(fraction * n)
    assert sum(sizes.values()) == n


def test_random_split_of_a_published_corpus_size(spark):
    ids = spark.range(8_013_769).withColumnRenamed("id", "doc_id")
    sizes = {r.split: r["count"] for r in splits.random_split(ids, 0.0005).groupBy("split").count().collect()}
    assert sizes == {"train": 8_009_762, "val": 4_007}


def test_random_split_ignores_the_partitioning(spark):
    ids = spark.range(500).withColumnRenamed("id", "doc_id")
    chosen = [
        {r.doc_id for r in splits.random_split(ids.repartition(k), 0.05).where("split = 'val'").collect()} for k in (1, 7, 32)
    ]
    assert chosen[0] == chosen[1] == chosen[2]


@pytest.mark.parametrize("texts", [["abcde", "fghij"], ["a", "bcdefghijklmnopqrst"], ["", None, "xy", "z" * 17]])
@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 0.9, 1.0])
@pytest.mark.parametrize("gap", [1, 10**15])
def test_sequential_split_cuts_the_concatenation(spark, texts, fraction, gap):
    frame = spark.createDataFrame([(i * i * gap, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = splits.sequential_split(frame, fraction).orderBy("doc_id", "split").collect()
    whole = "".join(t or "" for t in texts)
    cut = int(fraction * len(whole))
    assert "".join(r.text for r in rows if r.split == "train") == whole[:cut]
    assert "".join(r.text for r in rows if r.split == "val") == whole[cut:]


def test_sequential_split_of_a_published_length(spark):
    lengths = spark.range(1000).select(F.col("id"), F.lit(1115).alias("n")).union(
        spark.createDataFrame([(1000, 394)], "id long, n int")
    )
    boundary = int(0.9 * 1_115_394)
    cut = weighted_cut(lengths, "id", F.col("n"), boundary)
    assert boundary == 1_003_854 and 1_115_394 - boundary == 111_540
    assert cut.values[0] == boundary // 1115 and cut.before == boundary // 1115 * 1115


@pytest.mark.parametrize("n", [0, 3, 10, 1025])
def test_shards_are_contiguous_and_even(spark, n):
    ids = spark.range(n).withColumnRenamed("id", "doc_id")
    labelled = splits.random_split(ids, 0.0) if n else ids.selectExpr("doc_id", "'' order_key", "'train' split")
    rows = splits.shards(labelled).orderBy("row_index").collect()
    k = min(1024, n)
    sizes = [0] * k
    for r in rows:
        sizes[r.shard] += 1
    assert [r.shard for r in rows] == sorted(r.shard for r in rows)
    assert sizes == [n // k + (i < n % k) for i in range(k)] if k else rows == []


def test_shards_beyond_the_rows_stay_empty(spark):
    ids = splits.random_split(spark.range(3).withColumnRenamed("id", "doc_id"), 0.0)
    assert sorted(r.shard for r in splits.shards(ids, 8, always_max=True).collect()) == [0, 1, 2]


def test_bounded_sample(spark):
    rows = spark.range(300).select(F.col("id").alias("doc_id"), F.lit(0).alias("line_no"))
    sample = splits.bounded_sample(rows, 17, 1, "doc_id", "line_no")
    smallest = sorted(r.order_key for r in splits.bounded_sample(rows, 300, 1, "doc_id", "line_no").collect())[:17]
    assert sorted(r.order_key for r in sample.collect()) == smallest
    assert splits.bounded_sample(rows, 1000, 1, "doc_id", "line_no").count() == 300


def test_hashed_prefix_sum_is_gap_free(spark):
    labelled = splits.random_split(spark.range(400).withColumnRenamed("id", "doc_id"), 0.2)
    rows = hashed_prefix_sum(labelled, "split", "order_key", "doc_id", F.col("doc_id"), "before").collect()
    for split in ("train", "val"):
        total = 0
        for r in sorted((r for r in rows if r.split == split), key=lambda r: r.order_key):
            assert r.before == total
            total += r.doc_id


def test_ranged_prefix_sum_over_sparse_ids(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_PART", 20)
    rows = spark.range(200).select((F.col("id") * F.col("id") * 10**12).alias("doc_id"), F.col("id").alias("w"))
    got = ranged_prefix_sum(rows, ["doc_id"], F.col("w"), "before").orderBy("doc_id").collect()
    total = 0
    for r in got:
        assert r.before == total
        total += r.w


def test_row_numbers_with_a_hot_run(spark, monkeypatch):
    monkeypatch.setattr(ordered, "ROWS_PER_PART", 100)
    # One run and one time hold most rows.
    rows = spark.range(3000).select(
        F.when(F.col("id") % 10 < 8, 1).otherwise(F.col("id") % 50).alias("run"),
        F.when(F.col("id") % 3 < 2, 5).otherwise(F.col("id")).alias("ts"),
        F.col("id").alias("event_id"),
    )
    cut = ordered.ranged(rows, ["run", "ts", "event_id"]).groupBy("_part").count().collect()
    assert len(cut) > 4 and max(r["count"] for r in cut) < 1500
    got = row_numbers(rows, "run", ["ts", "event_id"], "n").collect()
    runs = {}
    for r in got:
        runs.setdefault(r.run, []).append(r)
    for members in runs.values():
        members.sort(key=lambda r: (r.ts, r.event_id))
        assert [r.n for r in members] == list(range(1, len(members) + 1))


def test_bucket_digits_stay_within_the_broadcast_bound():
    assert bucket_digits(10) == 3 and bucket_digits(10**12) == 4


def test_shuffled_documents_lie_in_key_order(spark):
    labelled = splits.random_split(spark.range(300).withColumnRenamed("id", "doc_id"), 0.1)
    rows = [(r.split, r.order_key) for r in splits.shuffled(labelled).collect()]
    assert rows == sorted(rows) and len(rows) == 300
