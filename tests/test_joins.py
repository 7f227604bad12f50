import pytest
from pyspark.sql import functions as F

from tokenloom.operators import joins


def test_heavy_keys_are_those_above_their_share(spark):
    # A third of all rows share one key, a tenth another; the rest are even.
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 9).otherwise(100 + F.col("id"))
    rows = spark.range(0, 60_000, 1, 6).select(key.alias("k"), "id")
    counts = {r.h: r["count"] for r in rows.groupBy("k", F.xxhash64("k").alias("h")).count().collect()}
    found = {r._key: r._pieces for r in joins.heavy_keys(rows, ["k"]).collect()}
    heavy = {h: n for h, n in counts.items() if n > 60_000 / joins.PIECES}
    assert heavy.keys() <= found.keys() and len(heavy) == 2
    for h, n in heavy.items():
        # The sketch may count too much, by one in 6,000 rows.
        assert n / (60_000 / joins.PIECES) <= found[h] <= (n + 10) / (60_000 / joins.PIECES) + 1
    assert sum(found.values()) < 3 * joins.PIECES


@pytest.mark.parametrize("pieces", [1, 4, 1024])
def test_spread_join_equals_a_plain_left_join(spark, monkeypatch, pieces):
    monkeypatch.setattr(joins, "PIECES", pieces)
    key = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 500)
    rows = spark.range(5_000).select("id", key.alias("a"), (F.col("id") % 2).cast("int").alias("b"))
    model = spark.range(0, 400).select(F.col("id").alias("a"), F.lit(1).alias("b"), (F.col("id") * 10).alias("v"))
    spread = joins.lookup_join(rows, model, ["a", "b"], 1200, "id", most_values=0).select("id", "a", "b", "v")
    plain = rows.join(model, ["a", "b"], "left").select("id", "a", "b", "v")
    assert sorted(map(str, spread.collect())) == sorted(map(str, plain.collect()))


def test_a_hot_key_leaves_no_task_with_its_rows(spark, monkeypatch):
    monkeypatch.setattr(joins, "PIECES", 64)
    rows = spark.range(0, 20_000, 1, 4).select("id", F.when(F.col("id") < 18_000, 1).otherwise(F.col("id")).alias("a"))
    model = spark.range(20_000).select(F.col("id").alias("a"), F.lit(2.0).alias("v"))
    joined = joins.lookup_join(rows, model.hint("merge"), ["a"], 40_000, "id", most_values=0)
    sizes = [r.n for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert sum(sizes) == 20_000 and joined.where("v is null").count() == 0
    assert max(sizes) < 18_000


def test_empty_sides(spark):
    rows, model = spark.createDataFrame([], "id long, a int"), spark.createDataFrame([], "a int, v double")
    assert joins.lookup_join(rows, model, ["a"], 5, "id", most_values=0).collect() == []
    one = spark.createDataFrame([(1, 5)], "id long, a int")
    assert [r.v for r in joins.lookup_join(one, model, ["a"], 5, "id", most_values=0).collect()] == [None]
