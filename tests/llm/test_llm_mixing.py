import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tokenloom.llm import mixing

WEIGHTS = [{"a": 3, "b": 1}, {"en": 2}, {"none": 0}]


def leaves_of(spark, rows):
    return spark.createDataFrame(rows, "domain string, lang string, source string, held long")


def budgets(spark, rows, weights, share, epochs=1):
    return {(r.domain, r.lang, r.source): r.budget for r in mixing.leaf_budgets(leaves_of(spark, rows), weights, share, epochs).collect()}


def test_siblings_make_good_before_ancestors(spark):
    rows = [("a", "en", "s1", 100), ("a", "en", "s2", 1000), ("a", "de", "s1", 1000), ("b", "en", "s1", 2000)]
    got = budgets(spark, rows, [{}, {}, {}], 0.5)
    # a and b get 1025 each; in a, en and de 512; s1 is short by 156, which s2 of the same language takes.
    assert got == {("a", "en", "s1"): 100, ("a", "en", "s2"): 412, ("a", "de", "s1"): 512, ("b", "en", "s1"): 1025}
    short = [("a", "en", "s1", 50), ("a", "de", "s1", 100), ("b", "en", "s1", 1000)]
    assert budgets(spark, short, [{}, {}, {}], 1.0) == {("a", "en", "s1"): 50, ("a", "de", "s1"): 100, ("b", "en", "s1"): 1000}
    assert budgets(spark, short, [{"a": 3, "b": 1}, {"en": 3, "de": 1}, {}], 0.1) == {("a", "en", "s1"): 50, ("a", "de", "s1"): 36, ("b", "en", "s1"): 28}


def test_weights_of_zero_and_epochs(spark):
    rows = [("a", "en", "s1", 10), ("b", "en", "none", 100), ("b", "de", "s2", 10)]
    got = budgets(spark, rows, WEIGHTS, 1.0, epochs=2)
    assert got == {("a", "en", "s1"): 20, ("b", "en", "none"): 0, ("b", "de", "s2"): 20}


@pytest.mark.parametrize("per_bucket", [5, 20_000])
def test_prefixes_spend_the_budgets(spark, monkeypatch, per_bucket):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", per_bucket)
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 30), rng.choice(["en", "de", None]), rng.choice(["s1", "s2", "s3", None]), "d") for i in range(150)]
    rows += [(7, "same text here", "en", "s1", "d")] * 40 + [(None, None, "en", "s1", "d"), (500, "w " * 3000, "fr", "s9", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, domain string")
    domain = F.when(F.col("source") == "s1", "a").when(F.col("source").isNotNull(), "b")
    got = mixing.mix(docs, domain, WEIGHTS, 0.6, epochs=3).collect()
    held, spent, largest = Counter(), Counter(), Counter()
    for _, text, lang, source, _ in rows:
        leaf = ("a" if source == "s1" else "b" if source else mixing.NONE, lang or mixing.NONE, source or mixing.NONE)
        tokens = max(1, len((text or "").split()))
        held[leaf] += tokens
        largest[leaf] = max(largest[leaf], tokens)
    for r in got:
        spent[r.domain, r.lang, r.source] += r.tokens
        assert r.row.domain == "d"
    plan = budgets(spark, [(*k, v) for k, v in held.items()], WEIGHTS, 0.6, 3)
    assert set(plan) == set(held)
    for leaf, budget in plan.items():
        assert budget - largest[leaf] < spent[leaf] <= budget, leaf
    epochs = defaultdict(Counter)
    for r in got:
        epochs[r.domain, r.lang, r.source][r.epoch] += r.tokens
    for leaf, used in epochs.items():
        assert all(used[e] == held[leaf] for e in range(max(used)))


def test_rows_of_one_id_are_spread_by_their_texts(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_BUCKET", 10)
    docs = spark.createDataFrame([(None, f"w{i} x", "en", "s1") for i in range(400)], "doc_id long, text string, lang string, source string")
    got = mixing.mix(docs, F.lit("a"), [{}, {}, {}], 0.5).collect()
    assert sum(r.tokens for r in got) == 400 and len({r.row.text for r in got}) == 200


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert mixing.mix(docs, F.lit("a"), WEIGHTS, 0.5).count() == 0
