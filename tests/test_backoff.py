import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tokenloom.operators import backoff

EOS, SIZE = 5, 7


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    return [[rng.choice([0, 0, 1, 2, 3]) for _ in range(rng.randint(0, 25))] + [EOS] for _ in range(40)] + [[]]


@pytest.fixture(scope="module")
def counts(spark, texts):
    rows = [(i, "train" if i % 4 else "val", t) for i, t in enumerate(texts)] + [(99, "train", None)]
    frame = spark.createDataFrame(rows, "doc_id long, split string, ids array<int>").repartition(3)
    return backoff.run_counts(frame, EOS, "split").cache()


@pytest.fixture(scope="module")
def trie(counts):
    return backoff.train_trie(counts.where("split = 'train'"), SIZE, least=3)


def dense(texts, least=3):
    """Probability by recursion over plain dictionaries."""
    follow = defaultdict(Counter)
    for i, t in enumerate(texts):
        if i % 4:
            padded = [EOS, *t]
            for at in range(1, len(padded)):
                for k in range(backoff.ORDER + 1):
                    if at - k >= 0:
                        follow[tuple(padded[at - k : at])][padded[at]] += 1

    def p(context, token):
        if not context:
            return (follow[()][token] + 1) / (sum(follow[()].values()) + SIZE)
        seen = follow.get(context, {})
        total = sum(seen.values())
        if total < least:
            return p(context[1:], token)
        return (seen[token] + len(seen) * p(context[1:], token)) / (total + len(seen))

    return p


def test_runs_hold_every_token_once(counts, texts):
    rows = counts.collect()
    assert sum(r["cnt"] for r in rows) == sum(map(len, texts))
    wanted = Counter()
    for i, t in enumerate(texts):
        padded = [EOS, *t]
        for at in range(1, len(padded)):
            before = [padded[at - k] if at >= k else backoff.NO_ID for k in range(1, backoff.ORDER + 1)]
            wanted["train" if i % 4 else "val", padded[at], *before] += 1
    assert {(r["split"], r["next"], r["c1"], r["c2"], r["c3"]): r["cnt"] for r in rows} == wanted


def test_probabilities_equal_recursion_and_add_up(spark, trie, texts):
    p = dense(texts)
    contexts = [(a, b, c) for a in range(SIZE) for b in (0, 3, EOS, backoff.NO_ID) for c in (0, 2, backoff.NO_ID) if b != backoff.NO_ID or c == b]
    rows = spark.createDataFrame([(*c, t) for c in contexts for t in range(SIZE)], "c1 int, c2 int, c3 int, next int")
    sums = Counter()
    for r in backoff.with_probability(rows.withColumn("s", F.lit(1)), trie, "s").collect():
        context = tuple(c for c in (r["c3"], r["c2"], r["c1"]) if c != backoff.NO_ID)
        assert r["p"] == pytest.approx(p(context, r["next"]))
        sums[r["c1"], r["c2"], r["c3"]] += r["p"]
    assert all(s == pytest.approx(1) for s in sums.values()) and len(sums) == len(contexts)


def test_loss_equals_recursion(counts, trie, texts):
    p = dense(texts)
    losses = defaultdict(list)
    for i, t in enumerate(texts):
        padded = [EOS, *t]
        for at in range(1, len(padded)):
            losses["train" if i % 4 else "val"].append(-math.log(p(tuple(padded[max(0, at - backoff.ORDER) : at]), padded[at])))
    for r in backoff.cross_entropy(counts, trie, "split").collect():
        own = losses[r["split"]]
        assert r["tokens"] == len(own) and r["loss"] == pytest.approx(sum(own) / len(own))


def test_cropping_changes_draws(spark, trie):
    prompts = spark.createDataFrame([(str(i), s, [i % 4, (i // 4) % 4, 0]) for i in range(60) for s in range(3)], "k string, sample int, ids array<int>")
    out = {}
    for block in (1, 2, 9):
        rows = backoff.generate(prompts, trie, "k", 3, block).collect()
        assert all(len(r["generated"]) == 3 and all(0 <= i < SIZE for i in r["generated"]) for r in rows)
        out[block] = {(r["k"], r["sample"]): r["generated"] for r in rows}
    assert out[1] != out[2] != out[9] and len(out[1]) == 180
    # Seen through one id, prompts with one last id share their distribution.
    seen = prompts.select("k", "sample", *backoff.context_of(F.col("ids"), 1))
    assert backoff.distributions(seen, trie).count() == 1


def test_contexts_of_short_prompts(spark):
    rows = spark.createDataFrame([([1, 2, 3, 4],), ([1],), ([],)], "ids array<int>")
    found = rows.select(*backoff.context_of(F.col("ids"), 2)).collect()
    no = backoff.NO_ID
    assert [tuple(r) for r in found] == [(4, 3, no), (1, no, no), (no, no, no)]


@pytest.mark.parametrize("piece_rows, stream_rows", [(1_000_000, 500_000), (3, 5)])
def test_large_tries_are_met_in_order_and_give_the_same(spark, counts, trie, texts, monkeypatch, piece_rows, stream_rows):
    monkeypatch.setattr(backoff, "PIECE_ROWS", piece_rows)
    monkeypatch.setattr(backoff, "STREAM_ROWS", stream_rows)
    wide = backoff.train_trie(counts.where("split = 'train'"), SIZE, least=3)
    monkeypatch.setattr(backoff, "fits_broadcast", lambda values, most=None: False)
    large = backoff.train_trie(counts.where("split = 'train'"), SIZE, least=3)
    assert len(large.followers) == 1 and len(wide.followers) == backoff.ORDER
    no = backoff.NO_ID
    contexts = [(a, b, c) for a in (*range(SIZE), no) for b in (0, 3, EOS, no) for c in (0, 2, no) if (b != no or c == b) and (a != no or b == a)]
    rows = spark.createDataFrame([(str(c), *c, t) for c in contexts for t in range(SIZE)], "s string, c1 int, c2 int, c3 int, next int")
    p = dense(texts)
    got = backoff.with_probability(rows.repartition(3), large, "s").collect()
    assert len(got) == len(contexts) * SIZE
    for r in got:
        context = tuple(c for c in (r["c3"], r["c2"], r["c1"]) if c != no)
        assert r["s"] == str((r["c1"], r["c2"], r["c3"])) and r["p"] == pytest.approx(p(context, r["next"]))
    monkeypatch.undo()
    same = {(r["s"], r["next"]): (r["p"], r["matched"]) for r in backoff.with_probability(rows, trie, "s").collect()}
    assert {(r["s"], r["next"]): (pytest.approx(r["p"]), r["matched"]) for r in got} == same
    assert {r["split"]: pytest.approx(r["loss"]) for r in backoff.cross_entropy(counts, large, "split").collect()} == {
        r["split"]: r["loss"] for r in backoff.cross_entropy(counts, trie, "split").collect()
    }


def test_runs_travel_as_one_number(spark):
    frame = spark.createDataFrame([("train", [1, 2])], "split string, ids array<int>")
    plan = backoff.run_counts(frame, EOS, "split")._jdf.queryExecution().optimizedPlan().toString()
    keys = plan.split("Aggregate [")[1].split("]")[0]
    assert [k.split("#")[0] for k in keys.split(", ")] == ["split", "_run"]


def test_upper_levels_of_large_tries_are_not_shuffled_or_written(spark, counts, monkeypatch):
    monkeypatch.setattr(backoff, "fits_broadcast", lambda values, most=None: False)
    large = backoff.train_trie(counts.where("split = 'train'"), SIZE, least=3)
    plan = backoff.with_probability(counts, large, "split", stored=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(_last") == 1 and "Join" not in plan
