import math

import pytest
from pyspark.sql import functions as F

from tokenloom.functions.arrays import crop_context, truncate_at
from tokenloom.operators import joins, ngram, sampling
from tokenloom.sources import prompts

EOS = 3


@pytest.fixture(scope="module")
def encoded(spark):
    rows = [(0, "a", [0, 1, 0, 1, EOS]), (1, "b", [2, 0, EOS]), (2, "a", []), (3, "a", [1, 1, 2, EOS])]
    return spark.createDataFrame(rows, "doc_id long, lang string, ids array<int>")


@pytest.fixture(scope="module")
def model(encoded):
    return ngram.train_ngram(ngram.pair_counts(encoded, EOS), 5)


def expected_p(prev, nxt):
    docs = [[0, 1, 0, 1, EOS], [2, 0, EOS], [1, 1, 2, EOS]]
    pairs = [(a, b) for d in docs for a, b in zip([EOS] + d, d)]
    single = (sum(b == nxt for _, b in pairs) + 1) / (len(pairs) + 5)
    seen = [b for a, b in pairs if a == prev]
    return 0.75 * seen.count(nxt) / len(seen) + 0.25 * single if seen else single


def test_probabilities_sum_to_one(spark, model):
    cells = spark.range(25).selectExpr("id", "cast(id div 5 as int) prev", "cast(id % 5 as int) next")
    rows = ngram.with_probability(cells, model, "id").collect()
    assert len(rows) == 25
    for r in rows:
        assert r.p == pytest.approx(expected_p(r.prev, r.next))
    for prev in range(5):
        assert sum(r.p for r in rows if r.prev == prev) == pytest.approx(1)


def test_documents_score_the_same_folded_joined_and_salted(encoded, model, monkeypatch):
    dense = {r.doc_id: r.loss for r in ngram.document_losses(encoded, model, EOS, "lang").collect()}
    joined = {r.doc_id: r.loss for r in ngram.document_losses(encoded, model, EOS, "lang", most_pairs=0).collect()}
    monkeypatch.setattr(joins, "BROADCAST_VALUES", 0)
    salted = {r.doc_id: r.loss for r in ngram.document_losses(encoded, model, EOS, "lang", most_pairs=0).collect()}
    assert set(dense) == {0, 1, 3}
    assert joined == pytest.approx(dense) and salted == pytest.approx(dense)
    first = [(EOS, 2), (2, 0), (0, EOS)]
    assert dense[1] == pytest.approx(-sum(math.log(expected_p(*p)) for p in first) / 3)


def test_ignored_targets_do_not_count(spark, model):
    counts = spark.createDataFrame([("x", 0, 1, 2), ("x", 0, -1, 50)], "split string, prev int, next int, cnt long")
    row = ngram.cross_entropy(counts, model, "split").first()
    assert row.tokens == 2 and row.loss == pytest.approx(-math.log(expected_p(0, 1)))
    assert row.perplexity == pytest.approx(math.exp(row.loss))


def test_loss_bands(spark):
    values = [0.5, 2.0, 2.5, 2.79, 2.8, 3.0, 3.5, 4.0, 5.0, 7.5, 8.0, 9.68, 10.0]
    frame = spark.createDataFrame([(v,) for v in values], "loss double").select("loss", ngram.loss_band(F.col("loss")).alias("b"))
    names = [r.b for r in frame.orderBy("loss").collect()]
    assert names[0] == "overfit risk" and names[2] == names[3] == "good" and names[-1] == "random" and names[9] == "frequencies"


def test_top_k_keeps_ties_and_scales_first(spark):
    logits = spark.createDataFrame([(0, i, float(v)) for i, v in enumerate([3, 2, 2, 1])], "context int, token int, logit double")
    kept = sampling.top_k_softmax(logits, "context", 2, 0.5).collect()
    assert sorted(r.token for r in kept) == [0, 1, 2]
    assert sum(r.prob for r in kept) == pytest.approx(1)
    assert max(r.prob for r in kept) == pytest.approx(math.exp(6) / (math.exp(6) + 2 * math.exp(4)))
    assert sampling.top_k_softmax(logits, "context", None).count() == 4
    assert sampling.top_k_softmax(logits, "context", 99).count() == 4


def test_candidates_hold_the_true_top_k(model):
    for k in (1, 2, 3):
        sparse = sampling.top_k_softmax(sampling.model_logits(model, k), "context", k)
        dense = sampling.top_k_softmax(sampling.model_logits(model, model.vocab_size), "context", k)
        assert {(r.context, r.token): round(r.prob, 12) for r in sparse.collect()} == {
            (r.context, r.token): round(r.prob, 12) for r in dense.collect()
        }


def test_multinomial_takes_the_first_above_u_or_the_last(spark):
    frame = spark.createDataFrame([(0.0,), (0.5,), (0.51,), (1.0,)], "u double")
    tokens, upto = F.array(F.lit(7), F.lit(8)), F.array(F.lit(0.5), F.lit(0.9999))
    assert [r.t for r in frame.select(sampling.multinomial(tokens, upto, F.col("u")).alias("t"), "u").orderBy("u").collect()] == [7, 8, 8, 8]


def test_generation_is_deterministic_and_independent_of_the_join(spark, model, monkeypatch):
    prompts = spark.createDataFrame([("p", [0, 1]), ("q", []), ("r", [4])], "prompt_id string, ids array<int>")
    runs = []
    for limit, cut in ((4_000_000, 10), (0, 3)):
        monkeypatch.setattr(joins, "BROADCAST_VALUES", limit)
        monkeypatch.setattr(sampling, "STEPS_PER_CUT", cut)
        sampler = sampling.build_sampler(sampling.top_k_softmax(sampling.model_logits(model, 3), "context", 3, 0.8))
        out = sampling.generate(sampling.fan_out(prompts, 2, EOS), sampler, "prompt_id", 7, 4)
        runs.append({(r.prompt_id, r.sample): r.generated for r in out.collect()})
    assert runs[0] == runs[1] and len(runs[0]) == 6
    assert all(len(g) == 7 for g in runs[0].values())
    assert runs[0][("p", 0)] != runs[0][("p", 1)]


@pytest.mark.parametrize("ids, kept", [([5, 6], [5, 6]), ([EOS, 5], []), ([5, EOS, 6, EOS], [5]), ([], [])])
def test_truncation_at_the_end_id(spark, ids, kept):
    frame = spark.createDataFrame([(ids,)], "ids array<int>")
    assert frame.select(truncate_at(F.col("ids"), EOS).alias("k")).first().k == kept


@pytest.mark.parametrize("n", [3, 4, 5])
def test_context_crop(spark, n):
    frame = spark.createDataFrame([(list(range(n)),)], "ids array<int>")
    assert frame.select(crop_context(F.col("ids"), 4).alias("c")).first().c == list(range(n))[-4:]


def test_throughput_without_time(spark):
    frame = spark.createDataFrame([(10, 0.0), (10, 4.0)], "n int, s double")
    assert [r.t for r in frame.select(sampling.throughput(F.col("n"), F.col("s")).alias("t")).collect()] == [0.0, 2.5]


def test_prompts_from_files(spark, tmp_path):
    for name, text in (("a", "ab<|endoftext|>b"), ("b", ""), ("c", "b\na")):
        (tmp_path / name).write_text(text)
    vocab = {"\n": 0, "a": 1, "b": 2}
    read = prompts.read_prompts(spark, str(tmp_path))
    got = {r.prompt_id[-1]: r.ids for r in prompts.encode_prompts(read, vocab, 9).collect()}
    assert got == {"a": [1, 2, 9, 2], "b": [0], "c": [2, 0, 1]} or got == {"a": [1, 2, 9, 2], "c": [2, 0, 1]}
    bare = spark.createDataFrame([("x", None), ("y", "")], "prompt_id string, text string")
    assert [r.ids for r in prompts.encode_prompts(bare, vocab, 9).collect()] == [[0], [0]]


def test_whole_draws_equal_a_dense_table(spark, model):
    temperature = 0.7
    power = 1 / temperature
    rows = spark.createDataFrame([(c, s) for c in range(model.vocab_size) for s in range(40)], "context int, sample int")
    rows = rows.withColumn("prompt_id", F.lit("p"))
    drawn = sampling.draw_whole(rows, sampling.build_whole_sampler(model, temperature), "prompt_id", 3).collect()
    dense = sampling.build_sampler(sampling.top_k_softmax(sampling.model_logits(model, model.vocab_size), "context", None, temperature))
    expected = sampling.draw_next(rows, dense, "prompt_id", 3).collect()
    assert power > 1 and len(drawn) == len(expected)
    assert {(r.context, r.sample): r.token for r in drawn} == {(r.context, r.sample): r.token for r in expected}


@pytest.mark.parametrize("block", [1, 6, 10**6])
def test_documents_are_joined_by_the_distinct_pairs_of_their_block(spark, encoded, model, monkeypatch, block):
    monkeypatch.setattr(ngram, "TOKENS_PER_BLOCK", block)
    met, scored = [], ngram.with_probability
    monkeypatch.setattr(ngram, "with_probability", lambda rows, *rest: met.append(rows) or scored(rows, *rest))
    more = encoded.unionAll(spark.createDataFrame([(i, "c", [1, 2, 0, EOS]) for i in range(10, 60)], encoded.schema))
    one = {r.doc_id: r.loss for r in ngram.document_losses(more, model, EOS, "lang").collect()}
    joined = {r.doc_id: r.loss for r in ngram.document_losses(more, model, EOS, "lang", most_pairs=0, most_values=0).collect()}
    assert joined == pytest.approx(one) and len(joined) == 53
    # No row per document and pair.
    assert "doc_id" not in met[0].columns
    if block == 10**6:
        assert met[0].count() == len({(0, 1), (1, 0), (1, EOS), (EOS, 2), (2, 0), (0, EOS), (EOS, 1), (1, 1), (1, 2), (2, EOS), (EOS, 0)})


def test_rows_of_one_document_are_joined_as_one(spark, model):
    rows = [(7, None, [0, 1]), (7, None, [2]), (None, "a", [1, EOS]), (None, "a", []), (8, "a", None)]
    frame = spark.createDataFrame(rows, "doc_id long, lang string, ids array<int>")
    got = {r.doc_id: r.loss for r in ngram.document_losses(frame, model, EOS, "lang", most_pairs=0).collect()}
    losses = [-math.log(expected_p(*p)) for p in ((EOS, 0), (0, 1), (EOS, 2))]
    assert got.keys() == {7, None} and got[7] == pytest.approx(sum(losses) / 3)


def test_pairs_are_counted_per_group(spark):
    rows = [("x", 1, [0, 1, 0, 1]), ("x", 1, [-1, 1]), (None, 2, [1]), ("y", None, []), ("y", 3, None)]
    frame = spark.createDataFrame(rows, "a string, b int, ids array<int>").repartition(2)
    got = {tuple(r) for r in ngram.pair_counts(frame, EOS, "a", "b").collect()}
    assert got == {("x", 1, EOS, 0, 1), ("x", 1, 0, 1, 2), ("x", 1, 1, 0, 1), ("x", 1, EOS, -1, 1), ("x", 1, -1, 1, 1), (None, 2, EOS, 1, 1)}
    assert {tuple(r) for r in ngram.pair_counts(frame.limit(0), EOS).collect()} == set()
