import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tokenloom.functions import text as T
from tokenloom.operators import bpe, encode, vocab
from tokenloom.sources.documents import clean


def one_at_a_time(words, merges):
    state = {w: list(w) for w in words}
    out = []
    while len(out) < merges:
        pairs = Counter()
        for w, parts in state.items():
            for pair in zip(parts, parts[1:]):
                pairs[pair] += words[w]
        if not pairs:
            break
        (a, b), count = min(pairs.items(), key=lambda kv: (-kv[1], kv[0]))
        out.append((a, b, count))
        for w, parts in state.items():
            i, joined = 0, []
            while i < len(parts):
                if parts[i : i + 2] == [a, b]:
                    joined.append(a + b)
                    i += 2
                else:
                    joined.append(parts[i])
                    i += 1
            state[w] = joined
    return out


@pytest.mark.parametrize(
    "words",
    [
        {"aaa": 3, "aaaa": 2, "abab": 5},
        {"ab": 1, "cd": 1, "ef": 1, "abcd": 2},
        {"▁a.b": 4, "▁a*b": 4, "▁\\E$1": 6, "[x]": 2},
    ],
)
def test_merges_equal_one_at_a_time_learning(spark, words):
    frame = spark.createDataFrame(list(words.items()), "word string, cnt long")
    assert bpe.learn_merges(frame, 8) == one_at_a_time(words, 8)


@pytest.mark.parametrize("seed", range(8))
def test_merges_of_random_words(spark, monkeypatch, seed):
    """Few live pairs a round, and a bound on the runs that makes rounds take fewer, down to one pair."""
    monkeypatch.setattr(bpe, "FIRST_PAIRS", 1 + seed)
    monkeypatch.setattr(bpe, "MOST_RUNS", [100_000, 20][seed % 2])
    rng = random.Random(seed)
    words = {"".join(rng.choices("abcd", k=rng.randint(1, 9))): rng.randint(1, 30 if seed < 6 else 2) for _ in range(60)}
    frame = spark.createDataFrame(list(words.items()), "word string, cnt long")
    assert bpe.learn_merges(frame, 60) == one_at_a_time(words, 60)


def test_merges_of_a_corpus_to_its_last_pair(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choices("abcde", k=rng.randint(2, 4))) for _ in range(25)]
    words = Counter("".join(rng.choices(stems, k=rng.randint(1, 4))) for _ in range(900))
    frame = spark.createDataFrame(list(words.items()), "word string, cnt long")
    expected = one_at_a_time(words, 10_000)
    # A string becomes a symbol by one merge only.
    assert len(expected) > 500 and len({a + b for a, b, _ in expected}) == len(expected)
    assert bpe.learn_merges(frame, 10_000) == expected


def test_merges_are_applied_in_order():
    ranks = {("a", "b"): 0, ("b", "c"): 1, ("ab", "c"): 2}
    assert bpe.merged_in_order(list("abcbc"), ranks) == ["abc", "bc"]
    assert bpe.merged_in_order(list("aaa"), {("a", "a"): 0}) == ["aa", "a"]
    assert bpe.merged_in_order(list("aaaa"), {("a", "a"): 0, ("aa", "aa"): 1}) == ["aaaa"]


def test_live_runs():
    live = frozenset({("a", "b"), ("b", "c")})
    assert bpe.live_runs(list("xabcyab"), live, False) == [list("abc"), list("ab")]
    assert bpe.live_runs(list("xaby"), live, True) == [list("xaby")]
    assert bpe.live_runs(list("xy"), live, True) == bpe.live_runs([], live, False) == []


@pytest.fixture(scope="module")
def model():
    return vocab.Subwords([("t", "h"), ("▁", "th"), ("▁th", "e"), ("e", "e")], ["▁", "t", "h", "e", "c", "a", "1", "2"])


def test_encode_applies_merges_and_falls_back_to_bytes(docs, model):
    rows = encode.encode_subwords(docs("the cat\n12", "eee", "é", "", None), model).orderBy("doc_id").collect()
    ids = model.piece_ids()
    assert rows[0].ids == [ids[p] for p in ("▁the", "▁", "c", "a", "t", "▁", "1", "2")] + [vocab.EOS_ID]
    assert rows[1].ids == [ids["▁"], ids["ee"], ids["e"], vocab.EOS_ID]
    assert rows[2].ids == [ids["▁"], 4 + 0xC3, 4 + 0xA9, vocab.EOS_ID]
    assert rows[3].ids == rows[4].ids == []
    assert [r.len for r in rows] == [9, 4, 4, 0, 0]


def test_decode_is_the_inverse_up_to_white_space(docs, model):
    texts = ["the  cat", "ශ්‍රී ලංකාව", "a😀b 42\tthe", "<|endoftext|>", ""]
    frame = docs(*texts).withColumn("expected", T.normalize(F.col("text")))
    encoded = encode.encode_subwords(frame, model)
    rows = encoded.select("expected", encode.decode_subwords(F.col("ids"), model).alias("back")).collect()
    assert all(r.back == r.expected for r in rows) and len(rows) == 5


def test_encode_ignores_the_partitioning(docs, model):
    frame = docs(*[f"the {'ee' * i} cat {i}" for i in range(40)])
    results = [
        {r.doc_id: r.ids for r in encode.encode_subwords(frame.repartition(k), model).collect()} for k in (1, 7, 32)
    ]
    assert results[0] == results[1] == results[2]


def test_vocabulary_layout_and_storage(spark, model, tmp_path):
    pieces = {r.id: r.piece for r in vocab.assemble_vocab(spark, model).collect()}
    assert sorted(pieces) == list(range(model.size)) and model.size == 260 + 4 + 8
    assert [pieces[i] for i in (0, 1, 2, 3, 4, 259, 260)] == ["<pad>", "<unk>", "<s>", "</s>", "<0x00>", "<0xFF>", "th"]
    vocab.write_subwords(spark, model, f"{tmp_path}/model")
    assert vocab.read_subwords(spark, f"{tmp_path}/model") == model


def test_training_reaches_the_requested_size(docs):
    frame = docs(*["low lower lowest new newer newest wide wider widest"] * 5)
    trained = bpe.train_subwords(frame, 290, coverage=1.0)
    assert trained.size == 290
    assert encode.encode_subwords(frame, trained).first().len < 54


def test_character_coverage_keeps_the_mass(spark):
    counts = spark.createDataFrame([("a", 90), ("b", 9), ("c", 1)], "char string, cnt long")
    kept = {r.char: r.kept for r in vocab.char_coverage(counts, 0.9).collect()}
    assert kept == {"a": True, "b": False, "c": False}
    assert all(r.kept for r in vocab.char_coverage(counts, 1.0).collect())


def test_special_literal(docs):
    frame = docs("a<|endoftext|>b", "<|endoftext|>", "ab")
    ids = vocab.collect_ids(vocab.char_vocab(frame))
    special = frame.select("doc_id", encode.char_ids_with_special(F.col("text"), ids, 99).alias("ids")).orderBy("doc_id")
    a, b = ids["a"], ids["b"]
    assert [r.ids for r in special.collect()] == [[a, 99, b], [99], [a, b]]
    plain = frame.select(F.size(encode.char_ids(F.col("text"), ids)).alias("n"), "doc_id").orderBy("doc_id").collect()
    assert [r.n for r in plain] == [15, 13, 2]


def test_unknown_characters(docs):
    frame = docs("ax")
    assert frame.select(encode.char_ids(F.col("text"), {"a": 5}, "unk").alias("i")).first().i == [5, vocab.UNK_ID]
    with pytest.raises(Exception, match="outside the vocabulary"):
        frame.select(encode.char_ids(F.col("text"), {"a": 5}).alias("i")).collect()
    assert frame.select(encode.char_ids_or_bytes(F.col("text"), {"a": 300}).alias("i")).first().i == [300, 4 + ord("x")]


def test_decode_chars(docs):
    frame = clean(docs("a😀b", ""))
    ids = vocab.collect_ids(vocab.char_vocab(frame))
    encoded = encode.encode_documents(frame, encode.char_ids(F.col("text"), ids), len(ids))
    rows = encoded.select("doc_id", encode.decode_chars(F.col("ids"), ids).alias("t")).orderBy("doc_id").collect()
    assert [r.t for r in rows] == ["a😀b", ""]


def test_pieces(docs, model):
    encoded = encode.encode_subwords(docs("the é"), model)
    pieces = encoded.select(encode.pieces_of(F.col("ids"), model).alias("p")).first().p
    assert pieces == ["▁the", "▁", "<0xC3>", "<0xA9>", "</s>"]


def merged_by_passes(unit, ranks):
    parts = list(unit)
    while len(parts) > 1:
        best = min(zip(parts, parts[1:]), key=lambda pair: ranks.get(pair, len(ranks)))
        if best not in ranks:
            break
        joined, i = [], 0
        while i < len(parts):
            if tuple(parts[i : i + 2]) == best:
                joined.append(best[0] + best[1])
                i += 2
            else:
                joined.append(parts[i])
                i += 1
        parts = joined
    return parts


def random_ranks(rng, letters, merges, longest=12):
    symbols, ranks = list(letters), {}
    for _ in range(merges):
        pair = rng.choice(symbols), rng.choice(symbols)
        if pair not in ranks and len(pair[0] + pair[1]) <= longest:
            ranks[pair] = len(ranks)
            symbols.append(pair[0] + pair[1])
    return ranks


def test_merges_of_a_unit_equal_passes_over_it():
    rng = random.Random(1)
    for _ in range(3000):
        ranks = random_ranks(rng, "abc", rng.randint(0, 12))
        unit = "".join(rng.choice("abcd") for _ in range(rng.randint(0, 25)))
        assert encode.merge_unit(unit, ranks) == merged_by_passes(unit, ranks)


def test_a_long_unit_is_merged_at_once():
    rng = random.Random(2)
    ranks = random_ranks(rng, "abcdefghij", 4000)
    unit = "".join(rng.choice("abcdefghij") for _ in range(100_000))
    begin = time.perf_counter()
    assert "".join(encode.merge_unit(unit, ranks)) == unit
    assert time.perf_counter() - begin < 1


def test_a_longer_stored_model_is_an_error(spark, tmp_path, monkeypatch):
    model = vocab.Subwords([("a", "b"), ("ab", "c")], ["a", "b", "c"])
    vocab.write_subwords(spark, model, f"{tmp_path}/m")
    assert vocab.read_subwords(spark, f"{tmp_path}/m") == model
    monkeypatch.setattr(vocab, "ID_LIMIT", 4)
    with pytest.raises(ValueError):
        vocab.read_subwords(spark, f"{tmp_path}/m")


def test_documents_without_end_marks_and_with_composed_characters(spark, docs):
    model = vocab.Subwords([("▁", "f")], ["▁", "f", "i", "A"])
    frame = docs("ﬁ Ａ", "", "fi A")
    plain = {r.doc_id: r.ids for r in encode.encode_subwords(frame, model, eos_id=None, compose=True).collect()}
    assert plain[0] == plain[2] and plain[1] == []
    closed = {r.doc_id: r.ids for r in encode.encode_subwords(frame, model, compose=True).collect()}
    assert closed == {i: [*ids, vocab.EOS_ID] if ids else [] for i, ids in plain.items()}
    assert {r.doc_id: r.ids for r in encode.encode_subwords(frame, model, eos_id=None).collect()}[0] != plain[0]
