import random

import pytest
from pyspark.sql import functions as F

from test_subwords import merged_by_passes, one_at_a_time
from tokenloom.operators import vocab
from tokenloom.plans import subwords


@pytest.fixture
def corpus(spark, docs, monkeypatch, tmp_path):
    """A corpus of more than 32 merges in place of the registered table."""
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklm", k=7)) for _ in range(7)]
    frame = docs(*[" ".join([w] * (1 + 2 * i)) for i, w in enumerate(words)])
    monkeypatch.setattr(subwords, "documents", lambda *_: frame)
    counts = {r["word"]: r["cnt"] for r in vocab.word_counts(frame).collect()}
    return str(tmp_path), counts, frame


def test_registered_size_is_the_reference_one():
    assert subwords.VOCAB_SIZE == 16_000 and subwords.MERGES == 15_740


def test_registered_merges_and_ids_equal_a_sequential_loop(spark, corpus):
    name, words, frame = corpus
    expected = one_at_a_time(words, subwords.MERGES)
    assert len(expected) > 32
    merges = [tuple(r)[1:] for r in subwords.bpe_merges(spark, name).orderBy("rank").collect()]
    assert merges == expected
    model = subwords.trained(spark, name)
    assert model.merges == [(a, b) for a, b, _ in expected]
    ids, ranks = model.piece_ids(), {pair: i for i, pair in enumerate(model.merges)}
    rows = {r["doc_id"]: r["first_ids"] for r in subwords.bpe_pieces(spark, name).collect()}
    for doc_id, text in frame.select("doc_id", F.col("text")).collect():
        parts = [p for w in text.split() for p in merged_by_passes("▁" + w, ranks)]
        assert rows[doc_id] == " ".join(map(str, ([ids[p] for p in parts] + [vocab.EOS_ID])[:20]))
