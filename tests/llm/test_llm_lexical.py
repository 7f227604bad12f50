import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tokenloom.llm import lexical

DOC_TYPE = "doc_id long, text string, n int, score string, item string"
ITEM_TYPE = "item_id long, text string, rank int"


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=50):
    rows = [(doc_id, Counter(words(text))) for doc_id, text in docs if words(text)]
    n_docs, length = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    terms = {}
    for item_id, text in items:
        terms.setdefault(item_id, set()).update(words(text))
    out = []
    for item_id, wanted in terms.items():
        scored = []
        for doc_id, counts in rows:
            m = 100 - 50 + (50 * sum(counts.values()) * n_docs) // length
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            score = sum(weight(t) * ((1000000000 * counts[t]) // (1000 * counts[t] + 20 * m)) for t in wanted & set(counts))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, row[3], -row[0]) for rank, row in enumerate(sorted(scored)[:top], 1)]
    return sorted(out, key=str)


def run(spark, docs, items, top=50):
    left = spark.createDataFrame([(i, t, 1, "s", "i") for i, t in docs], DOC_TYPE)
    right = spark.createDataFrame([(i, t, 9) for i, t in items], ITEM_TYPE)
    found = lexical.rank_documents(left, right, top)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in found.collect()), key=str)


def corpus(seed, size, vocabulary=60):
    rng = random.Random(seed)
    names = [f"w{i}" for i in range(vocabulary)]
    share = [1 / (i + 1) for i in range(vocabulary)]
    return [(i, " ".join(rng.choices(names, share, k=rng.randint(0, 40)))) for i in range(size)]


@pytest.mark.parametrize("seed,bucket,rows", [(0, 4096, 32768), (1, 16, 64), (2, 7, 50)])
def test_equals_scoring_every_document(spark, monkeypatch, seed, bucket, rows):
    monkeypatch.setattr(lexical, "BUCKET", bucket)
    monkeypatch.setattr(lexical, "ROWS_PER_PART", rows)
    docs = corpus(seed, 400)
    items = [(i, t) for i, t in corpus(seed + 100, 12)] + [(50, "w59 W58 w0"), (51, "w59")]
    for top in (3, 50):
        assert run(spark, docs, items, top) == brute(docs, items, top)


def test_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "MOST_ITEMS", 3)
    docs, items = corpus(5, 80), corpus(6, 8) + [(None, "w3 w4"), (2, "w9 w9"), (None, "w5")]
    assert run(spark, docs, items, 5) == brute(docs, items, 5)


def test_odd_rows(spark):
    docs = [(1, "Äpfel ÄPFEL apfel"), (1, "Äpfel ÄPFEL apfel"), (None, "apfel"), (3, None), (4, ""), (5, " .,!"), (6, "x" * 300_000 + " apfel")]
    docs += [(i, "filler words here") for i in range(10, 20)]
    items = [(7, "APFEL"), (8, None), (9, ""), (None, "Äpfel"), (10, "nothing"), (11, "ÄPFEL!")]
    assert run(spark, docs, items) == brute(docs, items)


def test_copies_are_ranked_by_id(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ROWS_PER_PART", 40)
    docs = [(i, "same text of every copy") for i in range(300)] + [(1000 + i, "other") for i in range(400)]
    rows = run(spark, docs, [(1, "copy")])
    assert sorted(r[2] for r in rows) == list(range(50)) and rows == brute(docs, [(1, "copy")])


def test_empty_tables(spark):
    assert run(spark, [], [(1, "a")]) == run(spark, [(1, "a")], []) == run(spark, [(1, None)], [(1, None)]) == []


def test_bounds_keep_what_reaches_the_threshold():
    """Whatever the threshold, a bucket returns every vector that reaches it, and the bounds rule some out."""
    rng = np.random.default_rng(4)
    ruled_out = 0
    for _ in range(60):
        dense = np.where(rng.random((50, 9)) < 0.4, rng.integers(1, 1000, (50, 9)), 0)
        dense = dense[dense.sum(axis=1) > 0]
        norms = np.sqrt((dense.astype(float) ** 2).sum(axis=1))
        lists = [np.flatnonzero(r) for r in dense]
        batch = pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(len(dense))),
                pa.array(norms),
                pa.array([l.tolist() for l in lists], pa.list_(pa.int32())),
                pa.array([r[l].tolist() for r, l in zip(dense, lists)], pa.list_(pa.int32())),
            ],
            ["doc_id", "norm", "terms", "impacts"],
        )
        terms = np.arange(9)
        weights = rng.integers(1, 50, 9) ** 2
        scores = dense @ weights
        norm = float(np.sqrt((weights.astype(float) ** 2).sum()))
        threshold = int(np.sort(scores)[-3])
        bucket, best = lexical.Bucket(batch), lexical.Best(1, np.array([threshold]), 50)
        bucket.search(0, terms, weights, norm, best)
        assert set(best.docs[0]) == set(np.flatnonzero(scores >= threshold))
        wanted = bucket.survivors(terms, weights, norm, threshold, *bucket.lists(terms), len(dense))
        ruled_out += (~wanted).sum()
    assert ruled_out
