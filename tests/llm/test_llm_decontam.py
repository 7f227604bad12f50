import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tokenloom.llm import decontam

ITEM = "The quick Brown fox jumps over a lazy dog, while seven wise owls watch from the old oak tree near our quiet river bank tonight."
DOCS = "doc_id long, text string, hits string"


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_best_match_is_the_smallest_distance_to_any_run():
    rng = random.Random(1)
    for _ in range(60):
        item = np.array([rng.randrange(5) for _ in range(rng.randint(1, 7))])
        text = np.array([rng.randrange(5) for _ in range(rng.randint(0, 12))])
        runs = [(levenshtein(item, text[i:j]), j) for i in range(len(text) + 1) for j in range(i, len(text) + 1)]
        assert decontam.best_match(item, text) == min(runs)


def edited(words, edits, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"new{rng.randrange(10**9)}"
    return words


def test_edited_copies_are_found_and_others_are_not():
    rng = random.Random(2)
    items = [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randint(20, 50)))) for i in range(40)]
    index = decontam.build_index(items)
    assert index.recall >= decontam.TARGET_RECALL
    texts, expected = [], []
    for item, text in items:
        words = text.split()
        noise = [f"n{rng.randrange(400)}" for _ in range(60)]
        texts += [" ".join(noise + edited(words, int(0.2 * len(words)), rng) + noise), " ".join(noise + words[: len(words) // 2] + noise)]
        expected += [[item], []]
    found = decontam.hits(index, pa.array(texts))
    assert sum([h["item_id"] for h in f] == e for f, e in zip(found, expected)) >= len(texts) - 1
    assert all(not f for f, e in zip(found, expected) if not e)


def test_cases_and_clashing_columns(spark):
    upper = ITEM.upper().replace(",", " ;")
    rows = [
        (1, f"before {ITEM} after", "x"), (1, f"before {ITEM} after", "x"), (2, upper, "x"), (3, None, "x"), (4, "", None),
        (None, ITEM, "x"), (5, "a short one", "x"), (6, "word " * 200_000 + ITEM, "x"), (7, "plain words of no item at all " * 9, "x"),
    ]
    docs = spark.createDataFrame(rows, DOCS)
    items = spark.createDataFrame([(9, ITEM), (9, ITEM), (8, None), (7, ""), (6, "short one"), (5, "la " * 30)], "item_id long, text string")
    found = decontam.contaminations(docs, items).collect()
    assert sorted((str(r.doc_id), r.item_id, r.distance) for r in found) == sorted(
        [("1", 9, 0), ("1", 9, 0), ("2", 9, 0), ("None", 9, 0), ("5", 6, 0), ("6", 9, 0)]
    )
    assert {(r.first_word, r.end_word) for r in found if r.doc_id == 1} == {(1, 26)}
    clean = decontam.decontaminate(docs, items)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 7]


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    items = spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminations(docs, items).count() == 0
    full = spark.createDataFrame([(1, ITEM, "x")], DOCS)
    assert decontam.decontaminate(full, items).count() == 1
    assert decontam.decontaminate(docs, full.select(F.col("doc_id").alias("item_id"), "text")).count() == 0


@pytest.mark.parametrize("blocks", [3, 50])
def test_items_in_blocks_find_the_same(spark, monkeypatch, blocks):
    items = spark.createDataFrame([(i, f"{ITEM} number{i} ends here") for i in range(6)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{ITEM} number{i} ends here") for i in range(4)], "doc_id long, text string")
    monkeypatch.setattr(decontam, "BLOCK_ITEMS", 2 * blocks)
    found = decontam.contaminations(docs, items).where("distance = 0").collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(i, i) for i in range(4)]


def brute_hits(items, texts, rate=0.2):
    """(text, item) of all texts with a run within the distance, over all words and without an index."""
    out = set()
    for n, text in enumerate(texts):
        for item, wanted in items:
            own, words = text.split(), wanted.split()
            number = {w: i for i, w in enumerate({*own, *words})}
            a, b = (np.array([number[w] for w in part], np.int64) for part in (words, own))
            if len(a) and decontam.best_match(a, b)[0] <= int(rate * len(a)):
                out.add((n, item))
    return out


def test_short_and_repetitive_items_are_found_with_edits():
    rng = random.Random(5)
    items = [(0, "alpha beta gamma delta epsilon zeta eta"), (1, " ".join(["na na hey"] * 13 + ["na"])), (2, "one two"), (3, "a b c d e")]
    texts = ["x alpha beta gamma NEW epsilon zeta eta y", "alpha beta delta epsilon zeta eta", "q one two r", "one and two", "a b x c d e"]
    texts += [" ".join(["na na hey"] * 6 + ["what"] + ["na na hey"] * 7), "na hey " * 15, "a b x c d", "a b y d e"]
    texts += [" ".join(rng.choices("abcde", k=30)) for _ in range(40)]
    texts = [t.lower() for t in texts]
    index = decontam.build_index(items)
    assert not index.repeats and index.pieces
    found = {(n, h["item_id"]) for n, listed in enumerate(decontam.hits(index, pa.array(texts))) for h in listed}
    assert found == brute_hits(items, texts) and {(0, 0), (1, 0), (5, 1), (4, 3)} <= found


def test_items_below_the_target_are_sought_exactly(monkeypatch):
    monkeypatch.setattr(decontam, "MOST_REPEATS", 0)
    rng = random.Random(6)
    items = [(i, " ".join(f"w{rng.randrange(30)}" for _ in range(rng.randint(12, 30)))) for i in range(12)]
    texts = [" ".join(edited(t.split(), int(0.2 * len(t.split())), rng)) for _, t in items for _ in range(4)]
    index = decontam.build_index(items)
    found = {(n, h["item_id"]) for n, listed in enumerate(decontam.hits(index, pa.array(texts))) for h in listed}
    assert found == brute_hits(items, texts) and len(found) >= len(texts)


def test_whole_result_equals_brute_force(spark):
    """The query's rows on a small corpus: items edited at random, halves, and texts that only share words."""
    rng = random.Random(7)
    items = [(i, " ".join(f"w{rng.randrange(150)}" for _ in range(rng.randint(6, 45)))) for i in range(25)]
    texts = []
    for _, text in items:
        words = text.split()
        noise = [f"w{rng.randrange(150)}" for _ in range(30)]
        for edits in (0, int(0.2 * len(words)), int(0.2 * len(words)) + 3):
            texts.append(" ".join(noise + edited(words, min(edits, len(words)), rng) + noise))
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], DOCS)
    found = decontam.contaminations(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    expected = brute_hits(items, texts)
    got = {(r.doc_id, r.item_id) for r in found}
    assert got <= expected and len(got) >= 0.99 * len(expected)
    for r in found:
        own = texts[r.doc_id].split()[r.first_word : r.end_word]
        assert r.distance == levenshtein(dict(items)[r.item_id].split(), own) <= int(0.2 * r.n_words)
