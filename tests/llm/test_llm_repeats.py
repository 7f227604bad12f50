import random
import re
from collections import Counter

import numpy as np

from tokenloom.llm import repeats
from tokenloom.llm.queries import repeats as used


def brute(texts, width):
    split = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
    seen = Counter(tuple(w[i : i + width]) for w in split for i in range(len(w) - width + 1))
    out = []
    for w in split:
        keep = [True] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                keep[i : i + width] = [False] * width
        out.append((len(w), keep.count(False), " ".join(x for x, k in zip(w, keep) if k)))
    return out


def test_first_smallest_is_the_leftmost_minimum():
    rng = np.random.default_rng(0)
    for width in (1, 2, 5, 7, 8, 28):
        values = rng.integers(0, 6, 60)
        got = repeats.first_smallest(values, width)
        assert got.tolist() == [i + int(np.argmin(values[i : i + width])) for i in range(60 - width + 1)]


def test_removal_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", ",", "the"]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(6, 25))] for _ in range(8)]
    texts = []
    for _ in range(120):
        words = []
        for _ in range(rng.randint(0, 5)):
            p = rng.choice(passages)
            cut = rng.randint(0, 4)
            words += [rng.choice(vocabulary) for _ in range(rng.randint(0, 12))] + p[cut : len(p) - rng.randint(0, 4)]
        texts.append(rng.choice([" ", "\n", "  "]).join(words))
    texts += [None, "", "   ", texts[3], texts[3], "same " * 40, "ab ab " * 30, "x" * 100_000 + " tail"]
    rows = [(i if i % 9 else None, t, "kept") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, kept string")
    for width, seed in ((8, 3), (5, 5)):
        got = repeats.remove_repeats(docs, width=width, seed=seed).collect()
        expected = [(d, *e) for (d, _, _), e in zip(rows, brute(texts, width))]
        assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, expected))
    assert used is repeats


def test_default_width_and_empty_table(spark):
    passage = " ".join(f"p{i}" for i in range(40))
    docs = spark.createDataFrame([(1, f"a b {passage} c"), (2, f"{passage} d"), (3, " ".join(passage.split()[:34]))], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(docs).collect()}
    assert got[1] == (43, 40, "a b c") and got[2] == (41, 40, "d") and got[3][1] == 0
    assert repeats.kept_digest(repeats.remove_repeats(docs.limit(0))).count() == 0
