import math
import random

import numpy as np
import pytest

from tokenloom.llm import covertree, embeddings

SCHEMA = "vec_id long, embedding array<float>, label int, kept string"


def brute(rows, cosine):
    usable = [
        i for i, (_, v, label) in enumerate(rows)
        if label is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for at, i in enumerate(usable):
        for j in usable[at + 1 :]:
            a, b = rows[i][1], rows[j][1]
            if rows[i][2] == rows[j][2] and len(a) == len(b):
                a, b = (np.array(v, np.float32).astype(float) for v in (a, b))
                if a @ b / math.sqrt(a @ a) / math.sqrt(b @ b) >= cosine:
                    links[i] += 1
                    links[j] += 1
                    parent[find(i)] = find(j)
    out = []
    for i, (name, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        first = min(ids, default=None)
        out.append((name, links[i], first, name == first))
    return out


def vectors(seed, n, dimensions=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dimensions))
    return [(centres[rng.integers(12)] * rng.uniform(0.5, 2) + rng.normal(size=dimensions) * rng.choice([0, 0.02, 0.1, 1])).tolist() for _ in range(n)]


@pytest.mark.parametrize("dimensions", [3, 16])
def test_trees_find_exactly_the_near_pairs(monkeypatch, dimensions):
    monkeypatch.setattr(covertree, "LEAF", 3)
    x = np.array(vectors(1, 300, dimensions))
    x = np.concatenate([x, x[:20]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    tree = covertree.build(x)
    got = [p for i, j in covertree.near_pairs(x, tree, x, tree, 0.98, True) for p in zip(i.tolist(), j.tolist())]
    expected = {(i, j) for i, j in zip(*np.nonzero(np.triu(x @ x.T >= 0.98, 1)))}
    assert len(got) == len(set(map(frozenset, got))) and {tuple(sorted(p)) for p in got} == expected
    a, b = x[:150], x[150:]
    cross = [p for i, j in covertree.near_pairs(a, covertree.build(a), b, covertree.build(b), 0.98, False) for p in zip(i.tolist(), j.tolist())]
    assert sorted(cross) == sorted(zip(*map(np.ndarray.tolist, np.nonzero(a @ b.T >= 0.98))))


@pytest.mark.parametrize("block", [7, 40, 2048])
def test_links_and_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    rng = random.Random(block)
    rows = [(i, v, rng.choice([1, 1, 1, 2])) for i, v in enumerate(vectors(block, 120))]
    rows += [(500 + i, rows[0][1], rows[0][2]) for i in range(5)] + [(3, rows[3][1], rows[3][2])]
    rows += [(600, None, 1), (601, [], 1), (602, [0.0] * 6, 1), (603, [1.0, None] * 3, 1), (604, [float("nan")] * 6, 1), (605, [float("inf")] + [1.0] * 5, 1)]
    rows += [(606, rows[0][1], None), (None, rows[0][1], rows[0][2]), (None, [9.0, -9.0, 9.0, -9.0, 9.0, 9.5], 7), (607, rows[0][1][:5], 1), (608, [1e30] * 6, 3), (609, [1e-30] * 6, 3)]
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = [tuple(r) for r in embeddings.near_vectors(table).collect()]
    expected = [(a, b, c, a == c) for a, b, c, _ in brute(rows, 0.98)]
    assert sorted(map(str, got)) == sorted(map(str, expected))


def test_empty_table(spark):
    assert embeddings.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("kind,names", [("string", ["a", "b c", "1"]), ("double", [1.25, 1.5, -0.5]), ("boolean", [True, False])])
def test_labels_are_compared_as_they_are(spark, kind, names):
    rows = [(i, v, names[i % len(names)]) for i, v in enumerate(vectors(5, 90))]
    table = spark.createDataFrame(rows, f"vec_id long, embedding array<float>, label {kind}")
    assert sorted(tuple(r) for r in embeddings.near_vectors(table).collect()) == sorted(brute(rows, embeddings.COSINE))
