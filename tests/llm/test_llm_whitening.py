import random

import numpy as np
import pytest

from tokenloom.llm import queries, whitening

SF = "/root/testdata/sf0.001"
TYPE = "vec_id long, embedding array<double>, n int, component string"


def brute(vectors):
    """n, sums, covariance and deviations of a list of vectors, by Python integers."""
    x = [[int(np.floor(64.0 * c)) + 1_000_000 for c in v] for v in vectors]
    n, size = len(x), len(x[0])
    sums = [sum(r[d] for r in x) for d in range(size)]
    centred = [[n * r[d] - sums[d] for d in range(size)] for r in x]
    cov = [[sum(c[i] * c[j] for c in centred) / n**3 for j in range(size)] for i in range(size)]
    return n, sums, np.array(cov), [sum(e * e for e in c) for c in centred], np.array(centred, float) / n


def table(spark, vectors, ids=None):
    ids = ids if ids is not None else range(len(vectors))
    return spark.createDataFrame([(i, v, 7, "c") for i, v in zip(ids, vectors)], TYPE)


def check(rows, vectors, components=32):
    n, sums, cov, deviation, centred = brute(vectors)
    values, eigen = np.linalg.eigh(cov)
    values, eigen = values[::-1], eigen[:, ::-1]
    count = min(components, len(values))
    assert len(rows) == n * count
    by = {(r.vec_id, r.component): r for r in rows}
    for c in range(count):
        got = np.array([by[i, c + 1].whitened for i in range(n)])
        wanted = centred @ eigen[:, c] / np.sqrt(values[c])
        assert np.abs(got - wanted * np.sign(got @ wanted)).max() < 1e-6
        assert by[0, c + 1].explained == pytest.approx(values[c] / np.trace(cov), rel=1e-9)
    assert {r.n for r in rows} == {n} and len({r.identity_error for r in rows}) == 1
    assert rows[0].identity_error < 1e-8
    assert [by[i, 1].deviation for i in range(n)] == [d if d < 1 << 63 else None for d in deviation]


@pytest.mark.parametrize("seed,scale", [(0, 0.2), (1, 50.0), (2, 1e6)])
def test_equals_python_integers(spark, monkeypatch, seed, scale):
    monkeypatch.setattr(whitening, "PACKED_ROWS", 50)
    rng = random.Random(seed)
    vectors = [[rng.gauss(0, scale) * (d + 1) for d in range(6)] for _ in range(170)]
    check(whitening.whiten(table(spark, vectors).repartition(3)).collect(), vectors)


@pytest.mark.parametrize("span", [1, 300, 2**40, 2**61])
def test_scatter_is_exact(span):
    rng = random.Random(span)
    rows = [[rng.randint(-span, span) for _ in range(4)] for _ in range(130)]
    sums, cross = whitening.scatter(np.array(rows, np.int64))
    assert [int(s) for s in sums] == [sum(c) for c in zip(*rows)]
    for i in range(4):
        for j in range(i, 4):
            assert int(cross[i, j]) == sum(r[i] * r[j] for r in rows)
    values = np.array([*sums, *cross[np.triu_indices(4)]])
    parts = whitening.limbs(values)
    assert [sum(int(p[k]) << 32 * l for l, p in enumerate(parts)) for k in range(len(values))] == [int(v) for v in values]


def test_registered_query_equals_python_integers(spark):
    given = spark.read.parquet(f"{SF}/embeddings.parquet").orderBy("vec_id").collect()
    rows = queries.QUERIES["op12_embedding_whitening"](spark, SF).collect()
    order = {r.vec_id: i for i, r in enumerate(given)}
    rows = [type(r)(**{**r.asDict(), "vec_id": order[r.vec_id]}) for r in rows]
    check(rows, [r.embedding for r in given])


def test_rows_that_take_no_part(spark):
    good = [[1.0, 2.0], [2.0, 1.0], [4.0, 4.5]]
    bad = [None, [1.0, None], [float("nan"), 1.0], [1.0, float("inf")], [1e300, 0.0], [1.0], [], [1.0, 2.0, 3.0]]
    rows = whitening.whiten(table(spark, good + bad)).collect()
    assert {r.vec_id for r in rows} == {0, 1, 2}
    check(rows, good)


def test_ids_play_no_part(spark):
    vectors = [[1.0, 2.0], [1.0, 2.0], [3.0, 0.5], [0.0, 0.0]]
    rows = whitening.whiten(table(spark, vectors, [None, 5, 5, None])).collect()
    assert sorted(r.vec_id or 0 for r in rows) == [0] * 4 + [5] * 4 and rows[0].n == 4


def test_nothing_varies(spark):
    rows = whitening.whiten(table(spark, [[1.0, 2.0]] * 3)).collect()
    assert len(rows) == 6
    assert all(r.whitened is None and r.explained is None and r.identity_error is None and r.deviation == 0 for r in rows)
    line = whitening.whiten(table(spark, [[1.0, 2.0], [2.0, 4.0], [3.0, 6.0]])).orderBy("component", "vec_id").collect()
    assert [r.whitened is None for r in line] == [False] * 3 + [True] * 3
    assert line[0].explained == pytest.approx(1) and line[3].explained == pytest.approx(0, abs=1e-12)


def test_deviation_beyond_64_bits_is_null(spark):
    rows = whitening.whiten(table(spark, [[1e15, 0.0], [0.0, 1.0], [2.0, 3.0]])).collect()
    assert all(r.deviation is None for r in rows) and rows[0].identity_error < 1e-4


def test_empty_tables(spark):
    assert whitening.whiten(table(spark, [])).collect() == []
    assert whitening.whiten(table(spark, [None])).collect() == []
    assert whitening.whiten(table(spark, [[], []])).collect() == []
