import numpy as np
import pytest

from test_llm_embeddings import SCHEMA, brute
from tokenloom.llm import embeddings


def clustered(seed, n, dimensions=5):
    """Clusters in clusters: their vectors need several levels."""
    rng = np.random.default_rng(seed)
    outer = rng.normal(size=(4, dimensions))
    inner = outer[rng.integers(4, size=12)] + rng.normal(size=(12, dimensions)) * 0.3
    own = inner[rng.integers(12, size=n)]
    return (own + rng.normal(size=(n, dimensions)) * 0.08).tolist()


@pytest.mark.parametrize("centres", [1, 3])
def test_levels_keep_every_link_and_leave_pairs_out(spark, monkeypatch, centres):
    for name, value in (("BLOCK", 8), ("SPLIT", 1), ("FAN", 4), ("PIECE", 16), ("CENTRES", centres)):
        monkeypatch.setattr(embeddings, name, value)
    rows = [(i, v, 1 + (i % 7 == 0)) for i, v in enumerate(clustered(centres, 260))]
    seen = []
    init, descend = embeddings.Cells.__init__, embeddings.Cells._descend
    monkeypatch.setattr(embeddings.Cells, "__init__", lambda self, *a: (init(self, *a), seen.append(self))[0])
    levels = []
    monkeypatch.setattr(embeddings.Cells, "_descend", lambda self, level, cosine: (descend(self, level, cosine), levels.append((level, self.cells.count())))[0])
    got = [tuple(r) for r in embeddings.near_vectors(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()]
    assert sorted(got) == sorted(brute(rows, embeddings.COSINE))
    assert [level for level, _ in levels] == [1.0, 0.5, 0.25, 0.125]
    assert levels[-1][1] > levels[0][1] > 1
    cells = {(r.label, r.cell): r for r in seen[0].cells.collect()}
    placed = seen[0].placed.groupBy("label", "cell").agg({"away": "max", "*": "count"}).collect()
    assert {(r.label, r.cell): (r["max(away)"], r["count(1)"]) for r in placed} == {k: (r.radius, r.n) for k, r in cells.items()}
    of_label = [k for k in cells if k[0] == 1]
    pairs = [(r.low, r.high) for r in seen[0].pairs.where("label = 1").collect()]
    assert len(pairs) == len({frozenset(p) for p in pairs}) < len(of_label) * (len(of_label) + 1) / 2


def test_a_cell_without_centres_stays_whole(spark, monkeypatch):
    for name, value in (("BLOCK", 8), ("SPLIT", 1), ("FAN", 4), ("CENTRES", 1)):
        monkeypatch.setattr(embeddings, name, value)
    monkeypatch.setattr(embeddings, "CHOICES", 0.1)
    rows = [(i, v, i % 5) for i, v in enumerate(clustered(9, 200))]
    got = [tuple(r) for r in embeddings.near_vectors(spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)).collect()]
    assert sorted(got) == sorted(brute(rows, embeddings.COSINE))
