import random
import tracemalloc

import numpy as np
import pyarrow as pa

from test_llm_embeddings import SCHEMA, brute, vectors
from tokenloom.llm import embeddings


def test_blocks_keep_their_size_whatever_the_number_of_vectors(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 16)
    monkeypatch.setattr(embeddings, "CENTRES", 2)
    rng = np.random.default_rng(3)
    dense = (np.ones(6) + rng.normal(size=(100, 6)) * 0.02).tolist()
    rows = [(i, v, 1, "x") for i, v in enumerate(dense + vectors(4, 60))]
    seen = []
    init = embeddings.Cells.__init__
    monkeypatch.setattr(embeddings.Cells, "__init__", lambda self, *a: (init(self, *a), seen.append(self))[0])
    got = [tuple(r) for r in embeddings.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()]
    expected = [(a, b, c, a == c) for a, b, c, _ in brute([r[:3] for r in rows], 0.98)]
    assert sorted(map(str, got)) == sorted(map(str, expected))
    blocks = {r["low"]: r["low_blocks"] for r in seen[0].pairs.collect()}
    assert sum(blocks.values()) * 16 >= len(rows)


def test_links_of_a_dense_task_are_folded_not_stored():
    rng = np.random.default_rng(1)
    x = np.ones(64) + rng.normal(size=(2000, 64)) * 0.1
    x /= np.linalg.norm(x, axis=1)[:, None]
    names = [b"%016d" % i for i in random.Random(1).sample(range(10**9), 2000)]
    task = pa.table(
        {"vector": [v.tobytes() for v in x], "side": [1] * 1000 + [2] * 1000, "members": [1] * 2000, "class": pa.array(names, pa.binary())}
    ).combine_chunks()
    tracemalloc.start()
    out = pa.Table.from_batches(list(embeddings._links(task, 0.98)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    near = x[:1000] @ x[1000:].T >= 0.98
    counts = dict(zip(names, [*near.sum(1).tolist(), *near.sum(0).tolist()]))
    assert near.sum() > 300_000
    assert dict(zip(out["class"].to_pylist(), out["links"].to_pylist())) == {n: c for n, c in counts.items() if c}
    assert set(out["peer"].to_pylist()) == {min(n for n, c in counts.items() if c)}
    assert peak < 60e6


def test_centres_are_chosen_without_ranking_a_label(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(embeddings, "BLOCK", 8)
    rows = [(b"%016d" % i, 1, 6, np.array(v).tobytes(), 1) for i, v in enumerate(vectors(7, 400))]
    spark.createDataFrame(rows, "`class` binary, label long, size int, vector binary, members long").write.parquet(f"{tmp_path}/classes")
    plans, frame = [], type(spark.range(1))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda self: (plans.append(self._jdf.queryExecution().toString()), collect(self))[1])
    cells = embeddings.Cells(spark.read.parquet(f"{tmp_path}/classes"), 0.98)
    assert plans and not any("Window" in p or "row_number" in p for p in plans)
    assert len(cells.centres[(1, 6)]) == 50
