import random
import re

import pyarrow as pa
import pytest

from tokenloom.llm import words
from tokenloom.llm.components import components
from tokenloom.llm.groups import whole_groups


def test_words_and_hashes_follow_the_texts():
    rng = random.Random(0)
    for _ in range(200):
        texts = [None if rng.random() < 0.1 else "".join(rng.choice("ab \n\té\x0b,") for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 6))]
        found = words.find_words(pa.array(texts, pa.string()))
        expected = [re.findall("[^\x20\x09-\x0d]+", t or "") for t in texts]
        assert [found.text(r).decode().split(" ") if expected[r] else [] for r in range(len(texts))] == expected
        flat = [w for e in expected for w in e]
        for width in (1, 2, 3):
            hashes = words.window_hashes(found.hash, width).tolist()
            windows = [tuple(flat[i : i + width]) for i in range(len(hashes))]
            assert len(set(zip(windows, hashes))) == len(set(windows)) == len(set(hashes))


def test_hash_blocks_do_not_show(monkeypatch):
    texts = pa.array(["one two three " * 50, "x" * 500, "one two three"])
    whole = words.find_words(texts)
    spans = words.span_hashes(whole.hash, whole.first[:2], whole.first[1:3])
    monkeypatch.setattr(words, "HASH_BLOCK", 16)
    assert (words.find_words(texts).hash == whole.hash).all()
    assert (words.window_hashes(whole.hash, 5) == words.window_hashes(whole.hash.copy(), 5)).all()
    assert (words.span_hashes(whole.hash, whole.first[:2], whole.first[1:3]) == spans).all()


def test_slices_cover_a_batch_and_sliced_arrays_work(monkeypatch):
    monkeypatch.setattr(words, "SLICE_BYTES", 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (3, 0, 30, 5, 5, 1)] + [None])], ["t"])
    parts = list(words.slices(batch, 0))
    assert [t for p in parts for t in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert len(parts) > 2 and len(words.find_words(parts[1].column(0)).start) >= 1
    assert list(words.slices(batch.slice(0, 0), 0)) == []


@pytest.mark.parametrize("rows", [1, 3, 100])
def test_groups_are_never_cut(rows):
    keys = [1, 1, 2, 3, 3, 3, 4, 5, 5]
    batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + 2], pa.int64())], ["k"]) for i in range(0, 9, 2)]
    seen = []
    for table, borders in whole_groups(iter(batches), "k", rows):
        values = table.column("k").to_pylist()
        assert borders[0] == 0 and borders[-1] == len(values)
        seen += [values[a:b] for a, b in zip(borders[:-1], borders[1:])]
    assert seen == [[1, 1], [2], [3, 3, 3], [4], [5, 5]]


def test_components_of_chains_stars_and_cycles(spark):
    links = [(i, i + 1) for i in range(1, 60)] + [(100, 101 + i) for i in range(30)] + [(201, 200), (202, 201), (200, 202), (300, 300)]
    got = {r.vertex: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 1 for i in range(2, 61)}, **{101 + i: 100 for i in range(30)}, 201: 200, 202: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_lower_case_words_of_a_slice():
    texts = pa.array(["Ab CD", None, "Éé-X9", "", "tail OF it"])
    for first in range(5):
        part = texts.slice(first)
        found = words.find_words(part, words.PLAIN_TABLE, lower=True)
        listed = [found.text(i).decode() for i in range(len(part))]
        assert listed == ["ab cd", "", "Éé x9", "", "tail of it"][first:]
