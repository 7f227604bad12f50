import random

import numpy as np

from tokenloom.operators import bpe
from tokenloom.operators.encode import LONG_UNIT, SPECIAL_MARK, UnitMerger, merge_unit
from tokenloom.operators.packedwords import PairTable, Symbols, merged_words, pack, unpack
from tokenloom.operators.vocab import Subwords


def random_merges(r):
    merges, pool = [], list("abcé")
    for _ in range(r.randint(1, 20)):
        pair = r.choice(pool), r.choice(pool)
        if pair not in merges:
            merges.append(pair)
            pool.append("".join(pair))
    return merges


def test_merged_words_equal_merging_in_order():
    for seed in range(60):
        r = random.Random(seed)
        merges, symbols = random_merges(r), Symbols()
        fresh = np.array([symbols.add(a + b) for a, b in merges], np.int32)
        table = PairTable([symbols.key(*m) for m in merges], list(range(len(merges))), len(symbols.merged))
        words = ["".join(r.choices("abcé😀", k=r.choice([0, 1, 2, 5, 30]))) for _ in range(40)]
        given = np.array([ord(c) for w in words for c in w], np.int32), np.array([len(w) for w in words]), np.arange(len(words))
        parts, lengths, order = next(unpack([pack(merged_words(given, table, fresh))]))
        ends = np.cumsum(lengths)
        found = {i: [symbols.text(s) for s in parts[e - n : e].tolist()] for i, n, e in zip(order.tolist(), lengths, ends)}
        ranks = {m: i for i, m in enumerate(merges)}
        assert found == {i: bpe.merged_in_order(list(w), ranks) for i, w in enumerate(words)}


def test_units_merged_together_equal_units_merged_alone():
    for seed in range(60):
        r = random.Random(seed)
        merger = UnitMerger(Subwords(random_merges(r), list("abc")), {"<s>": 2})
        units = list({"".join(r.choices("abcé😀", k=r.choice([0, 1, 2, 9, LONG_UNIT, 90]))) for _ in range(40)}) + [SPECIAL_MARK + "<s>"]
        assert [ids.tolist() for ids in merger.all(units)] == [merger.one(u).tolist() for u in units]
    assert merger.all([]) == []


def test_units_are_merged_in_few_passes(monkeypatch):
    """No unit of ordinary length is merged on its own."""
    monkeypatch.setattr("tokenloom.operators.encode.merge_unit", lambda *_: 1 / 0)
    merger = UnitMerger(Subwords([("a", "b")], list("ab")), {})
    assert [ids.tolist() for ids in merger.all(["abab", "ba"])] == [[260, 260], [262, 261]]
    assert merge_unit("abab", {("a", "b"): 0}) == ["ab", "ab"]
