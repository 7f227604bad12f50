import random

import pyarrow as pa
import pytest

from tokenloom.functions import codepoints
from tokenloom.operators import encode, vocab

TEXTS = ["aé😀", None, "", "ශ්‍රී", "x" * 500, "😀😀", "b"]


@pytest.mark.parametrize("size", [1, 7, 1 << 20])
def test_slices_hold_every_text_once(monkeypatch, size):
    monkeypatch.setattr(codepoints, "SLICE_BYTES", size)
    for first in range(3):
        texts = pa.array(TEXTS).slice(first)
        listed = [t for s in codepoints.text_slices(texts) for t in s.to_pylist()]
        assert listed == [t or "" for t in TEXTS[first:]]
        lists = codepoints.encoded_slices(texts, lambda p, n: codepoints.id_lists(p.astype("int32"), n)).to_pylist()
        assert lists == [[ord(c) for c in t or ""] for t in TEXTS[first:]]
    assert codepoints.encoded_slices(pa.array([], pa.string()), None).to_pylist() == []


def test_byte_fallback_by_character(spark, docs):
    rng = random.Random(1)
    texts = ["".join(rng.choices("abcé😀ශ", k=rng.randint(0, 12))) for _ in range(60)]
    ids = {"a": 300, "c": 301}
    frame = docs(*texts)
    rows = frame.select("text", encode.char_ids_or_bytes(frame["text"], ids).alias("ids")).collect()
    for row in rows:
        assert row.ids == [i for c in row.text for i in ([ids[c]] if c in ids else [4 + b for b in c.encode()])]


def test_counts_of_characters_and_words(docs):
    frame = docs("ab a", "a1 b", None, "")
    assert {r["char"]: r["cnt"] for r in vocab.char_counts(frame).collect()} == {"a": 3, "b": 2, " ": 2, "1": 1}
    assert {r["word"]: r["cnt"] for r in vocab.word_counts(frame).collect()} == {"▁ab": 1, "▁a": 2, "1": 1, "▁b": 1}


def test_decode_takes_unknown_ids_and_halves_of_characters(spark):
    model = vocab.Subwords([("t", "h")], ["t", "h"])
    rows = spark.createDataFrame([([260, 4 + 0xC3, 4 + 0xA9, 9999, -1, 3, 261],), ([4 + 0xC3, 260],), (None,)], "ids array<int>")
    assert [r[0] for r in rows.select(encode.decode_ids(rows["ids"], encode.piece_bytes(model))).collect()] == ["thét", "�th", ""]
