import random
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from tokenloom.functions import normalize
from tokenloom.operators import encode, vocab
from tokenloom.sources import prompts

ODD = ["é", "ﬁ", "２", "각", "각", "á̧", "á̧", "…", "①", "ශ්‍රී", "́", "x", " ", "̈́", "ｶﾞ", "Å", "q̣̇"]


def test_equals_the_library_on_any_text():
    rng = random.Random(0)
    texts = [None, ""] + ["".join(rng.choices(ODD, k=rng.randint(0, 8))) for _ in range(1500)]
    texts += [chr(c) + "́" + chr(c) for c in range(0x20, 0x3400) if not 0xD800 <= c < 0xE000]
    found = normalize.composed(pa.array(texts, pa.string())).to_pylist()
    for text, row in zip(texts, found):
        text = text or ""
        assert row["text"] == unicodedata.normalize("NFKC", text)
        assert len(row["starts"]) == len(row["text"]) and row["starts"] == sorted(row["starts"])
        assert all(0 <= s < len(text) for s in row["starts"])


def test_places_lead_back_to_the_source():
    row = normalize.composed(pa.array(["zz", "aﬁé２b"])).to_pylist()[1]
    assert row == {"text": "afié2b", "starts": [0, 1, 1, 2, 4, 5]}


def test_column_over_partitions(docs):
    frame = docs("ﬁn", None, "", "å").repartition(3)
    rows = frame.select("doc_id", normalize.compose_with_places(F.col("text")).alias("c")).orderBy("doc_id").collect()
    assert [(r.c.text, r.c.starts) for r in rows] == [("fin", [0, 0, 1]), ("", []), ("", []), ("å", [0])]


def test_special_literals_of_subword_prompts(docs):
    model = vocab.Subwords([("t", "h")], ["▁", "t", "h", "a", "|", "<", ">"])
    ids = model.piece_ids()
    specials = {"<|e|>": 3, "<|e": 1, "<s>": 2}
    frame = docs("<s>th<|e|> a", "<|e|><|e|>", "<|ea", "", "a")
    special = encode.encode_subwords(frame, model, None, specials=specials).orderBy("doc_id").collect()
    th, a, mark = ids["th"], ids["a"], ids["▁"]
    assert [r.ids for r in special] == [[2, mark, th, 3, mark, a], [3, 3], [1, mark, a], [], [mark, a]]
    plain = encode.encode_subwords(frame, model, None).orderBy("doc_id").collect()
    assert all(not {1, 2, 3} & set(r.ids) for r in plain) and plain[1].len == 1 + 2 * 5 + 2 - 2


def test_subword_prompts_from_files(spark, tmp_path):
    model = vocab.Subwords([("t", "h")], ["▁", "t", "h", "a"])
    (tmp_path / "p1.txt").write_text("th<|endoftext|>a")
    (tmp_path / "p2.txt").write_text(" \n")
    rows = prompts.encode_subword_prompts(prompts.read_prompts(spark, str(tmp_path)), model).orderBy("prompt_id").collect()
    ids = model.piece_ids()
    assert [r.ids for r in rows] == [[ids["▁"], ids["th"], vocab.EOS_ID, ids["▁"], ids["a"]], []]
    off = prompts.encode_subword_prompts(prompts.read_prompts(spark, str(tmp_path)), model, None).orderBy("prompt_id").first()
    assert vocab.EOS_ID not in off.ids
