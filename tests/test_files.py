import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.operators.splits import sequential_split
from tokenloom.sources import textrange, tokenbin

TEXT = "ab\nශ්‍රී ලංකා 😀é" * 40 + "end"


@pytest.mark.parametrize("range_bytes,piece_bytes", [(7, 3), (64, 5), (1 << 20, 100), (1 << 20, 1 << 20)])
def test_pieces_join_to_the_text(spark, tmp_path, range_bytes, piece_bytes):
    (tmp_path / "a.txt").write_bytes(TEXT.encode())
    (tmp_path / "b.txt").write_bytes("é".encode())
    (tmp_path / "c.txt").write_bytes(b"")
    (tmp_path / "_SUCCESS").write_bytes(b"x")
    rows = textrange.read_text_ranges(spark, str(tmp_path), range_bytes, piece_bytes).orderBy("doc_id").collect()
    assert "".join(r.text for r in rows) == TEXT + "é"
    assert len({r.doc_id for r in rows}) == len(rows)


@pytest.mark.parametrize("range_bytes,piece_bytes", [(50, 11), (1 << 20, 1 << 20)])
def test_split_of_one_file(spark, tmp_path, range_bytes, piece_bytes):
    (tmp_path / "corpus.txt").write_bytes(TEXT.encode())
    pieces = textrange.read_text_ranges(spark, f"{tmp_path}/corpus.txt", range_bytes, piece_bytes)
    rows = sequential_split(pieces).orderBy("doc_id").collect()
    halves = {s: "".join(r.text for r in rows if r.split == s) for s in ("train", "val")}
    cut = int(0.9 * len(TEXT))
    assert halves == {"train": TEXT[:cut], "val": TEXT[cut:]}


def test_bytes_that_are_not_utf8(spark, tmp_path):
    (tmp_path / "x.txt").write_bytes(b"ab\xffcd\x80\x80\x80\x80")
    rows = textrange.read_text_ranges(spark, f"{tmp_path}/x.txt", 100, 100).collect()
    assert rows[0].text.startswith("ab�cd�")


@pytest.fixture
def store(spark, tmp_path):
    """10 chunks of `train` and 2 of `val` in files of a few chunks."""
    block = 4
    tokens = {"train": np.arange(38) % 50, "val": np.arange(100, 106)}
    rows = [(s, i // block, t[i : i + block].tolist()) for s, t in tokens.items() for i in range(0, len(t), block)]
    chunks = spark.createDataFrame(rows, "split string, chunk_id long, tokens array<int>")
    path = f"{tmp_path}/store"
    tokenbin.write_tokens(chunks, path, block, files=5)
    assert len(tokenbin.read_manifest(path)[1]) > 3
    return path, tokens


def test_windows_are_read_across_files(spark, store):
    path, tokens = store
    plan = [(i, s, o) for s, t in tokens.items() for i, o in enumerate(range(len(t) - 5))]
    windows = spark.createDataFrame(plan, "i long, split string, offset long")
    for parts in (1, 3):
        rows = tokenbin.read_windows(windows, path, 5, "i", parts=parts).collect()
        assert len(rows) == len(plan)
        for r in rows:
            t = tokens[r.split]
            assert r.x == t[r.offset : r.offset + 5].tolist() and r.y == t[r.offset + 1 : r.offset + 6].tolist()


def test_windows_beyond_the_end_raise(spark, store):
    windows = spark.createDataFrame([(0, "val", 3)], "i long, split string, offset long")
    with pytest.raises(Exception, match="beyond the stored tokens"):
        tokenbin.read_windows(windows, store[0], 5, "i").collect()
    with pytest.raises(Exception, match="no split"):
        tokenbin.read_windows(windows.withColumn("split", F.lit("x")), store[0], 5, "i").collect()


def test_filters_choose_byte_ranges(spark, store):
    path, tokens = store
    everything = sorted(tuple(r) for r in tokenbin.read_tokens(spark, path).collect())
    half = (F.col("split") == "train") & (F.col("chunk_id") > 3) & (F.col("chunk_id") <= 7)
    rows = tokenbin.read_tokens(spark, path).where(half).collect()
    assert sorted(tuple(r) for r in rows) == [r for r in everything if r[0] == "train" and 3 < r[1] <= 7]
    one = tokenbin.read_tokens(spark, path).where("split in ('val', 'none') and chunk_id = 1 and size(tokens) = 2").collect()
    assert [tuple(r) for r in one] == [("val", 1, [104, 105])]
    reader = tokenbin.TokenReader(path, None)
    left = list(reader.pushFilters([tokenbin.EqualTo(("split",), "train"), tokenbin.GreaterThanOrEqual(("chunk_id",), 8)]))
    assert left == [] and sum(p.tokens for p in reader.partitions()) == 38 - 32
