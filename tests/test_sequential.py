import pytest
from pyspark.sql import functions as F

from tokenloom.operators import ordered, packing
from tokenloom.plans import tokens


@pytest.fixture
def small_parts(monkeypatch):
    monkeypatch.setattr(ordered, "WEIGHT_PER_PART", 50)
    monkeypatch.setattr(tokens, "BLOCK", 4)
    monkeypatch.setattr(tokens, "CHUNKS_PER_FILE", 6)


def stored(chunks):
    """Ids of every chunk, digested, as `summary` tells them."""
    return {(r["split"], r["chunk_id"]): (r["n_tokens"], r["tokens_md5"]) for r in chunks.collect()}


def expected(spark, text):
    ids = {c: i for i, c in enumerate(sorted(set(text)))}
    cut = int(0.9 * len(text))
    rows = []
    for split, part in (("train", text[:cut]), ("val", text[cut:])):
        rows += [(split, i // 4, [ids[c] for c in part[i : i + 4]]) for i in range(0, len(part), 4)]
    return stored(tokens.summary(spark.createDataFrame(rows, "split string, chunk_id long, tokens array<int>")))


TEXTS = [("aé" * 13, "", "xyz")[i % 3] + "\U0001f600b" * (i % 7) for i in range(60)] + ["q" * 333, None, "end"]


def test_both_halves_are_stored_without_writing_texts_or_ids_in_between(spark, docs, small_parts, monkeypatch):
    written, numbers = [], []
    write, cut = ordered.cut_lineage, ordered.ranged
    monkeypatch.setattr(ordered, "cut_lineage", lambda df: written.append(df.columns) or write(df))
    monkeypatch.setattr(ordered, "ranged", lambda df, order, parts=None: numbers.append(parts) or cut(df, order, parts))
    rows = docs(*TEXTS).withColumn("text", F.coalesce("text", F.lit(""))).repartition(5)
    got = stored(tokens.sequential_store(spark, rows))
    assert got == expected(spark, "".join(t or "" for t in TEXTS))
    assert written and not any({"text", "ids"} & set(columns) for columns in written)
    # Cut by what the rows hold, not by how many they are.
    assert numbers == [8]


def test_repeated_and_missing_keys_are_stored_once_a_row(spark, small_parts):
    rows = [(1, "abc"), (2, "dd"), (2, "dd"), (2, "dd"), (3, "f" * 30), (3, "f" * 30), (4, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert sum(n for n, _ in stored(tokens.sequential_store(spark, frame)).values()) == sum(len(t) for _, t in rows)
    keyless = spark.createDataFrame([(None, "ab"), (None, "ab"), (5, "c" * 70)], "doc_id long, text string")
    placed = ordered.ranged_prefix_sum(keyless, ["doc_id"], F.char_length("text"), "start", wide=True)
    assert sorted((r["doc_id"] or 0, r["start"]) for r in placed.collect()) == [(0, 0), (0, 2), (5, 4)]


def test_wide_rows_are_placed_like_narrow_ones(spark, small_parts):
    rows = spark.range(200).select((F.col("id") * 7 % 200).alias("k"), F.repeat(F.lit("x"), (F.col("id") % 11).cast("int")).alias("t"))
    sums = [
        {(r["k"], r["b"]) for r in ordered.ranged_prefix_sum(rows, ["k"], F.length("t"), "b", wide=wide).collect()} for wide in (False, True)
    ]
    assert sums[0] == sums[1] and len(sums[0]) == 200


def test_rows_out_of_order_are_not_cut_into_chunks(spark):
    rows = spark.createDataFrame([("train", 3, [1, 2])], "split string, stream_start long, ids array<int>")
    with pytest.raises(Exception, match="begin with a chunk"):
        packing.chunks_in_order(rows, 4).collect()
