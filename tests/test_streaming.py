from pyspark.sql import functions as F

from tokenloom.operators import packing, vocab
from tokenloom.operators.encode import char_ids, encode_documents, encode_subwords
from tokenloom.sources.documents import clean
from tokenloom.streaming import tokens
from tokenloom.streaming.encode import document_stream

BLOCK, FRACTION = 4, 0.3


def streams(chunks):
    """The tokens of every split, from chunks that must follow one another."""
    out = {}
    for r in chunks.orderBy("split", "chunk_id").collect():
        own = out.setdefault(r["split"], [])
        assert len(own) == r["chunk_id"] * BLOCK
        own += r["tokens"]
    return out


def batch_streams(encoded):
    return streams(packing.pack_chunks(packing.stream_offsets(encoded), BLOCK))


def test_one_run_equals_the_table(spark, docs, tmp_path):
    frame = docs(*[f"text {i} " + "ab" * (i % 7) for i in range(40)], "", " ")
    ids = vocab.collect_ids(vocab.char_vocab(clean(frame)))
    frame.coalesce(1).write.parquet(f"{tmp_path}/in")
    query = tokens.write_char_stream(document_stream(spark, f"{tmp_path}/in"), ids, len(ids), f"{tmp_path}/out", BLOCK, FRACTION)
    query.trigger(availableNow=True).start().awaitTermination(180)
    encoded = encode_documents(tokens.split_by_key(clean(frame), FRACTION), char_ids(F.col("text"), ids), len(ids))
    expected = batch_streams(encoded)
    assert set(expected) == {"train", "val"}
    assert streams(tokens.read_token_stream(spark, f"{tmp_path}/out", BLOCK)) == expected


def test_batches_follow_one_another_and_may_be_repeated(spark, docs, tmp_path):
    model = vocab.Subwords([("t", "h")], ["▁", "t", "h", "a"])
    target = f"{tmp_path}/tokens"
    batches = [docs(*["th a th"] * 5, start=0), docs("", start=50), docs(*["a that", "h"] * 4, start=100)]
    encoded = [encode_subwords(tokens.split_by_key(b, FRACTION), model) for b in batches]
    assert tokens.read_token_stream(spark, target, BLOCK).collect() == []
    for number, rows in enumerate(encoded):
        tokens.append_batch(rows, number, target, BLOCK)
    wanted = {}
    for rows in encoded:
        for split, own in batch_streams(rows).items():
            wanted.setdefault(split, []).extend(own)
    assert streams(tokens.read_token_stream(spark, target, BLOCK)) == wanted
    # The last batch once more, as after a failure between its files and the stream's own progress.
    tokens.append_batch(encoded[2], 2, target, BLOCK)
    assert streams(tokens.read_token_stream(spark, target, BLOCK)) == wanted
    assert [s["batch"] for s in tokens.batch_states(target)] == [0, 1, 2]
