import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tokenloom.operators import packing, splits
from tokenloom.operators.profile import check_id_range
from tokenloom.operators.vocab import char_vocab
from tokenloom.sources import metadata as meta
from tokenloom.sources.tokenbin import read_tokens, write_tokens

BLOCK = 8


@pytest.fixture(scope="module")
def encoded(spark):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(60000) for _ in range(rng.choice([0, 1, 3, 8, 40]))]) for i in range(60)]
    frame = spark.createDataFrame(rows, "doc_id long, ids array<int>").withColumn("len", F.size("ids"))
    return splits.random_split(frame, 0.1)


@pytest.fixture(scope="module")
def streams(encoded):
    out = {}
    for r in sorted(encoded.collect(), key=lambda r: r.order_key):
        out.setdefault(r.split, []).extend(r.ids)
    return out


def chunk_table(encoded):
    return packing.pack_chunks(packing.stream_offsets(encoded), BLOCK)


def rebuilt(chunks):
    out = {}
    for r in sorted(chunks.collect(), key=lambda r: (r.split, r.chunk_id)):
        out.setdefault(r.split, []).append(r.tokens)
    return out


def test_runs_of_chunks_meet_in_one_partition_without_a_second_shuffle(encoded, streams):
    plain, runs = chunk_table(encoded), packing.pack_chunks(packing.stream_offsets(encoded), BLOCK, 5)
    assert rebuilt(runs) == rebuilt(plain)
    placed = runs.withColumn("part", F.spark_partition_id()).withColumn("run", F.expr("chunk_id div 5"))
    assert placed.groupBy("split", "run").agg(F.countDistinct("part").alias("n")).where("n > 1").count() == 0

    def shuffles(frame):
        return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    # Offsets alone take one shuffle of the documents; whole chunks are gathered where they lie.
    assert shuffles(packing.stream_offsets(encoded)) == 1
    border = "Exchange hashpartitioning(split#"
    lines = [x for x in plain._jdf.queryExecution().executedPlan().toString().split("\n") if border in x and "chunk_id" in x]
    assert len({x.split(", [plan_id")[0].lstrip(" +-:*") for x in lines}) == 1


@pytest.mark.parametrize("partitions", [1, 7, 32])
def test_chunks_concatenate_to_the_stream(encoded, streams, partitions):
    for split, parts in rebuilt(chunk_table(encoded.repartition(partitions))).items():
        assert sum(parts, []) == streams[split]
        assert all(len(p) == BLOCK for p in parts[:-1])


def test_token_files_hold_the_stream(spark, encoded, streams, tmp_path):
    path = f"{tmp_path}/tokens"
    chunks = chunk_table(encoded)
    write_tokens(chunks, path, BLOCK, files=3)
    assert rebuilt(read_tokens(spark, path)) == rebuilt(chunks)
    assert rebuilt(read_tokens(spark, path, "val")) == {"val": rebuilt(chunks)["val"]}
    raw = [np.fromfile(f, dtype="<u2").tolist() for f in sorted(tmp_path.glob("tokens/train-*.bin"))]
    assert sum(raw, []) == streams["train"]
    with pytest.raises(Exception, match="already holds"):
        write_tokens(chunks, path, BLOCK)


def test_token_files_refuse_wide_ids(spark, tmp_path):
    wide = spark.createDataFrame([("train", 0, [70000])], "split string, chunk_id long, tokens array<int>")
    with pytest.raises(Exception, match="16 bits"):
        write_tokens(wide, f"{tmp_path}/wide", BLOCK)


def test_id_range_check(spark):
    frame = spark.createDataFrame([(1, [65535])], "doc_id long, ids array<int>")
    assert check_id_range(frame).first().ids == [65535]
    with pytest.raises(Exception, match="out of range"):
        check_id_range(frame.withColumn("ids", F.array(F.lit(65536)))).collect()


def test_windows_shift_by_one_and_reach_both_ends(spark, encoded, streams):
    stream = streams["train"]
    starts = list(range(len(stream) - BLOCK))
    windows = spark.createDataFrame([(i, "train", o) for i, o in enumerate(starts)], "w long, split string, offset long")
    rows = packing.cut_windows(windows, chunk_table(encoded), BLOCK, "w").collect()
    assert len(rows) == len(starts)
    for r in rows:
        assert r.x == stream[r.offset : r.offset + BLOCK]
        assert r.y == stream[r.offset + 1 : r.offset + 1 + BLOCK]


def test_offsets_of_short_streams(spark):
    plan = packing.batch_plan(spark, 5, 4)
    assert {r.offset for r in packing.draw_offsets(plan, "train", BLOCK + 1, BLOCK).collect()} == {0}
    with pytest.raises(ValueError):
        packing.draw_offsets(plan, "train", BLOCK, BLOCK)


def test_batch_plan_divides_accumulation_among_ranks(spark):
    plan = packing.batch_plan(spark, 2, batch_size=12, accumulation=40, ranks=8)
    assert plan.count() * 1024 == 2 * 491_520
    assert {r.rank_seed for r in plan.select("rank_seed").distinct().collect()} == set(range(1337, 1345))
    assert plan.dropDuplicates(["iter", "micro_step", "rank", "slot"]).count() == plan.count()
    assert packing.batch_plan(spark, 1, 64, 8).count() * 512 == 262_144
    with pytest.raises(ValueError):
        packing.batch_plan(spark, 1, 1, 5, 2)


def test_epoch_blocks_are_full(encoded, streams):
    blocks = packing.epoch_blocks(chunk_table(encoded), BLOCK, 1, 3).where("split = 'train'").orderBy("chunk_id").collect()
    assert sum((b.tokens for b in blocks), []) == streams["train"][BLOCK : 3 * BLOCK]


def test_synthetic_tokens_are_fixed_and_in_range(spark):
    rows = spark.range(20).withColumnRenamed("id", "doc_id")
    first = packing.synthetic_tokens(rows, "doc_id", 32).collect()
    assert sorted(first) == sorted(packing.synthetic_tokens(rows.repartition(5), "doc_id", 32).collect())
    assert all(len(r.tokens) == 32 and 0 <= min(r.tokens) and max(r.tokens) < 50304 for r in first)


def test_metadata(spark, docs, tmp_path):
    meta.write_metadata(meta.char_metadata(char_vocab(docs("ba"))), f"{tmp_path}/char")
    row = meta.read_metadata(spark, f"{tmp_path}/char").first()
    assert (row.vocab_size, row.stoi, row.itos, row.eos_id) == (2, {"a": 0, "b": 1}, {0: "a", 1: "b"}, None)
    meta.write_metadata(meta.subword_metadata(spark, 16000, "m", 3, 2, 0, 1), f"{tmp_path}/sub")
    stored = meta.read_metadata(spark, f"{tmp_path}/sub")
    assert (stored.first().eos_id, stored.first().stoi) == (3, None)
    assert meta.model_vocab_size(stored).first().vocab_size == 16000
    assert meta.model_vocab_size(stored.where("false")).first().vocab_size == 50304


def test_borders_are_met_again_whatever_the_buckets(encoded, streams):
    offsets = packing.stream_offsets(encoded)
    assert rebuilt(packing.pack_chunks(offsets, BLOCK)) == rebuilt(packing.pack_chunks(offsets.drop(packing.BUCKET), BLOCK))
    assert rebuilt(packing.pack_chunks(offsets, 3)) == rebuilt(packing.pack_chunks(offsets.drop(packing.BUCKET), 3))


def test_too_many_splits_and_short_ones_are_errors(spark):
    many = spark.range(packing.MOST_SPLITS + 1).select(F.col("id").cast("string").alias("split"), F.lit(1).alias("len"))
    with pytest.raises(ValueError):
        packing.stream_lengths(many)
    assert len(packing.stream_lengths(many.limit(11))) == 11
    with pytest.raises(ValueError):
        packing.draw_offsets(packing.batch_plan(spark, 1, 1), "val", 8, 8)
