import zlib

from tokenloom.llm import shards

ROWS = [(i, "é" * (i % 7) if i % 11 else None, f"s{i}") for i in range(200)] + [(5, "same", "x")] * 90 + [(None, "", "y")] * 3


def test_shards_are_contiguous_balanced_and_gapless(spark, monkeypatch):
    monkeypatch.setattr(shards, "ROWS_PER_PART", 40)
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, shard string")
    got = shards.manifest(docs, 8).collect()
    assert len(got) == len(ROWS)
    sizes = {s: [r.size for r in got if r.shard == s] for s in range(8)}
    total = sum(map(sum, sizes.values()))
    assert all(abs(sum(v) - total / 8) <= max(r.size for r in got) for v in sizes.values())
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(len(sizes[s])))
    ordered = [r.doc_id if r.doc_id is not None else -1 for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert ordered == sorted(ordered)
    texts = {(r[0], zlib.crc32((r[1] or "").encode())) for r in ROWS}
    assert {(r.doc_id, r.crc) for r in got} == texts
    rows = shards.assign_shards(docs, 8)
    assert sorted((str(r.row.doc_id), str(r.row.shard)) for r in rows.collect()) == sorted((str(a), str(c)) for a, _, c in ROWS)
    assert sorted((r.shard, r.slot, r.size) for r in rows.collect()) == sorted((r.shard, r.slot, r.size) for r in got)


def test_empty_and_few_rows(spark, tmp_path):
    docs = spark.createDataFrame([(1, "abc"), (2, "x" * 1_000_000)], "doc_id long, text string")
    assert shards.manifest(docs.limit(0), 16).count() == 0
    got = {r.doc_id: (r.shard, r.slot, r.size) for r in shards.manifest(docs, 16).collect()}
    assert got == {1: (0, 0, 4), 2: (8, 0, 1_000_001)}
    shards.write_shards(docs, f"{tmp_path}/out", 2)
    assert {(r.row.doc_id, r.shard) for r in spark.read.parquet(f"{tmp_path}/out").collect()} == {(1, 0), (2, 1)}
