import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from tokenloom.llm import forest


def shingles(text):
    words = (text or "").split()
    if len(words) < forest.SHINGLE:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + forest.SHINGLE]) for i in range(len(words) - forest.SHINGLE + 1)}


def brute(rows):
    sets, parent, links = [shingles(t) for _, t in rows], list(range(len(rows))), [0] * len(rows)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            parent[find(i)] = find(j)
    out = []
    for i, (name, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((name, min(ids, default=None), links[i]))
    return out, len({find(i) for i in range(len(rows)) if sets[i]})


def corpus(seed, groups=12, copies=14):
    rng = random.Random(seed)
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randint(3, 120))]
        for _ in range(rng.randint(1, copies)):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(9)}"
            rows.append((len(rows), rng.choice([" ", "\n"]).join(copy)))
    return rows


def test_depth_shortens_until_the_recall_is_reached():
    assert forest.matched_depth(0.8, 16, 0.9995) == 4
    assert forest.matched_depth(0.8, 16, 0.5) == forest.DEEPEST
    assert 1 - (1 - 0.8**4) ** 16 >= 0.9995 > 1 - (1 - 0.8**5) ** 16


def test_prefixes_are_shorter_where_the_corpus_is_sparse(spark, monkeypatch):
    """Copies of one text crowd their nodes, a pair has its own: depths differ by node, and no link is lost."""
    monkeypatch.setattr(forest, "FEW", 6)
    rng = random.Random(9)
    rows = []
    for group in range(60):
        base = [f"g{group}w{i}" for i in range(60)]
        for _ in range(30 if group == 0 else 2):
            copy = list(base)
            # Two changed words far apart leave 46 of 66 shingles, or the like, on either side of the threshold.
            for at in rng.sample(range(60), rng.choice([0, 1, 1, 2])):
                copy[at] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(copy)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    join = forest.Join(docs)
    depths = {r["set"]: r["depths"] for r in join.nodes.groupBy("set").agg(F.collect_set("depth").alias("depths")).collect()}
    used = [d for found in depths.values() for d in found]
    assert min(used) == forest.SHORTEST and max(used) == join.depth == 4
    crowded = {r["set"] for r in join.rows.where("doc_id < 30").select("set").collect()}
    assert all(max(d) < 4 for name, d in depths.items() if name not in crowded)
    # A node above the depth of the target holds few classes, and classes share no node at two depths.
    assert join.nodes.where(f"depth < {join.depth} and n > 6").count() == 0
    assert join.nodes.groupBy("set", "tree").count().where("count > 1").count() == 0
    expected, _ = brute(rows)
    assert sorted(tuple(r) for r in join.documents().collect()) == sorted(expected)


def test_recall_of_pairs_at_the_threshold(spark):
    """Pairs of sets whose similarity is just at 0.8: at least 99 in 100 are found."""
    rows, wanted = [], 0
    for i in range(1500):
        words = [f"p{i}w{j}" for j in range(94)]
        other = list(words)
        # One word in the middle changes 5 of 90 shingles, two of them 10: 80 shared of 100 in all.
        for at in (30, 60):
            other[at] += "x"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
        wanted += 5 * 80 >= 4 * 100
    found = forest.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).where("n_links = 1").count() // 2
    assert wanted == 1500 and found >= 0.99 * wanted


def test_rows_that_repeat_id_and_text_keep_one_by_their_hash(spark):
    rows = [(1, "one two three four five six", lang) for lang in ("en", "de", "fr", None)]
    kept = {forest.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(k)).first()["lang"] for k in (1, 3, 4)}
    assert len(kept) == 1


@pytest.mark.parametrize("block", [3, 256])
def test_links_and_classes_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(forest, "BLOCK", block)
    rows = corpus(block)
    rows += [(900, rows[0][1]), (0, rows[0][1]), (None, rows[0][1]), (None, "nobody else has this text of words"), (901, None), (902, ""), (903, " \n"), (904, "two words"), (905, "two words")]
    rows.append((906, " ".join(f"long{i}" for i in range(60_000))))
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, class_id string")
    expected, groups = brute(rows)
    assert sorted(map(str, (tuple(r) for r in forest.jaccard_join(docs).collect()))) == sorted(map(str, expected))

    kept = forest.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in kept.collect()]
    firsts = {c for n, c, _ in expected if c is not None}
    assert {d for d, _ in texts if d is not None} == firsts
    assert sum(bool(shingles(t)) for _, t in texts) == groups
    assert sum(not shingles(t) for _, t in texts) == 3


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert forest.jaccard_join(docs).count() == 0
    assert forest.drop_near_duplicates(docs).count() == 0
    blank = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert sorted(tuple(r) for r in forest.jaccard_join(blank).collect()) == [(1, 1, 0), (2, 2, 0)]
